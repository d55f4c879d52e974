"""Best-fit packing with certified bin counts.

Documents become token ids plus an end id; only those longer than a sequence are cut. Pieces are
dealt to partitions by a hash; each partition packs best-fit decreasing and gets a lower bound on its
bins from dual feasible functions. Where bins equal the bound, nothing better exists for these pieces alone.
Partitions with a gap give up their bins that are not full, the others only their emptiest ones (what rounding up
leaves); the released pieces are dealt anew, mixed with those of other partitions, to fewer partitions
and packed again, while that saves bins.

Defined results: a null or empty text is the end id alone (one piece of length 1); repeated rows are
packed as often as they occur; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for, stash
from .tokens import column_ids

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(n: int, capacity: int) -> np.ndarray:
    """Starts of the pieces of ``n`` ids: full ones, but the first may be shorter."""
    first = n % capacity or capacity
    return np.concatenate([[0], np.arange(first, n, capacity)]) if n > capacity else np.zeros(1, np.int64)


def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece, with the checksum of its ids (little-endian unsigned 32 bits)."""

    def pieces(batches):
        for batch in batches:
            ids_of, rows = batch.column("doc_id"), []
            for row, ids in column_ids(batch.column("text"), tokenizer):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                starts = cut_pieces(len(ids), capacity)
                ends = np.append(starts[1:], len(ids))
                for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
                    rows.append((row, k, a, b - a, zlib.crc32(ids[a:b])))
            row, *rest = np.array(rows, np.int64).reshape(-1, 5).T
            columns = [ids_of.take(pa.array(row)), pa.array(rest[0].astype(np.int32)), *map(pa.array, map(np.ascontiguousarray, rest[1:]))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(pieces, PIECE_SCHEMA)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual feasible functions.

    u_e counts a size above capacity-e as a whole bin and drops sizes below e; f_k rounds sizes in units of
    capacity/(k+1) (k = 1..20), where a size that is a multiple keeps its value.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    total, number = np.cumsum(count * size), np.cumsum(count)
    best = math.ceil(total[-1] / capacity)
    for e in range(1, capacity // 2 + 1):
        big = number[-1] - number[capacity - e]
        middle = total[capacity - e] - total[e - 1]
        best = max(best, int(big) + math.ceil(middle / capacity))
    for k in range(1, 21):
        scaled = size * (k + 1)
        value = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)
        best = max(best, math.ceil(int((count * value).sum()) / (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin of each piece, its offset there, number of bins).

    Bins are kept by the room left, so the tightest fit is the lowest set bit of a mask.
    """
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, bins
            bins += 1
        bin_of[i], offset[i] = b, capacity - room
        left = room - n
        if left:
            if not by_room[left]:
                mask |= 1 << left
            by_room[left].append(b)
    return bin_of, offset, bins


PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long, part_bins long, part_bound long, room long"


def _pack_round(pieces: DataFrame, parts: int, number: int, capacity: int) -> DataFrame:
    """Deal to ``parts`` groups and pack each; sequence numbers hold the round, the group and the bin."""

    def pack(table: pa.Table) -> pa.Table:
        # a fixed order, so that a task that runs again makes the same bins
        table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32")])
        lengths = table["length"].to_numpy()
        bin_of, offset, bins = best_fit_decreasing(lengths, capacity)
        used = np.bincount(bin_of, weights=lengths, minlength=bins).astype(np.int64)
        part = table["part"][0].as_py()
        full = lambda value: pa.array(np.full(len(lengths), value, np.int64))
        out = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        for name, column in (
            ("sequence_id", pa.array((number << 56) + (part << 32) + bin_of)),
            ("offset", pa.array(offset)),
            ("part_bins", full(bins)),
            ("part_bound", full(lower_bound(lengths, capacity))),
            ("room", pa.array(capacity - used[bin_of])),
        ):
            out = out.append_column(name, column)
        return out

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    part = F.pmod(F.xxhash64(*columns, F.lit(number)), F.lit(parts))
    return pieces.select(*columns, part.alias("part")).groupBy("part").applyInArrow(pack, PACKED_SCHEMA)


def pack_pieces(pieces: DataFrame, capacity: int = 1024, per_part: int = 40_000, rounds: int = 3) -> DataFrame:
    """Place every piece (rows of PIECE_SCHEMA, already stored) in a sequence.

    Adds ``sequence_id``, ``offset`` and the certificate of the group that placed the piece:
    ``part_bins`` and ``part_bound`` (equal: proven best for that group).
    """
    # Repeated rows share a hash; a number within the copies would need a window, so groups
    # may be uneven by the copies of one very short document, whose pieces are small rows.
    placed = stash(_pack_round(pieces, parts_for(pieces.count(), per_part), 0, capacity), "pack-0")
    for number in range(1, rounds):
        gap = (F.col("room") > 0) & ((F.col("part_bins") > F.col("part_bound")) | (F.col("room") >= capacity // 32))
        loose = placed.where(gap)
        before = loose.agg(F.count("*").alias("n"), F.sum(F.when(F.col("offset") == 0, 1)).alias("bins")).first()
        if not before["n"]:
            break
        again = stash(_pack_round(loose, parts_for(before["n"], per_part), number, capacity), f"pack-{number}")
        if again.where(F.col("offset") == 0).count() >= before["bins"]:
            break
        placed = placed.where(~gap).unionByName(again)
    return placed


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, per_part: int = 40_000, rounds: int = 3) -> DataFrame:
    """Tokenize once, store the pieces, pack them."""
    pieces = stash(tokenize_pieces(docs, tokenizer, capacity, end_id), "pieces")
    return pack_pieces(pieces, capacity, per_part, rounds)
