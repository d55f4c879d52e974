"""Repeated passages: bytes covered by a string of ``length`` bytes that also starts in a document with a smaller id.

The longest previous factor of a position (the longest string from there that also starts in an earlier document) is
found in suffix order: of all positions between the nearest one before and the nearest one after with a smaller
document, none is earlier, so the longer common prefix with these two is it. A position counts if its
factor has ``length`` bytes or more; the union of the strings from there goes, the first document's copy stays.

The suffixes are dealt out so that equal strings of ``length`` bytes meet in one task: by the least hash among a string's
``ANCHOR``-byte substrings, which depends on nothing but the string. Consecutive positions with one anchor travel
as one run of text.

1. Texts are shuffled once, into blocks by a hash of the row (``BLOCK_BYTES``). Each block sends the hashes of its
   anchors, each once with its number of occurrences, to buckets of hashes; those found in more than one document
   return to their blocks. Others can hold no repeated string.
2. Blocks send the runs of returned anchors; equal runs of a block are one, with its smallest document, so a group of copies or a
   common passage is as many rows as there are blocks. Anchors with more than ``HOT`` occurrences, whose runs
   differ around them, are cut into single positions dealt out by their whole string.
3. Buckets put the positions of their runs in suffix order, in slices of whole anchors, and mark the positions whose factor
   is long enough; marks return to the blocks, which cut the texts.

Steps are one lazy plan: the blocks' exchange is read three times, and lost executors are recovered from it. Every
count and comparison is exact for strings; hashes only deal out, and group equal runs by 128 bits.

Defined results: a null text is empty; an empty table gives no rows. Rows with a null id match nothing. Repeated ids are one
document, each row cut for itself. Texts are taken whole, of any length; strings may start inside a character, so
what remains is bytes. Other columns do not travel: names cannot clash, and the id joins the result back. Rows equal in
id and text share a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for
from .words import U, hash_spans, mix, powers, prefix_sums, slices

LENGTH = 50
ANCHOR = 20
BLOCK_BYTES = 4 << 20
BUCKET_ANCHORS = 1 << 20
HOT = 4096
SLICE = 300_000  # suffixes sorted at once; one anchor's are never parted
MANY = np.uint16(1 << 15)  # marks an anchor that several documents of a block hold

ANCHOR_ROWS = "bucket int, block long, anchors binary, counts binary"
RUN_ROWS = "bucket int, block long, ids binary, anchors binary, docs binary, lengths binary, text binary"
NOTE_ROWS = "block long, bucket int, numbers binary, marks binary"
RESULT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def _raw(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _starts(sorted_columns: list[np.ndarray]) -> np.ndarray:
    """True where a row of the sorted columns differs from the one before."""
    new = np.zeros(len(sorted_columns[0]), bool)
    new[:1] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def window_runs(buf: np.ndarray, offsets: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, n, anchor): runs of at most ``length - k + 1`` consecutive positions of one text whose strings of ``length``
    bytes have the same least hash of a ``k``-byte substring."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(buf) < length:
        return none
    sums, (_, down) = prefix_sums(buf), powers(len(buf) + 1)
    least, width, most = mix((sums[k:] - sums[:-k]) * down[: len(buf) - k + 1]), 1, length - k + 1
    while width * 2 <= most:
        least, width = np.minimum(least[:-width], least[width:]), width * 2
    if width < most:
        least = np.minimum(least[: width - most], least[most - width :])
    inside = np.zeros(len(buf) + 1, np.int32)  # positions whose string ends in their own text
    ends = offsets[1:] - length + 1
    held = ends > offsets[:-1]
    np.add.at(inside, offsets[:-1][held], 1)
    np.add.at(inside, ends[held], -1)
    inside = np.cumsum(inside)[: len(least)] > 0
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new)
    stops = np.flatnonzero(inside & np.append(~inside[1:] | new[1:], True)) + 1
    pieces = -(-(stops - starts) // most)
    place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(starts, pieces) + place * most
    return begin, np.minimum(np.repeat(stops, pieces) - begin, most), least[begin]


class Block:
    """The texts of a block, and the runs of its anchors."""

    def __init__(self, rows: pa.Table, buckets: int, length: int):
        self.ids = rows["doc_id"].combine_chunks()
        self.length = length
        text = rows["text"].combine_chunks()
        known = np.array(self.ids.is_valid())
        bufs, offs, runs, base = [], [np.zeros(1, np.int64)], [], 0
        for _, _, buf, offsets in slices(text):
            bufs.append(buf)
            offs.append(offsets[1:] + base)
            start, n, anchor = window_runs(buf, offsets, length, ANCHOR)
            runs.append((start + base, n, anchor, hash_spans(buf, start, start + n + length - 1)))
            base += len(buf)
        self.buf, self.offsets = np.concatenate([*bufs, np.zeros(0, np.uint8)]), np.concatenate(offs)
        start, n, anchor, content = (np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, t) for k, t in enumerate((np.int64, np.int64, np.uint64, np.uint64)))
        row = np.searchsorted(self.offsets, start, "right") - 1
        mine = known[row] if len(row) else np.zeros(0, bool)
        self.start, self.n, self.content, self.row = start[mine], n[mine], content[mine], row[mine]
        self.doc = np.asarray(self.ids.fill_null(0).cast(pa.int64()))[self.row]
        self.bucket, self.anchor = deal(anchor[mine], buckets)

    def anchors(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, anchors, counts) with each anchor once; ``MANY`` is set where several documents hold it."""
        order = np.lexsort((self.doc, self.anchor, self.bucket))
        bucket, anchor, doc = self.bucket[order], self.anchor[order], self.doc[order]
        first = np.flatnonzero(_starts([bucket, anchor]))
        last = np.append(first[1:], len(order)) - 1
        count = np.minimum(last - first + 1, int(MANY) - 1).astype(np.uint16) | np.where(doc[first] != doc[last], MANY, 0).astype(np.uint16)
        bucket, anchor = bucket[first], anchor[first]
        cuts = np.append(np.flatnonzero(_starts([bucket])), len(bucket))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(bucket[a]), anchor[a:b], count[a:b]

    def keep_repeated(self, notes: pa.Table, buckets: int) -> None:
        """Keep the runs of anchors that returned, those of hot ones as single positions, and group equal ones."""
        keys, hot = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
        for bucket, numbers, marks in zip(*(notes[c].to_pylist() for c in ("bucket", "numbers", "marks")), strict=True):
            keys.append((U(bucket) << U(32)) | np.frombuffer(numbers, np.uint32).astype(np.uint64))
            hot.append(np.frombuffer(marks, np.uint8) > 0)
        keys, hot = np.concatenate(keys), np.concatenate(hot)
        order = np.argsort(keys)
        keys, hot = keys[order], hot[order]
        own = (self.bucket.astype(np.uint64) << U(32)) | self.anchor
        at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
        found = keys[at] == own if len(keys) else np.zeros(len(own), bool)
        single = found & hot[at] if len(keys) else found
        plain = found & ~single
        n = self.n[single]
        start = np.repeat(self.start[single], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        content = self._contents(start)
        bucket, anchor = deal(content, buckets)
        join = lambda a, b: np.concatenate([a, b])
        self.start, self.n = join(self.start[plain], start), join(self.n[plain], np.ones(len(start), np.int64))
        self.content, self.doc = join(self.content[plain], content), join(self.doc[plain], np.repeat(self.doc[single], n))
        self.bucket, self.anchor = join(self.bucket[plain], bucket), join(self.anchor[plain], anchor)
        order = np.lexsort((self.start, self.doc, self.n, self.content, self.anchor, self.bucket))
        for name in ("start", "n", "content", "doc", "bucket", "anchor"):
            setattr(self, name, getattr(self, name)[order])
        new = _starts([self.bucket, self.anchor, self.content, self.n])
        self.first = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1

    def _contents(self, start: np.ndarray) -> np.ndarray:
        """Hashes of the strings of ``length`` bytes at ``start``, in whole texts at a time."""
        out, order = np.zeros(len(start), np.uint64), np.argsort(start, kind="stable")
        lo = 0
        while lo < len(order):
            base = start[order[lo]]
            hi = max(lo + 1, int(np.searchsorted(start[order], base + (1 << 19))))
            part = order[lo:hi]
            end = int(start[part[-1]]) + self.length
            out[part] = hash_spans(self.buf[base:end], start[part] - base, start[part] - base + self.length)
            lo = hi
        return out

    def runs(self) -> Iterator[tuple]:
        """One row a bucket: the groups' numbers, anchors, smallest documents, lengths and texts."""
        bucket = self.bucket[self.first]
        cuts = np.append(np.flatnonzero(_starts([bucket])), len(bucket))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            f = self.first[a:b]
            size = self.n[f] + self.length - 1
            at = np.repeat(self.start[f], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield int(bucket[a]), _raw(np.arange(a, b, dtype=np.uint32)), _raw(self.anchor[f].astype(np.uint32)), _raw(self.doc[f]), _raw(self.n[f].astype(np.uint8)), _raw(self.buf[at])

    def cut(self, marks: np.ndarray) -> pa.Table:
        """The result rows; ``marks``: for each group a bit for every position that has an earlier document."""
        every = (np.int64(1) << self.n) - 1
        bits = np.where(self.doc > self.doc[self.first][self.group], every, marks[self.group].astype(np.int64)) if len(self.first) else every
        gone = np.zeros(len(self.buf) + 1, np.int32)
        for k in range(int(self.n.max(initial=0))):
            at = self.start[(bits >> k) & 1 > 0] + k
            gone += np.bincount(at, minlength=len(gone)).astype(np.int32) if len(at) else 0
            np.subtract.at(gone, at + self.length, 1)
        gone = np.cumsum(gone)[:-1] > 0
        edge = np.zeros(len(gone) + 1, bool)
        edge[self.offsets] = True
        start = np.flatnonzero(gone & np.append(True, ~gone[:-1] | edge[1:-1])[: len(gone)])
        end = np.flatnonzero(gone & np.append(~gone[1:] | edge[1:-1], True)[: len(gone)]) + 1
        row = np.searchsorted(self.offsets, start, "right") - 1
        own = self.offsets[row]
        spans = pa.StructArray.from_arrays([pa.array(start - own), pa.array(end - own)], ["start", "end"])
        size = np.diff(self.offsets)
        removed = np.zeros(len(size) + 1, np.int64)
        np.add.at(removed[:-1], row, end - start)
        kept = self.buf[~gone]
        offsets = np.concatenate([[0], np.cumsum(size - removed[:-1])])
        binary = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(kept)]).cast(pa.binary())
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(size) + 1)).astype(np.int32)), spans)
        return pa.table({"doc_id": self.ids, "n_bytes": pa.array(size), "spans": lists, "kept": binary})


def deal(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 32 more bits) of hashes."""
    key = mix(hashes ^ U(0xA5A5A5A55A5A5A5A))
    return ((key & U(0xFFFFFFFF)) % U(buckets)).astype(np.int64), key >> U(32)


def nearest_smaller(docs: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """For each place of a suffix order, the common prefix with the nearest place before it that has a smaller document
    (0 where there is none, or less than ``least``); ``lcp[i]`` is that of places i-1 and i. By pointer jumping."""
    n = len(docs)
    to, common = np.arange(n) - 1, lcp.copy()
    if n:
        common[0] = 0
    out = np.zeros(n, lcp.dtype)
    todo = np.flatnonzero(common >= least)
    while len(todo):
        there = to[todo]
        found = docs[there] < docs[todo]
        out[todo[found]] = common[todo[found]]
        todo, there = todo[~found], there[~found]
        on, through = to[there], np.minimum(common[todo], common[there])
        to[todo], common[todo] = on, through
        todo = todo[(through >= least) & (on >= 0)]
    return out


def long_factors(buf: np.ndarray, at: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """The longest previous factor, up to ``length``, of each of the positions ``at`` (0 where it is shorter).

    ``buf`` has 8 bytes or more after the last string. Positions are put in suffix order by words of 8 bytes, then by document.
    """
    at8 = np.ndarray((len(buf) - 7,), ">u8", buffer=buf, strides=(1,))
    words = []
    for w in range(0, length, 8):
        word = at8[at + w].astype(np.uint64)
        words.append(word >> U(8 * (w + 8 - length)) << U(8 * (w + 8 - length)) if w + 8 > length else word)
    order = np.lexsort((docs, *reversed(words)))
    lcp, open_ = np.zeros(len(at), np.int16), np.ones(max(len(at) - 1, 0), bool)
    for k, word in enumerate(words):
        apart = word[order][1:] ^ word[order][:-1]
        size = min(8, length - 8 * k)
        same = sum((apart < U(1 << (64 - 8 * b))).astype(np.int16) for b in range(1, 8)) + (apart == 0)
        lcp[1:] += np.where(open_, np.minimum(same, size), 0).astype(np.int16)
        open_ &= apart == 0
    ranked = docs[order]
    before = nearest_smaller(ranked, lcp, length)
    after = nearest_smaller(ranked[::-1], np.append(lcp[1:], 0)[::-1], length)[::-1]
    out = np.zeros(len(at), np.int16)
    out[order] = np.maximum(before, after)
    return out


def mark_runs(anchors: np.ndarray, docs: np.ndarray, n: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """For each run of a bucket, a bit for every position whose string starts in an earlier document too."""
    size = n + length - 1
    offset = np.cumsum(size) - size
    content = np.zeros(len(n), np.uint64)
    cuts = [0, *(np.flatnonzero(np.diff(offset >> 19)) + 1).tolist(), len(n)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a < b:
            base = offset[a]
            content[a:b] = hash_spans(text[base : offset[b - 1] + size[b - 1]], offset[a:b] - base, offset[a:b] - base + size[a:b])
    order = np.lexsort((docs, n, content, anchors))
    new = _starts([anchors[order], content[order], n[order]])
    first = order[new]
    group = np.cumsum(new) - 1
    marks = np.zeros(len(first), np.int64)
    total = np.cumsum(n[first])
    whole = np.append(np.flatnonzero(_starts([anchors[first]]))[1:], len(first))  # ends of anchors
    lo = 0
    padded = np.append(text, np.zeros(64, np.uint8))
    while lo < len(first):
        reach = np.searchsorted(total, (total[lo - 1] if lo else 0) + SLICE, "right")
        k = np.searchsorted(whole, reach, "right") - 1
        hi = int(whole[k]) if k >= 0 and whole[k] > lo else int(whole[np.searchsorted(whole, lo, "right")])
        part = first[lo:hi]
        run = np.repeat(np.arange(hi - lo), n[part])
        place = np.arange(len(run)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        long = long_factors(padded, offset[part][run] + place, docs[part][run], length) >= length
        np.add.at(marks, lo + run[long], np.int64(1) << place[long])
        lo = hi
    out = np.zeros(len(n), np.int64)
    out[order] = np.where(docs[order] > docs[first][group], (np.int64(1) << n[order]) - 1, marks[group])
    return out.astype(np.uint32)


def _repeated_anchors(rows: pa.Table) -> pa.Table:
    """Of a bucket: to each block, its anchors that several documents hold, and whether they are hot."""
    blocks, bucket = rows["block"].to_pylist(), rows["bucket"][0].as_py()
    anchors = [np.frombuffer(x, np.uint32) for x in rows["anchors"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint16) for x in rows["counts"].to_pylist()])
    _, key, held = np.unique(np.concatenate(anchors), return_inverse=True, return_counts=True)
    several = (held > 1) | (np.bincount(key, (counts & MANY) > 0) > 0)
    hot = np.bincount(key, counts & (MANY - np.uint16(1))) > HOT
    out, lo = {"block": [], "bucket": [], "numbers": [], "marks": []}, 0
    for block, own in zip(blocks, anchors, strict=True):
        k = key[lo : lo + len(own)]
        lo += len(own)
        if several[k].any():
            out["block"].append(block)
            out["bucket"].append(bucket)
            out["numbers"].append(_raw(own[several[k]]))
            out["marks"].append(_raw(hot[k[several[k]]].astype(np.uint8)))
    return _notes(out)


def _notes(columns: dict) -> pa.Table:
    return pa.table({"block": pa.array(columns["block"], pa.int64()), "bucket": pa.array(columns["bucket"], pa.int32()), "numbers": pa.array(columns["numbers"], pa.binary()), "marks": pa.array(columns["marks"], pa.binary())})


def remove_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, bucket_anchors: int = BUCKET_ANCHORS) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (removed [start, end) bytes) and ``kept`` (the bytes that stay) of each row.

    ``length`` is at least 29 (``ANCHOR`` and a window of 10) and at most 51 (a run's positions fit 32 bits).
    """
    if not ANCHOR + 9 <= length <= ANCHOR + 31:
        raise ValueError(f"length must be from {ANCHOR + 9} to {ANCHOR + 31}")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = parts_for(total, block_bytes)
    buckets = parts_for(2 * total // (length - ANCHOR + 2), bucket_anchors)  # about 2 anchors in a window and one
    texts = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(blocks, "block")

    def send_anchors(rows: pa.Table) -> pa.Table:
        block = rows["block"][0].as_py()
        found = [(b, block, _raw(a.astype(np.uint32)), _raw(c)) for b, a, c in Block(rows, buckets, length).anchors()]
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "block", "anchors", "counts"])

    def send_runs(rows: pa.Table, notes: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and notes.num_rows:
            block = Block(rows, buckets, length)
            block.keep_repeated(notes, buckets)
            number = rows["block"][0].as_py()
            found = [(b, number, *rest) for b, *rest in block.runs()]
        columns = list(zip(*found, strict=True)) or [[]] * 7
        types = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "block", "ids", "anchors", "docs", "lengths", "text"])

    def mark(rows: pa.Table) -> pa.Table:
        whole = lambda name, kind: np.frombuffer(b"".join(rows[name].to_pylist()), kind)
        n = whole("lengths", np.uint8).astype(np.int64)
        marks = mark_runs(whole("anchors", np.uint32), whole("docs", np.int64), n, whole("text", np.uint8), length)
        ids, lo, out = rows["ids"].to_pylist(), 0, {"block": rows["block"].to_pylist(), "bucket": [-1] * rows.num_rows, "numbers": rows["ids"].to_pylist(), "marks": []}
        for x in ids:
            out["marks"].append(_raw(marks[lo : lo + len(x) // 4]))
            lo += len(x) // 4
        return _notes(out)

    def cut(rows: pa.Table, notes: pa.Table) -> pa.Table:
        block = Block(rows, buckets, length)
        kind = np.asarray(notes["bucket"]) if notes.num_rows else np.zeros(0, np.int32)
        block.keep_repeated(notes.filter(pa.array(kind >= 0)), buckets)
        marks = np.zeros(len(block.first), np.uint32)
        for numbers, bits in zip(*(notes.filter(pa.array(kind < 0))[c].to_pylist() for c in ("numbers", "marks")), strict=True):
            marks[np.frombuffer(numbers, np.uint32)] = np.frombuffer(bits, np.uint32)
        return block.cut(marks)

    by_block = texts.groupBy("block")
    anchors = by_block.applyInArrow(send_anchors, ANCHOR_ROWS)
    notes = anchors.groupBy("bucket").applyInArrow(_repeated_anchors, NOTE_ROWS).repartition(blocks, "block")
    runs = by_block.cogroup(notes.groupBy("block")).applyInArrow(send_runs, RUN_ROWS)
    marks = runs.groupBy("bucket").applyInArrow(mark, NOTE_ROWS)
    return by_block.cogroup(notes.unionByName(marks).groupBy("block")).applyInArrow(cut, RESULT)
