"""JSON files that hold one array (or one object) each, read by many tasks.

Spark reads such a file whole in one task. Here the text is split at commas by byte range, as lines would be. A first
pass sums up each range: whether it has an odd number of quotes, and how it changes the depth if it begins outside or inside
a string. Prefix sums of these over a file's ranges give the state at every range's start, so that a second pass
knows which commas part elements of the array. Elements that lie in one range are parsed where they are read; those
that span ranges are put together from their parts, at most two a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root
from .envelope import JSON_OPTIONS

MAX_RANGES = 1_000_000  # what is broadcast: some 40 bytes a range
SPACES = b" \t\r\n"


def _scan(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """(file, range, first row, end row) of the runs of one range in a batch."""
    file, start = np.asarray(batch["file"]), np.asarray(batch["start"])
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)], strict=True):
        if a < b:
            yield int(file[a]), int(start[a]), a, b


def _bytes(batch: pa.RecordBatch, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' bytes with the commas between them, and where each row begins."""
    column = batch["value"].slice(a, b - a).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]]) if len(size) else np.zeros(0, np.int64)
    out = np.full(len(data) + max(len(size) - 1, 0), ord(","), np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(size)), size)] = data
    return out, begin


def _marks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: whether it is a quote that opens or closes a string, and its change of depth if outside of strings."""
    place = np.arange(len(text))
    other = np.maximum.accumulate(np.where(text != 92, place, -1))  # the last byte that is no backslash
    slashes = place - 1 - np.concatenate([[-1], other[:-1]]) if len(text) else place
    quote = (text == 34) & (slashes % 2 == 0)
    step = np.isin(text, (91, 123)).astype(np.int64) - np.isin(text, (93, 125))
    return quote, step


def _summaries(batches):
    """One row per range: first byte that is no space, odd number of quotes, change of depth from outside and inside of a string."""

    def row():
        values = {"file": at[0], "start": at[1], "first": first, "odd": odd, "outside": outside, "inside": inside}
        return pa.record_batch({k: pa.array([v], pa.int32() if k in ("first", "odd") else pa.int64()) for k, v in values.items()})

    at, first, odd, outside, inside = None, None, 0, 0, 0
    for batch in batches:
        for file, start, a, b in _scan(batch):
            if (file, start) != at:
                if at:
                    yield row()
                at, first, odd, outside, inside = (file, start), None, 0, 0, 0
            text, _ = _bytes(batch, a, b)
            quote, step = _marks(text)
            within = (np.cumsum(quote) + odd) % 2  # from outside: 1 in a string
            outside += int(step[within == 0].sum())
            inside += int(step[within == 1].sum())
            odd = (odd + int(quote.sum())) % 2
            if first is None:
                begun = text[~np.isin(text, list(SPACES))][:1]
                first = int(begun[0]) if len(begun) else None
    if at:
        yield row()


def _elements(batches):
    """Whole elements (``part`` null) and the parts of those that span ranges: 0 ends one, 1 begins one."""
    out = {"file": [], "start": [], "part": [], "text": []}

    def put(part):
        text = b"".join(held)
        if part is not None or text.strip(SPACES):
            for name, v in zip(out, (*at, part, text), strict=True):
                out[name].append(v)
        held.clear()

    def batch_of():
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        done = pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))
        for v in out.values():
            v.clear()
        return done

    at, held, begun, headed, within, depth, array, open_ = None, [], False, False, 0, 0, True, True
    for batch in batches:
        states = [np.asarray(batch[c]) for c in ("within", "depth", "array")]
        for file, start, a, b in _scan(batch):
            fresh = (file, start) != at
            if fresh:
                if at:
                    put(1 if begun else 0)
                at, begun = (file, start), False
                within, depth, array = int(states[0][a]), int(states[1][a]), bool(states[2][a])
                open_ = depth > 0 or start == 0
            text, begin = _bytes(batch, a, b)
            if not fresh:
                text, begin = np.concatenate([[np.uint8(44)], text]), begin + 1  # the comma between two batches
            quote, step = _marks(text)
            inside = (np.cumsum(quote) + within) % 2
            level = depth + np.cumsum(np.where(inside == 0, step, 0))
            # A row begins an element if the comma before it stands outside of strings, between elements.
            first = np.zeros(len(begin), bool)
            if fresh:
                first[0] = start == 0 or (array and within == 0 and depth == 1)
                headed = not first[0]
            later = np.arange(int(fresh), len(begin))
            if array and len(later):
                first[later] = (inside[begin[later] - 1] == 0) & (level[begin[later] - 1] == 1)
            keep = np.full(len(text), open_)
            if array and fresh and start == 0:
                opening = np.flatnonzero(level == 1)
                keep[: (opening[0] + 1) if len(opening) else len(text)] = False
            closing = np.flatnonzero((level == 0) & (step < 0) & (inside == 0)) if array else np.zeros(0, np.int64)
            if len(closing):
                keep[closing[0] :] = False
            whole = text.tobytes()
            cuts = begin[first].tolist()
            for k, (lo, hi) in enumerate(zip([0, *cuts], [*[c - 1 for c in cuts], len(text)], strict=True)):
                if k:
                    if begun:
                        put(None)
                    elif headed:
                        put(0)
                    begun = True
                if hi > lo:
                    held.append(whole[lo:hi] if keep[lo:hi].all() else text[lo:hi][keep[lo:hi]].tobytes())
            if len(text):
                within, depth = int(inside[-1]), int(level[-1])
            open_ = open_ and not len(closing)
        yield batch_of()
    if at:
        put(1 if begun else 0)
    yield batch_of()


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType | str, options: dict[str, str] | None = None) -> DataFrame:
    """One row per element of the arrays in the files (a file with one object: one row), with the declared schema.

    An element that does not parse gives NULLs, as does a field that does not convert. Files of several ranges are read by as many
    tasks; ``spark.sql.files.maxPartitionBytes`` sets the ranges.
    """
    text = spark.read.option("lineSep", ",").text(path)
    pieces = text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    ranges = pieces.mapInArrow(_summaries, "file long, start long, first int, odd int, outside long, inside long")
    checkpoint_root(spark)
    ranges = ranges.checkpoint()
    if ranges.count() > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges: read fewer files at once, or set larger ranges")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = ranges.withColumn("within", F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)))
    states = states.withColumn("change", F.when(F.col("within") == 0, F.col("outside")).otherwise(F.col("inside")))
    opens = F.first("first", ignorenulls=True).over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    states = states.select("file", "start", "within", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"), F.coalesce(opens == 91, F.lit(False)).alias("array"))
    known = pieces.join(F.broadcast(states), ["file", "start"], "left")  # keeps the order of the pieces
    state = F.when(F.col("within").isNull(), F.raise_error(F.lit("the files' ranges have changed between the two passes"))).otherwise(F.col("within"))
    parts = known.withColumn("within", state.cast("int")).mapInArrow(_elements, "file long, start long, part int, text binary")
    whole = parts.where(F.col("part").isNull()).select("text")
    torn = parts.where(F.col("part").isNotNull())
    number = F.sum("part").over(Window.partitionBy("file").orderBy("start", "part"))
    joined = torn.withColumn("n", number).groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("parts"))
    joined = joined.select(F.array_join(F.transform("parts", lambda p: p["text"].cast("string")), ",").alias("text"))
    elements = whole.select(F.col("text").cast("string").alias("text")).unionByName(joined).where(F.trim(F.regexp_replace("text", r"[\t\r\n]", " ")) != "")
    return elements.select(F.inline(F.array(F.from_json("text", schema, {**JSON_OPTIONS, **(options or {})}))))
