"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

Every source gets a share of the budget by its weight; a source whose share is above
``max_epochs`` times its size is clamped there, and the excess goes to the others by weight, until none is above.
A source is then repeated whole as often as its target allows, and the remaining fraction is a
seeded sample of its documents: systematic over documents ordered by size, in slots of bounded
size, with the offset (of a few) that comes nearest the slot's share. Then the document
whose size is nearest to the words still missing joins (or one leaves, if there are too many), up to ``FILLS`` times,
as long as that brings the slot nearer to its share.

Defined results: a null text has size 0; a null source is a source of its own, after all others; sources of
size 0 get target 0; repeated rows are documents of their own; an empty table gives no rows. Ties in size
go by the seeded hash, so reruns agree. Very long texts are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, stash

WORD = r"[^\x20\x09-\x0D]+"
OFFSETS = 32
SLOT_ROWS = 8192
FILLS = 6


def word_count(name: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame, per_part: int = 100_000) -> DataFrame:
    """One row per source with its ``rank`` from 0 in code point order, null last.

    Ranks are counted within ranges of sources, plus the rows of the ranges before: no task holds all sources.
    """
    parts = parts_for(sizes.count(), per_part)
    order = F.col("source").asc_nulls_last()
    ranged = sizes.repartitionByRange(parts, order) if parts > 1 else sizes.coalesce(1)
    ranged = stash(ranged.withColumn("part", F.spark_partition_id()), "sources")
    ranges = ranged.groupBy("part").agg(F.count("*").alias("n"))  # a row per range
    before = ranges.withColumn("before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    joined = ranged.withColumn("within", within).join(before.drop("n"), "part")
    return joined.withColumn("rank", F.col("within") + F.coalesce("before", F.lit(0))).drop("part", "within", "before")


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Adds ``target`` to sources with ``source_size`` and ``weight``; the targets add up to budget x all sizes.

    One number, the budget per weight of the sources not clamped, is all that a round hands on.
    """
    sources = stash(sources, "weights")
    cap = F.col("source_size") * F.lit(max_epochs)
    whole = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if whole["size"] is None:
        return sources.withColumn("target", F.lit(0.0))
    total = budget * whole["size"]
    level, clamped = total / whole["weight"], -1
    while True:  # each round clamps more sources, or it is the last
        above = cap < F.lit(level) * F.col("weight")
        state = sources.agg(
            F.sum(F.when(above, cap).otherwise(0.0)).alias("clamped"), F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("free"), F.count(F.when(above, 1)).alias("n")
        ).first()
        if not state["free"] or state["n"] == clamped:
            break
        level, clamped = (total - state["clamped"]) / state["free"], state["n"]
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")).cast("double"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, max_epochs: int = 2, seed: int = 17) -> DataFrame:
    """``docs`` (doc_id, text, source, more) plus ``size``, ``source_size``, ``target``, ``reps`` and ``taken``.

    ``reps`` is how often the mix takes the document, ``taken`` the words that makes. These five replace
    columns of the same name; all other columns travel along.
    """
    prefix = "_mix"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    own = {c: f"{prefix}_{c}" for c in ("src", "rank", "slot", "slots", "whole", "fraction", "place", "draw", "misses", "extra", "left")}
    col = lambda name: F.col(own[name])
    docs = docs.drop("size", "source_size", "target", "reps", "taken").withColumn("size", word_count())
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = ranked_sources(sizes).withColumn("weight", weight)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = water_fill(sources, budget, max_epochs).select(
        F.col("source").alias(own["src"]),
        F.col("rank").alias(own["rank"]),
        "source_size",
        "target",
        F.floor(ratio).cast("long").alias(own["whole"]),
        (ratio - F.floor(ratio)).alias(own["fraction"]),
        F.ceil(F.col("n_docs") / SLOT_ROWS).cast("long").alias(own["slots"]),
    )
    # Spark measures the sources when they are made and broadcasts them only if they are small
    rows = docs.join(sources, docs["source"].eqNullSafe(sources[own["src"]]))
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).cast("binary"))
    rows = rows.withColumn(own["draw"], draw).withColumn(own["slot"], F.conv(F.substring(own["draw"], 1, 8), 16, 10).cast("long") % col("slots"))
    place = F.row_number().over(Window.partitionBy(own["rank"], own["slot"]).orderBy(F.desc("size"), own["draw"]))
    rows = rows.withColumn(own["place"], place)

    def extra(k: int | Column) -> Column:
        start = (F.lit(k) + F.lit(0.5)) / F.lit(float(OFFSETS)) if isinstance(k, int) else (k + F.lit(0.5)) / F.lit(float(OFFSETS))
        upto = lambda i: F.floor(i * col("fraction") + start)
        return (upto(col("place")) - upto(col("place") - 1)).cast("long")

    # same partitions as above, so no further shuffle
    slot = Window.partitionBy(own["rank"], own["slot"])
    share = col("fraction") * F.sum("size").over(slot)
    miss = [F.abs(F.sum(extra(k) * F.col("size")).over(slot) - share) for k in range(OFFSETS)]
    rows = rows.withColumn(own["misses"], F.array(*miss))
    rows = rows.withColumn(own["extra"], extra(F.array_position(own["misses"], F.array_min(own["misses"])) - 1))
    rows = rows.withColumn(own["left"], share - F.sum(col("extra") * F.col("size")).over(slot)).drop(own["misses"])
    for _ in range(FILLS):
        # the document nearest to the words that are missing joins the slot's extra ones, or, if there are too many words, one leaves
        over, gap = col("left") < 0, F.abs(F.abs(col("left")) - F.col("size"))
        helps = (F.col("size") > 0) & (gap < F.abs(col("left"))) & (col("extra") == F.when(over, 1).otherwise(0))
        this = F.struct(gap.alias("gap"), col("place").alias("place"), F.col("size").alias("size"))
        rows = rows.withColumn(own["misses"], F.min(F.when(helps, this)).over(slot))
        turn = F.when(over, F.lit(-1)).otherwise(F.lit(1))
        chosen = F.coalesce(F.col(f"{own['misses']}.place") == col("place"), F.lit(False))
        rows = rows.withColumns({
            own["extra"]: col("extra") + F.when(chosen, turn).otherwise(0),
            own["left"]: col("left") - turn * F.coalesce(F.col(f"{own['misses']}.size"), F.lit(0)),
        }).drop(own["misses"])
    rows = rows.withColumn("reps", col("whole") + col("extra"))
    return rows.withColumn("taken", F.col("reps") * F.col("size")).drop(*own.values())


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    return mixed.where("reps > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("reps")))).drop("copy")
