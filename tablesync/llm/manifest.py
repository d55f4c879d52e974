"""Merkle manifest of a dataset: every row a leaf, a binary tree per group of rows, a tree over the groups' roots.

Nodes carry the interval [lo, hi) of leaf ranks they cover. Trees are built in strata of ``bits`` levels: the nodes of a
stratum's lowest level whose intervals lie in one interval of ``2^bits`` of them form a bucket, one row with all the
bucket's nodes by level. A bucket's top node is a node of the next stratum; containment joins between
the level buckets of two strata attach the ancestors, and a node's sibling is what its parent's interval
holds besides its own. So a tree of n leaves takes log(n)/bits shuffles, of n, n/2^bits, ... rows.

A leaf is the SHA-256 (lowercase hex) of its fields one after the other, each ``-`` if null, else its number of UTF-8 bytes, a
colon and its value. While a level has more than one node, every two consecutive ones (the last alone, if odd) are
hashed into one of the next level; a lone leaf is its tree's root itself.

Defined results: leaves ascend by ``order`` (nulls first), ties by the leaf's digest, so repeated rows, whose leaves are equal,
give the same digests in any order. A null group is a group of its own, before all others. Empty and very long texts are
hashed as they are, in the JVM; no task holds more than one text. An empty table has no nodes and gives no
rows. Columns that are neither fields nor ``keep`` do not travel, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stash

BITS = 10
#: One step of the way to the root: the sibling's digest (null: the node is alone in its run) and whether it comes first.
STEP = T.StructType([T.StructField("digest", T.StringType()), T.StructField("first", T.BooleanType())])


def row_digest(fields: Sequence[Column]) -> Column:
    """The leaf of a row: SHA-256 of its fields, each with its length, so that no two rows are written alike."""
    parts = []
    for c in fields:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _power(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))


def _ranked(leaves: DataFrame) -> DataFrame:
    """Number the leaves of each tree: (tree, lo, hi, digest, total, own), with lo their rank.

    The rows are dealt out by range and sorted, so a tree spreads over many tasks; a rank is the place within a part plus
    the sizes of the tree's parts before it. A random last key splits rows that are all alike.
    """
    n = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["tree", "sort", "digest"]
    dealt = leaves.withColumn("_draw", F.rand(7)).repartitionByRange(n, *key, "_draw").sortWithinPartitions(*key)
    placed = stash(dealt.select("tree", "digest", "own", F.monotonically_increasing_id().alias("at")), "leaves")
    part = F.shiftright("at", 33).alias("part")
    by_part = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("tree", part)
        .agg(F.min("at").alias("start"), F.count("*").alias("n"))
        .select("tree", "part", "start", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("tree")).alias("total"))
    )
    lo = (F.col("at") - F.col("start") + F.col("before")).alias("lo")
    numbered = placed.withColumn("part", part).join(parts, ["tree", "part"])
    return numbered.select("tree", lo, (lo + 1).alias("hi"), "digest", "total", "own")


def _parent(a: Column, b: Column) -> Column:
    digest = F.sha2(F.concat(a["digest"], F.coalesce(b["digest"], F.lit(""))).cast("binary"), 256)
    return F.struct(a["lo"].alias("lo"), F.coalesce(b["hi"], a["hi"]).alias("hi"), digest.alias("digest"))


def _next_level(nodes: Column) -> Column:
    last = ((F.size(nodes) + 1) / 2).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: _parent(F.get(nodes, 2 * i), F.get(nodes, 2 * i + 1)))


def _stratum(nodes: DataFrame, s: int, bits: int) -> DataFrame:
    """The buckets of stratum ``s``: (tree, total, bucket, nodes, levels), one row of at most 2^bits nodes and their ancestors."""
    held = nodes.where(F.col("total") > (1 << (s * bits))).groupBy("tree", "total", F.shiftright("lo", bits * (s + 1)).alias("bucket"))
    rows = held.agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", "own"))).alias("nodes"))
    bare = F.transform("nodes", lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest")))

    def grow(levels: Column, j: Column) -> Column:
        more = F.col("total") > _power(j + (s * bits))
        return F.when(more, F.concat(levels, F.array(_next_level(F.element_at(levels, -1))))).otherwise(levels)

    levels = F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), F.array(bare), grow)
    return stash(rows.withColumn("levels", levels), f"stratum-{s}")


def _top(stratum: DataFrame) -> DataFrame:
    """The buckets' top nodes, which are nodes of the next stratum, or the root of their tree."""
    top = F.get(F.element_at("levels", -1), F.lit(0))
    return stratum.select("tree", top["lo"].alias("lo"), top["hi"].alias("hi"), top["digest"].alias("digest"), "total")


def _steps(s: int, bits: int) -> Column:
    """For each node of the bucket: itself and its siblings up to the bucket's top, by the difference of intervals."""
    base = F.get(F.get(F.col("levels"), F.lit(0)), F.lit(0))["lo"]

    def sibling(lo: Column, j: Column) -> Column:
        unit = _power(j + (s * bits))
        place = lambda rank, size: F.floor((rank - base) / size).cast("int")
        own = F.get(F.get(F.col("levels"), j), place(lo, unit))
        parent = F.get(F.get(F.col("levels"), j + 1), place(lo, unit * 2))
        before = own["lo"] > parent["lo"]
        start, end = F.when(before, parent["lo"]).otherwise(own["hi"]), F.when(before, own["lo"]).otherwise(parent["hi"])
        digest = F.when(start < end, F.get(F.get(F.col("levels"), j), place(start, unit))["digest"])
        return F.struct(digest.alias("digest"), before.alias("first"))

    heights = F.when(F.size("levels") > 1, F.sequence(F.lit(0), F.size("levels") - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform("nodes", lambda x: F.struct(x["lo"].alias("lo"), x["digest"].alias("digest"), x["own"].alias("own"), F.transform(heights, lambda j: sibling(x["lo"], j)).alias("path")))


def _build(leaves: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """(strata, roots) of all trees; roots are (tree, digest)."""
    height = leaves.agg(F.max("total")).first()[0] or 0
    strata, roots, nodes = [], leaves.where("total = 1").select("tree", "digest"), leaves
    empty = F.lit(None).cast(leaves.schema["own"].dataType).alias("own")
    while height > (1 << (len(strata) * bits)):
        s = len(strata)
        strata.append(_stratum(nodes, s, bits))
        top = _top(strata[-1])
        roots = roots.unionByName(top.where(F.col("total") <= (1 << ((s + 1) * bits))).select("tree", "digest"))
        nodes = top.select("*", empty)
    return strata, roots


def _paths(strata: list[DataFrame], leaves: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """(tree, digest, own, path) of every leaf; ``above`` (tree, root_path) continues each tree's way."""
    up = None
    for s in reversed(range(len(strata))):
        rows = strata[s].join(above, "tree")
        rest = F.col("root_path")
        if up is not None:  # containment of the bucket's top node in a bucket of the next stratum, by their level's number
            top = F.get(F.element_at("levels", -1), F.lit(0))
            rows = rows.withColumn("up_at", F.shiftright(top["lo"], bits * (s + 1)))
            rows = rows.join(up, ["tree", "up_at"], "left")
            rest = F.when(F.col("total") > (1 << ((s + 1) * bits)), F.col("up_path")).otherwise(rest)
        each = rows.select("tree", F.explode(_steps(s, bits)).alias("n"), rest.alias("rest"))
        path = F.concat("n.path", "rest").alias("path")
        if s:
            up = each.select("tree", F.shiftright("n.lo", bits * s).alias("up_at"), path.alias("up_path"))
        else:
            paths = each.select("tree", "n.digest", "n.own", path)
    alone = leaves.where("total = 1").join(above, "tree").select("tree", "digest", "own", F.col("root_path").alias("path"))
    return alone.unionByName(paths) if strata else alone


def merkle_manifest(rows: DataFrame, fields: Sequence[str], group: str, order: str, keep: Sequence[Column] = (), bits: int = BITS) -> DataFrame:
    """Each row's way to the root of the whole dataset.

    Returns the ``keep`` columns, ``leaf``, ``subroot`` (its group's root), ``root`` and ``path``, the siblings from the leaf
    to the root (``STEP``). ``fields`` are hashed in their order; ``group`` names the trees, ordered by its bytes under the root.
    """
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("tree")
    own = F.struct(*keep).alias("own") if keep else F.struct(F.lit(True).alias("_none")).alias("own")
    leaves = rows.select(tree, F.col(order).alias("sort"), row_digest([F.col(c) for c in fields]).alias("digest"), own)
    leaves = stash(_ranked(leaves), "ranked")
    strata, roots = _build(leaves, bits)
    roots = stash(roots, "subroots")

    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("sort"), "digest", F.struct("tree").alias("own"))
    tops = stash(_ranked(tops), "ranked-roots")
    top_strata, root = _build(tops, bits)
    nothing = root.select("tree", F.array().cast(T.ArrayType(STEP)).alias("root_path"))
    above = _paths(top_strata, tops, nothing, bits).select("own.tree", F.col("digest").alias("subroot"), F.col("path").alias("root_path"))
    found = root.first()
    above = stash(above.withColumn("root", F.lit(found["digest"] if found else None).cast("string")), "root-paths")

    paths = _paths(strata, leaves, above.select("tree", "root_path"), bits).join(above.select("tree", "subroot", "root"), "tree")
    kept = [F.col(f"own.{c}") for c in leaves.schema["own"].dataType.names] if keep else []
    return paths.select(*kept, F.col("digest").alias("leaf"), "subroot", "root", "path")


def manifest_nodes(rows: DataFrame, fields: Sequence[str], group: str, order: str, bits: int = BITS) -> DataFrame:
    """The nodes of all groups' trees: (``group``, level, lo, hi, digest), level 0 the leaves, the last one the subroot."""
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("tree")
    leaves = rows.select(tree, F.col(order).alias("sort"), row_digest([F.col(c) for c in fields]).alias("digest"), F.struct(F.lit(True).alias("_none")).alias("own"))
    leaves = stash(_ranked(leaves), "ranked")
    strata, _ = _build(leaves, bits)
    out = leaves.select("tree", F.lit(0).alias("level"), "lo", "hi", "digest")
    for s, stratum in enumerate(strata):
        each = stratum.select("tree", F.posexplode("levels").alias("j", "nodes")).where("j > 0")
        out = out.unionByName(each.select("tree", (F.col("j") + s * bits).alias("level"), F.inline("nodes")))
    return out.select(F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias(group), "level", "lo", "hi", "digest")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path's siblings give."""

    def up(acc: Column, step: Column) -> Column:
        sibling = F.coalesce(step["digest"], F.lit(""))
        both = F.when(step["first"], F.concat(sibling, acc)).otherwise(F.concat(acc, sibling))
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """SHA-256 of the path's siblings from the leaf to the root."""
    siblings = F.filter(F.transform(path, lambda x: x["digest"]), lambda x: x.isNotNull())
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)
