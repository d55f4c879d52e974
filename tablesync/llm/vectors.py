"""Embedding near-duplicates: spherical k-means cells and blocked cosine products.

Centroids are fitted on a bounded sample; every vector is then assigned to its nearest one (by cosine) and
visits each later cell whose border is near enough for a partner to lie behind it, so two cells meet on one side
only and a link found there counts for both its ends. A cell's members
are cut into blocks; a block of visitors or members against a block of members is compared as two bounded
matrices: the product of the first components plus the product of the rests' lengths is at least the cosine, and only
pairs this bound leaves are compared whole. A task returns link counts and, for components, each vector's smallest linked
vector after settling links inside the block, never the pairs.

Equal vectors are one vector with a multiplicity, so a very common one is a single row.

With ``slack`` 1, the default, the border test is exact (x.(c-c') <= r |c-c'|, r the largest distance of two unit vectors
that link): no link is lost. Smaller values visit fewer cells and may lose links; recall is then to be measured.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component, and those with a
null vec_id, link with nothing (n_links 0, their own component, kept); vectors of different length
do not link; rows that share a vec_id are one vector, whose links add up; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import parts_for, stash
from .components import components


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Unit centroids of unit rows; an empty cell takes the row farthest from its centroid."""
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        like = x @ centre.T
        cell = like.argmax(1)
        sums = np.zeros_like(centre)
        np.add.at(sums, cell, x)
        norm = np.linalg.norm(sums, axis=1)
        worst = iter(np.argsort(like[np.arange(len(x)), cell], kind="stable"))
        for empty in np.flatnonzero(norm < 1e-12):
            sums[empty] = x[next(worst)]
        new = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-300)
        if np.allclose(new, centre, atol=1e-9):
            break
        centre = new
    return centre


def unit_rows(column: pa.Array, dims: int) -> np.ndarray:
    """Unit vectors in double precision of a list column without nulls, all of ``dims`` components."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    largest = np.abs(flat).max(1, keepdims=True)  # keeps squares of extreme values finite
    flat = flat / largest
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def settle(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id reachable inside a block for its left and right ids, given the links (a[i], b[i])."""
    at_left, at_right = left.copy(), right.copy()
    while True:
        before = at_left.sum() + at_right.sum(), at_left.copy(), at_right.copy()
        low = np.minimum(at_left[a], at_right[b])
        np.minimum.at(at_left, a, low)
        np.minimum.at(at_right, b, low)
        if (at_left == before[1]).all() and (at_right == before[2]).all():
            return at_left, at_right


def linked_pairs(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all rows of ``x`` and ``y`` (unit rows) whose cosine reaches ``cosine``, in order of i."""
    dims = x.shape[1]
    head = max(1, dims // 4)
    front = lambda m: np.hstack([m[:, :head], np.linalg.norm(m[:, head:], axis=1, keepdims=True)]).astype(np.float32)
    u, w = front(x), front(y).T.copy()
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(x), 512):  # bounds the products
        some = x[lo : lo + 512]
        i, j = np.divmod(np.flatnonzero(u[lo : lo + 512] @ w >= cosine - 1e-5), len(y))  # rounding of single precision is below 1e-5
        if len(i) * 32 > len(some) * len(y):  # the bound does not part them: all pairs whole
            i, j = np.nonzero(some @ y.T >= cosine)
        else:
            reach = np.einsum("ij,ij->i", some[i], y[j]) >= cosine
            i, j = i[reach], j[reach]
        left.append(i + lo)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def cell_visits(distinct: DataFrame, centre: np.ndarray, reach: float) -> DataFrame:
    """(cell, node, copies, home, v): every vector in its own cell, and in the later ones it visits."""
    dims, shared = centre.shape[1], distinct.sparkSession.sparkContext.broadcast(centre)
    distance = lambda like: np.sqrt(np.maximum(0, 2 - 2 * like)) + 1e-7  # noqa: E731  of centroids, by their cosines; never less than it is
    span = distance(centre @ centre.T) if len(centre) <= 512 else None

    def visit(batches):
        c = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                x = unit_rows(some.column("v"), dims)
                like = x @ c.T
                home = like.argmax(1)
                gap = like[np.arange(len(x)), home][:, None] - like
                apart = span[home] if span is not None else distance(c[home] @ c.T)
                goes = (gap <= reach * apart + 1e-9) & (np.arange(len(c)) > home[:, None])
                goes[np.arange(len(x)), home] = True
                row, cell = np.nonzero(goes)
                take = pa.array(row)
                columns = [pa.array(cell.astype(np.int32)), some.column("node").take(take), some.column("copies").take(take), pa.array(cell == home[row]), some.column("v").take(take)]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "node", "copies", "home", "v"])

    return distinct.select("node", "copies", "v").mapInArrow(visit, f"cell int, node long, copies long, home boolean, v {distinct.schema['v'].dataType.simpleString()}")


def block_links(visits: DataFrame, dims: int, cosine: float, block_rows: int) -> DataFrame:
    """(node, linked, other): linked vectors of a node in one block, and a link that keeps its component.

    A link counts for both its ends: visitors come from one side only, and of two members the one with the smaller node counts.
    """
    sizes = visits.groupBy("cell").agg(F.count("*").alias("queries"), F.sum(F.col("home").cast("long")).alias("members"))  # a row per cell
    sizes = sizes.select("cell", F.ceil(F.col("queries") / block_rows).cast("int").alias("q"), F.greatest(F.lit(1), F.ceil(F.col("members") / block_rows).cast("int")).alias("m"))
    rows = visits.join(F.broadcast(sizes), "cell")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    queries = rows.withColumn("i", F.pmod(F.xxhash64("node"), "q").cast("int")).withColumn("j", every("m")).select("cell", "i", "j", "node", "copies", "home", "v")
    members = rows.where("home").withColumn("j", F.pmod(F.xxhash64("node", F.lit(1)), "m").cast("int")).withColumn("i", every("q")).select("cell", "i", "j", "node", "copies", "v")
    members = members.toDF(*members.columns)  # columns of its own: both sides come from one table

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a = left["node"].to_numpy().astype(np.int64)
        b = right["node"].to_numpy().astype(np.int64)
        linked, other = np.zeros(len(a) + len(b), np.int64), np.concatenate([a, b])
        if len(a) and len(b):
            x, y = (unit_rows(t["v"].combine_chunks(), dims) for t in (left, right))
            i, j = linked_pairs(x, y, cosine)
            once = ~left["home"].to_numpy()[i] | (a[i] <= b[j])  # members meet in both orders
            i, j = i[once], j[once]
            both = ~left["home"].to_numpy()[i] | (a[i] < b[j])  # vectors of one node are seen from each
            linked[: len(a)] = np.bincount(i, weights=right["copies"].to_numpy()[j], minlength=len(a))
            linked[len(a) :] = np.bincount(j[both], weights=left["copies"].to_numpy()[i[both]], minlength=len(b))
            other = np.concatenate(settle(a, b, i, j))
        nodes = np.concatenate([a, b])
        keep = (linked > 0) | (other != nodes)
        return pa.table({"node": nodes[keep], "linked": linked[keep], "other": other[keep]})

    grouped = queries.groupBy("cell", "i", "j").cogroup(members.groupBy("cell", "i", "j"))
    return grouped.applyInArrow(compare, "node long, linked long, other long")


def _centroids(distinct: DataFrame, dims: int, cell_rows: int, sample_rows: int, most_cells: int) -> np.ndarray:
    """Centroids from a sample of about ``sample_rows`` vectors by hash, fewer if they are long (64 MB at most)."""
    n = distinct.count()
    bound = max(1, min(sample_rows, (8 << 20) // dims))
    share = int(min(1.0, bound / n) * (1 << 20)) + 1
    sample = distinct.where(F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1 << 20)) < share).select("node", "v").collect()
    sample.sort(key=lambda r: r["node"])
    if not sample:
        return np.eye(1, dims)
    x = unit_rows(pa.array([r["v"] for r in sample], pa.list_(pa.float64())), dims)
    return spherical_kmeans(x, max(1, min(parts_for(n, cell_rows), most_cells, len(x) // 4)))


def link_vectors(
    vectors: DataFrame, cosine: float = 0.95, cell_rows: int = 1500, block_rows: int = 2048, sample_rows: int = 20_000, most_cells: int = 4096, slack: float = 1.0
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    ``sample_rows`` bounds the sample for k-means, ``most_cells`` the broadcast centroids.
    """
    spark = vectors.sparkSession
    # components keep their precision: single where the column has it, else double
    kind = "float" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "double"
    v = F.transform("embedding", lambda x: x.cast(kind))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(good, F.transform("v", lambda x: F.when(x == 0, F.lit(0.0).cast(kind)).otherwise(x))))  # -0.0 too
    distinct = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    distinct = stash(distinct.withColumn("dims", F.size("v")), "distinct")
    found = spark.createDataFrame([], "node long, linked long, other long")
    reach = slack * float(np.sqrt(2 - 2 * cosine))
    for dims in [r["dims"] for r in distinct.select("dims").distinct().orderBy("dims").collect()]:  # one, as a rule
        some = distinct.where(F.col("dims") == dims)
        visits = stash(cell_visits(some, _centroids(some, dims, cell_rows, sample_rows, most_cells), reach), "visits")
        found = found.unionByName(block_links(visits, dims, cosine, block_rows))
    found = stash(found, "block-links")
    classes = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    nodes = distinct.join(linked, "node", "left").join(classes, "node", "left")
    nodes = nodes.select("v", (F.coalesce("linked", "copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = rows.join(nodes, "v", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
