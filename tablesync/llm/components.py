"""Connected components of an undirected graph of links, by contraction and alternating large-star and small-star steps.

A task contracts its links, a bounded number at a time: those of each group of connected nodes become links to its
smallest node. Links that fit one such group of ``held`` are settled by that. Otherwise rounds of two steps, each one aggregation
and one join by node, bring the groups together; a node with very many links is one row on the aggregated
side, and the other side's rows of it may be split. The links never leave the executors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import parts_for, stash

HELD = 500_000  # links that a task contracts at once


def _star(arcs: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each node ``u`` (``v``; the larger ones, or all and itself) to its smallest one."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = arcs.join(least, "u")
    if larger_only:
        linked = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return linked.where("u != v").distinct()


def smallest_linked(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links (u, v), sorted, and the smallest node linked with each by any way."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return nodes, nodes[root]


def contracted(arcs: DataFrame, parts: int, held: int) -> DataFrame:
    """``arcs`` (u, v) contracted in ``parts`` tasks, ``held`` links at a time."""

    def contract(batches):
        kept, n = [], 0

        def stars() -> pa.RecordBatch:
            u, v = smallest_linked(*(np.concatenate(side) for side in zip(*kept)))
            return pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], names=["u", "v"])

        for batch in batches:
            for lo in range(0, batch.num_rows, held):
                some = batch.slice(lo, held)
                if n and n + some.num_rows > held:
                    yield stars()
                    kept, n = [], 0
                kept.append(tuple(some.column(c).to_numpy() for c in ("u", "v")))
                n += some.num_rows
        if n:
            yield stars()

    return arcs.coalesce(parts).mapInArrow(contract, "u long, v long")


def components(links: DataFrame, most: int = 60, held: int = HELD) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Each round at least halves the longest way to a smallest node, so ``most`` rounds are enough for any
    graph; should they not be, it raises.
    """
    seen = Observation()  # counted while the links are written
    arcs = links.where("a != b").select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    arcs, last = stash(arcs.observe(seen, F.count(F.lit(1)).alias("n")), "links"), None
    for _ in range(most):
        n = seen.get["n"]
        arcs = stash(contracted(arcs, parts_for(n, held), held), "contracted")
        if n <= held:
            break
        both = arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        seen = Observation()
        total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        arcs = stash(_star(_star(both, True), False).observe(seen, F.count(F.lit(1)).alias("n"), total.alias("sum")), "stars")
        state = (seen.get["n"], seen.get["sum"])
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components have not settled after {most} rounds")
    roots = arcs.select(F.col("v").alias("node")).distinct()
    return arcs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
