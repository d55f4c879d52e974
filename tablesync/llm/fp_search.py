"""Exact top-k search of many items by tries of documents (document FP-trees).

A document's vector holds those of its terms that some item has, with their frequencies. Within a block of items the terms
are ordered by document frequency, most frequent first, so documents that begin with the same frequent terms share a path of
a trie. Every node knows, for its subtree, each term's largest ``tf`` and the smallest ``m`` (the length part of the
score). A term's share of a score grows with ``tf`` and falls with ``m``, so a node's shares bound the score of any
document below it. The trie is walked depth first, largest bound first, with the set of items that may still find
one of their ``k`` best below; an item leaves at the first node whose bound is under its own threshold, and a subtree without items is
cut. Subtrees of up to ``LEAF`` documents are scored.

Each task builds tries of its documents as they come, ``CHUNK_DOCS`` at a time, and sends at most ``k`` rows an item: no text and no
vector is shuffled. Thresholds start from the exact search of a sample by hash (about ``SAMPLE`` documents): the k-th
best of a part is a lower bound for the whole, so the sample speeds the search up and never changes its result.

Scores are integers: a term's weight is ``floor(1000 ln((2N+2)/(2df+1)))``; ``m = 50 + 50 n N div L``; the score sums
``weight * (10^9 tf div (1000 tf + 20 m))`` over the item's terms, once each. Sums are taken in doubles only while they are exact.

Items go through the driver in groups of about ``GROUP_TERMS`` terms, one pass over the documents each, so what is broadcast
has that bound (one longer item is a group with others of its share).

Defined results: null and empty texts have no terms; an item without terms or hits, and an empty table, give no rows. Equal scores
ascend by doc_id, null ids last; repeated rows are documents of their own and repeated items are searched for themselves. Texts are
read whole, whatever their length. Other columns do not travel, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stash
from .words import hash_spans, lower_ascii, slices, spans

K = 50
LEAF = 32
CHUNK_DOCS = 16_384
CHUNK_TERMS = 2_000_000
BLOCK_ITEMS = 256
BLOCK_TERMS = 20_000
GROUP_TERMS = 1_000_000
SAMPLE = 20_000
EXACT = 1 << 53

#: Bytes that part terms: all of ASCII but digits and letters.
APART = np.ones(256, bool)
APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def row_terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, the rows' first terms and the total, hashes of all terms) for slices of a text column."""
    for lo, _, buf, offsets in slices(column):
        buf = lower_ascii(buf)
        start, end, first = spans(buf, offsets, APART)
        yield lo, first, hash_spans(buf, start, end)


def counted(row: np.ndarray, term: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, number of times) of each pair, by row and term; terms are below ``width``."""
    key, n = np.unique(row.astype(np.int64) * width + term, return_counts=True)
    return key // width, key % width, n


def share(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Best:
    """The ``k`` best documents of each item so far: by score, then id (null ids last)."""

    def __init__(self, threshold: np.ndarray, k: int):
        self.k, self.threshold = k, np.maximum(threshold, 1)
        self.found, self.size = [], 0

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        self.found.append((item, score, doc, null))
        self.size += len(item)
        if self.size > 2 * self.k * len(self.threshold) + 20_000:
            self.rows()

    def rows(self) -> tuple[np.ndarray, ...]:
        if not self.found:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
        item, score, doc, null = (np.concatenate(c) for c in zip(*self.found, strict=True))
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        first = np.searchsorted(item, item)
        rank = np.arange(len(item)) - first
        last = rank == self.k - 1
        self.threshold[item[last]] = np.maximum(self.threshold[item[last]], score[last])
        keep = rank < self.k
        self.found = [(item[keep], score[keep], doc[keep], null[keep])]
        self.size = int(keep.sum())
        return self.found[0]


class ItemBlock:
    """Some items and their terms, which are columns by descending document frequency."""

    def __init__(self, numbers: np.ndarray, lists: list[np.ndarray], weight: np.ndarray, df: np.ndarray, threshold: np.ndarray, k: int):
        terms = np.unique(np.concatenate(lists))
        self.terms = terms[np.lexsort((terms, -df[terms]))]
        self.weight = weight[self.terms]
        place = np.zeros(len(terms), np.int64)
        place[np.searchsorted(terms, self.terms)] = np.arange(len(terms))
        most = max(len(x) for x in lists) * int(self.weight.max(initial=0)) * 1_000_000
        self.holds = np.zeros((len(terms), len(lists)), np.float64 if most < EXACT else np.int64)
        for k_, x in enumerate(lists):
            self.holds[place[np.searchsorted(terms, x)], k_] = 1
        self.numbers, self.best = numbers, Best(threshold, k)


class Trie:
    """The trie of some documents' vectors, its small subtrees as leaves, with the bounds of all nodes.

    ``ptr``, ``term`` and ``tf`` hold the documents' vectors, by term; documents are put in the order of the trie.
    """

    def __init__(self, ptr: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, weight: np.ndarray):
        raw = term.astype(">u4").tobytes()
        at = (4 * ptr).tolist()
        keys = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        size = np.diff(ptr)[self.order]
        self.ptr = np.concatenate([[0], np.cumsum(size)])
        pick = np.repeat(ptr[:-1][self.order] - self.ptr[:-1], size) + np.arange(self.ptr[-1])
        self.term, tf, m = term[pick], tf[pick], m[self.order]
        self.weight = weight
        self.share = share(weight[self.term], tf, np.repeat(m, size))
        self.common = self._common(size)
        self.tree = self._split(0, len(size))
        self._leaves(tf, m, size)

    def _common(self, size: np.ndarray) -> np.ndarray:
        """The length of the path that each document shares with the one before."""
        out = np.zeros(len(size), np.int64)
        pair = np.arange(1, len(size))
        while len(pair):
            depth = out[pair]
            pair = pair[(size[pair] > depth) & (size[pair - 1] > depth)]
            pair = pair[self.term[self.ptr[pair] + out[pair]] == self.term[self.ptr[pair - 1] + out[pair]]]
            out[pair] += 1
        return out

    def _split(self, lo: int, hi: int):
        """A node: the number of a leaf, or the list of the nodes below. Small neighbours of one parent share a leaf."""
        todo, root = [(lo, hi, None, 0)], [None]
        # Depth first with a stack of its own: copies make long paths.
        while todo:
            lo, hi, parent, place = todo.pop()
            inner = self.common[lo + 1 : hi]
            if hi - lo <= LEAF or inner.min() == inner.max() == self.ptr[lo + 1] - self.ptr[lo]:
                ends = [*range(lo + LEAF, hi, LEAF), hi] if hi > lo else []
                node = [("leaf", a, b) for a, b in zip([lo, *ends[:-1]], ends, strict=True)]
            else:
                cuts = [lo, *(np.flatnonzero(inner == inner.min()) + lo + 1).tolist(), hi]
                node, start = [], lo
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    if b - a > LEAF:
                        if a > start:
                            node.append(("leaf", start, a))
                        node.append(("node", a, b))
                        start = b
                    elif b - start > LEAF:
                        if a > start:
                            node.append(("leaf", start, a))
                        start = a
                if hi > start:
                    node.append(("leaf", start, hi))
            if parent is None:
                root[0] = node
            else:
                parent[place] = node
            todo += [(a, b, node, k) for k, (kind, a, b) in enumerate(node) if kind == "node"]
        return root[0]

    def _leaves(self, tf: np.ndarray, m: np.ndarray, size: np.ndarray) -> None:
        """Number the leaves in the documents' order; each one's terms, largest ``tf`` and smallest ``m``."""
        found, todo = [], [self.tree]
        while todo:
            node = todo.pop()
            for k, x in enumerate(node):
                if isinstance(x, tuple):
                    found.append((x[1], x[2], node, k))
                else:
                    todo.append(x)
        found.sort(key=lambda x: x[0])
        self.leaf_at = np.array([0, *(x[1] for x in found)], np.int64)
        for number, (_, _, node, k) in enumerate(found):
            node[k] = number
        if not found:
            return
        leaf = np.repeat(np.arange(len(found)), np.diff(self.leaf_at))
        leaf_of = np.repeat(leaf, size)
        order = np.lexsort((self.term, leaf_of))
        a, b = leaf_of[order], self.term[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
        first = np.flatnonzero(new)
        self.column = np.zeros(len(order), np.int64)
        self.leaf_terms = b[first]
        self.leaf_tf = np.maximum.reduceat(tf[order], first) if len(first) else tf[:0]
        self.leaf_ptr = np.searchsorted(a[first], np.arange(len(found) + 1))
        self.column[order] = np.cumsum(new) - 1
        self.column -= self.leaf_ptr[leaf_of]
        self.leaf_m = np.minimum.reduceat(m, self.leaf_at[:-1])

    def summary(self, node) -> tuple[np.ndarray, np.ndarray, int]:
        """(terms, largest tf, smallest m) of a leaf's number or a node made by ``bounded``."""
        if isinstance(node, int):
            a, b = self.leaf_ptr[node], self.leaf_ptr[node + 1]
            return self.leaf_terms[a:b], self.leaf_tf[a:b], self.leaf_m[node]
        return node["terms"], node["tf"], node["m"]

    def bounded(self) -> dict:
        """The tree with every inner node's summary and its children's bounds as a matrix over its terms."""
        done, todo = {}, [(self.tree, False)]
        while todo:
            node, ready = todo.pop()
            if not ready:
                todo.append((node, True))
                todo += [(x, False) for x in node if isinstance(x, list)]
                continue
            below = [done.pop(id(x)) if isinstance(x, list) else x for x in node]
            parts = [self.summary(x) for x in below]
            terms, place = np.unique(np.concatenate([p[0] for p in parts] + [np.zeros(0, np.int64)]), return_inverse=True)
            tf = np.zeros(len(terms), np.int64)
            np.maximum.at(tf, place, np.concatenate([p[1] for p in parts] + [np.zeros(0, np.int64)]))
            bounds = np.zeros((len(below), len(terms)), np.int64)
            lo = 0
            for k, (t, f, m) in enumerate(parts):
                bounds[k, place[lo : lo + len(t)]] = share(self.weight[t], f, m)
                lo += len(t)
            done[id(node)] = {"below": below, "terms": terms, "tf": tf, "m": min((p[2] for p in parts), default=1), "bounds": bounds}
        return done[id(self.tree)]

    def search(self, block: ItemBlock, doc: np.ndarray, null: np.ndarray) -> int:
        """Offer the block's items all documents that can be among their best; returns the number of scores computed."""
        best, scored = block.best, 0
        doc, null = doc[self.order], null[self.order]
        todo = [(self.bounded(), np.arange(block.holds.shape[1]))] if self.tree else []
        while todo:
            node, items = todo.pop()
            if isinstance(node, int):
                a, b = self.leaf_ptr[node], self.leaf_ptr[node + 1]
                lo, hi = self.leaf_at[node], self.leaf_at[node + 1]
                p, q = self.ptr[lo], self.ptr[hi]
                shares = np.zeros((hi - lo, b - a), block.holds.dtype)
                shares[np.repeat(np.arange(hi - lo), np.diff(self.ptr[lo : hi + 1])), self.column[p:q]] = self.share[p:q]
                score = shares @ block.holds[np.ix_(self.leaf_terms[a:b], items)]
                scored += score.size
                row, k = np.nonzero(score >= best.threshold[items])
                if len(row):
                    best.add(items[k], score[row, k].astype(np.int64), doc[lo + row], null[lo + row])
                continue
            bound = node["bounds"].astype(block.holds.dtype) @ block.holds[np.ix_(node["terms"], items)]
            alive = bound >= best.threshold[items]
            for k in np.argsort(bound.max(axis=1), kind="stable").tolist():  # the last is taken first
                if alive[k].any():
                    todo.append((node["below"][k], items[alive[k]]))
        return scored


def search_rows(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of this task's documents for each item, of those that reach the item's threshold."""
    weight, df, k = model["weight"], model["df"], model["k"]
    blocks = [ItemBlock(numbers, lists, weight, df, threshold, k) for numbers, lists, threshold in model["blocks"]]
    lookup = np.full(len(weight), -1, np.int64)

    def flush(held: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(held)
        ids, n = rows["doc_id"].combine_chunks(), np.asarray(rows["n"])
        doc, null = np.asarray(ids.fill_null(0)), ~np.array(ids.is_valid())
        lists = rows["terms"].combine_chunks()
        ptr = np.asarray(lists.offsets).astype(np.int64)
        term, tf = np.asarray(lists.values), np.asarray(rows["tf"].combine_chunks().values).astype(np.int64)
        term, tf, ptr = term[ptr[0] : ptr[-1]], tf[ptr[0] : ptr[-1]], ptr - ptr[0]
        m = 50 + (50 * n * model["N"]) // model["L"]
        row = np.repeat(np.arange(len(n)), np.diff(ptr))
        for block in blocks:
            lookup[block.terms] = np.arange(len(block.terms))
            own = lookup[term]
            lookup[block.terms] = -1
            kept = np.flatnonzero(own >= 0)
            kept = kept[np.lexsort((own[kept], row[kept]))]
            with_any, first = np.unique(row[kept], return_index=True)
            trie = Trie(np.append(first, len(kept)), own[kept], tf[kept], m[with_any], block.weight)
            trie.search(block, doc[with_any], null[with_any])

    held, docs, terms = [], 0, 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            held.append(part)
            docs += part.num_rows
            terms += len(part["terms"].flatten())
            if docs >= CHUNK_DOCS or terms >= CHUNK_TERMS:
                flush(held)
                held, docs, terms = [], 0, 0
    if docs:
        flush(held)
    for block in blocks:
        item, score, doc, null = block.best.rows()
        yield pa.record_batch({"item": pa.array(block.numbers[item], pa.int64()), "doc_id": pa.array(doc, pa.int64(), mask=null), "score": pa.array(score, pa.int64())})


def document_vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, tf) of the documents with terms; ``vocabulary`` is a broadcast of sorted term hashes."""

    def vectors(batches):
        known = vocabulary.value
        for batch in batches:
            ids = batch["doc_id"]
            for lo, first, term in row_terms(batch["text"]):
                n = np.diff(first)
                row = np.repeat(np.arange(len(n)), n)
                at = np.minimum(np.searchsorted(known, term), max(len(known) - 1, 0))
                hit = known[at] == term if len(known) else np.zeros(len(term), bool)
                row, term, tf = counted(row[hit], at[hit], max(len(known), 1))
                offsets = np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32)
                out = {
                    "doc_id": ids.slice(lo, len(n)),
                    "n": pa.array(n, pa.int64()),
                    "terms": pa.ListArray.from_arrays(pa.array(offsets), pa.array(term, pa.int32())),
                    "tf": pa.ListArray.from_arrays(pa.array(offsets), pa.array(tf, pa.int32())),
                }
                yield pa.record_batch(out).filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(vectors, "doc_id long, n long, terms array<int>, tf array<int>")


def _item_terms(items: DataFrame) -> DataFrame:
    """(number, item_id, terms): the items with terms, numbered, their distinct term hashes."""
    kind = items.schema["item_id"].dataType

    def terms(batches):
        for batch in batches:
            for lo, first, term in row_terms(batch["text"]):
                lists = [np.unique(term[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.record_batch({"item_id": batch["item_id"].slice(lo, len(lists)), "terms": pa.array(lists, pa.list_(pa.int64()))})

    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(terms, f"item_id {kind.simpleString()}, terms array<long>").where(F.size("terms") > 0)
    return stash(found.select(F.monotonically_increasing_id().alias("number"), "item_id", "terms"), "items")


def _blocks(numbers: np.ndarray, lists: list[np.ndarray], threshold: np.ndarray) -> list[tuple]:
    """Items in blocks of at most ``BLOCK_ITEMS`` and about ``BLOCK_TERMS`` terms."""
    out, lo, size = [], 0, 0
    for k in range(len(lists) + 1):
        if k == len(lists) or (k > lo and (k - lo == BLOCK_ITEMS or size + len(lists[k]) > BLOCK_TERMS)):
            out.append((numbers[lo:k], lists[lo:k], threshold[lo:k]))
            lo, size = k, 0
        size += len(lists[k]) if k < len(lists) else 0
    return [b for b in out if len(b[1])]


def _search_group(docs: DataFrame, items: pa.Table, k: int, sample: int) -> DataFrame:
    """(item, doc_id, score): what the tasks found for the items of one group."""
    spark = docs.sparkSession
    numbers = np.asarray(items["number"])
    order = np.argsort(numbers)
    lists = items["terms"].to_pylist()
    known = np.unique(np.array([t for x in lists for t in x], np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(known)
    vectors = stash(document_vectors(docs, shared), "vectors")
    shared.destroy()
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # at most the vocabulary
    df = np.zeros(len(known), np.int64)
    df[np.asarray(counts["t"])] = np.asarray(counts["count"])
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    lists = [np.searchsorted(known, np.array(lists[i], np.int64).view(np.uint64)) for i in order]
    numbers = numbers[order]

    def search(rows: DataFrame, threshold: np.ndarray, name: str) -> DataFrame:
        model = {"weight": weight, "df": df, "N": n_docs, "L": max(n_terms, 1), "k": k, "blocks": _blocks(numbers, lists, threshold)}
        given = spark.sparkContext.broadcast(model)
        found = rows.mapInArrow(lambda batches: search_rows(batches, given.value), "item long, doc_id long, score long")
        found = stash(found, name)
        given.destroy()
        return found

    threshold = np.zeros(len(numbers), np.int64)
    if n_docs > 2 * sample:
        part = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(n_docs // sample)) == 0)
        kth = best(search(part, threshold, "sample"), k).where(F.col("rank") == k).select("item", "score").toArrow()
        threshold[np.searchsorted(numbers, np.asarray(kth["item"]))] = np.asarray(kth["score"])
    return search(vectors, threshold, "found")


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def trie_search(docs: DataFrame, items: DataFrame, k: int = K, sample: int = SAMPLE, group_terms: int = GROUP_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) of each item (item_id, text)."""
    items = _item_terms(items)
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, math.ceil(total / group_terms))
    found = None
    for g in range(groups):
        part = items.where(F.pmod(F.xxhash64("number"), F.lit(groups)) == g).select("number", "terms").toArrow()
        if part.num_rows:
            rows = _search_group(docs, part, k, sample)
            found = rows if found is None else found.unionByName(rows)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long")
    top = best(found, k).join(items.select(F.col("number").alias("item"), "item_id"), "item")
    return top.select("item_id", "rank", "doc_id", "score")
