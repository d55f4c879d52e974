"""MinHash near-duplicates on weighted word shingles by ProbMinHash.

A text's shingles (five lower-cased words; a shorter text is one shingle) weigh as often as they occur. The
arrivals of each shingle form a Poisson process whose rate is its weight; every arrival falls on a random register, and a
register keeps its first. Two texts agree in a register with their probability Jaccard. A shingle's
arrivals end once they come later than the last of all registers' firsts. Registers are grouped in bands; texts that
agree in a band are candidates, and their exact probability Jaccard is then computed from both texts.

Exact copies (equal lower-cased words) are one text from the start. A band's bucket of up to ``small`` texts
gives all its pairs. In a larger one every text meets the bucket's first and last text by hash and that of
its salt; then, where the bucket's texts are not yet one class, prefix filtering groups those that may still link,
and bounded blocks of them are compared as matrices: no link between classes is lost, and no
quadratic set of pairs is made.

Defined results: null and empty texts (no word) are alone in their class; rows that share a doc_id
are one document; a row with a null doc_id has a null class and is kept; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash
from .components import components
from .words import U, hash_spans, mix, slices, spans

WIDTH = 5
_PLACE = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64) | 1) for k in range(WIDTH)]


def shingles(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, weight) of the rows' distinct shingles, sorted by row, and two fingerprints a row."""
    starts, ends, first = spans(buf, offsets)
    h = hash_spans(buf, starts, ends)
    n = np.diff(first)
    word_row = np.repeat(np.arange(len(n)), n)
    place = (np.arange(len(h)) - first[word_row]).astype(np.uint64)
    prints = []
    for salt in (U(0x51ED270B27B4F3CF), U(0x6A09E667F3BCC909)):
        sums = np.concatenate([[U(0)], np.cumsum(mix(h + mix(place + salt)), dtype=np.uint64)])
        prints.append(mix(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64)))
    rows, hashes = [], []
    if len(h) >= WIDTH:
        code = np.zeros(len(h) - WIDTH + 1, np.uint64)
        for k in range(WIDTH):
            code += h[k : len(code) + k] * _PLACE[k]
        inside = word_row[: len(code)] == word_row[WIDTH - 1 :]
        rows.append(word_row[: len(code)][inside])
        hashes.append(mix(code[inside]))
    for size in range(1, WIDTH):
        short = np.flatnonzero(n == size)
        code = np.full(len(short), U(size))
        for k in range(size):
            code += h[first[short] + k] * _PLACE[k]
        rows.append(short)
        hashes.append(mix(code))
    row, code = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    begin = np.flatnonzero(new)
    return row[begin], code[begin], np.diff(np.append(begin, len(row))).astype(float), *prints


def prob_min_hash(row: np.ndarray, code: np.ndarray, weight: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """Registers (rows x registers) holding the shingle of their first arrival; 0 for rows without any."""
    first = np.full(rows * registers, np.inf)
    holder = np.zeros(rows * registers, np.uint64)
    live = np.arange(len(row))
    time = np.zeros(len(row))
    limit = np.full(rows, np.inf)
    drawn, block = 0, 1
    while len(live):
        for part in np.array_split(live, max(1, len(live) * block >> 18)):  # bounds the matrix of arrivals
            number = U(drawn) + np.arange(1, block + 1, dtype=np.uint64)
            bits = mix(code[part][:, None] + mix(number * U(0x9E3779B97F4A7C15)))
            step = -np.log(((bits >> U(11)).astype(float) + 0.5) / float(1 << 53)) / weight[part][:, None]
            arrival = time[part][:, None] + np.cumsum(step, 1)
            time[part] = arrival[:, -1]
            slot = row[part][:, None] * registers + (mix(bits) % U(registers)).astype(np.int64)
            early = arrival < limit[row[part]][:, None]
            slot, arrival, owner = slot[early], arrival[early], np.broadcast_to(code[part][:, None], early.shape)[early]
            np.minimum.at(first, slot, arrival)
            won = first[slot] == arrival
            holder[slot[won]] = owner[won]
        limit = first.reshape(rows, registers).max(1)
        live = live[time[live] < limit[row[live]]]
        drawn += block
        block = min(64, 2 * block)
    return holder.reshape(rows, registers)


def sketches(docs: DataFrame, bands: int, band_rows: int) -> DataFrame:
    """Per row: fingerprints of its words, their number, and a hash of each band."""

    def sketch(batches):
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            lowered = pc.utf8_lower(pc.fill_null(batch.column("text"), ""))
            for lo, hi, buf, offsets in slices(lowered):
                row, code, weight, one, two = shingles(buf, offsets)
                held = prob_min_hash(row, code, weight, hi - lo, bands * band_rows).reshape(hi - lo, bands, band_rows)
                keys = np.zeros((hi - lo, bands), np.uint64)
                for k in range(band_rows):
                    keys = mix(keys * U(0x9E3779B97F4A7C15) + held[:, :, k])
                keys = mix(keys + salt)
                some = np.bincount(row, minlength=hi - lo).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo + 1) * bands, bands, dtype=np.int32)), pa.array(keys.view(np.int64).ravel()))
                columns = [batch.column("doc_id").slice(lo, hi - lo), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(some), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp1", "fp2", "n_shingles", "bands"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(sketch, "doc_id long, fp1 long, fp2 long, n_shingles long, bands array<long>")


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum over common elements of 1 / sum over all of max(x_j/x_i, y_j/y_i); codes sorted and distinct."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = b[at] == a
    if not common.any():
        return 0.0
    x, y = wa[common], wb[at[common]]
    only_a, only_b = wa[~common].sum(), wb.sum() - y.sum()
    if (x == x[0]).all() and (y == y[0]).all():
        return float(len(x) / (len(x) + only_a / x[0] + only_b / y[0]))
    order = np.argsort(x / y)
    x, y = x[order], y[order]
    above = x[::-1].cumsum()[::-1] + only_a  # x where x_j/y_j >= x_i/y_i
    below = y.cumsum() - y + only_b
    return float((1 / (above / x + below / y)).sum())


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts reach ``similarity``; every text travels to its pairs, not to one task."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def verify(batches):
        for batch in batches:
            sides = []
            for name in ("text_a", "text_b"):
                codes, weights = [], []
                for lo, hi, buf, offsets in slices(pc.utf8_lower(pc.fill_null(batch.column(name), ""))):
                    row, code, weight, *_ = shingles(buf, offsets)
                    cut = np.searchsorted(row, np.arange(1, hi - lo))
                    codes += np.split(code, cut)
                    weights += np.split(weight, cut)
                sides.append((codes, weights))
            (a, wa), (b, wb) = sides
            like = np.array([probability_jaccard(*four) for four in zip(a, wa, b, wb)])
            good = pa.array(np.flatnonzero(like >= similarity))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(good), batch.column("b").take(good)], names=["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(verify, "a long, b long")


def candidate_pairs(member: DataFrame, small: int, salts: int) -> DataFrame:
    """Pairs (a < b) of ``member`` (key, node, n: the bucket's size)."""
    few = member.where(F.col("n") <= small).groupBy("key").agg(F.array_sort(F.collect_set("node")).alias("nodes"))
    few = few.select(F.col("nodes"), F.posexplode("nodes").alias("at", "a")).select("a", F.explode(F.expr("slice(nodes, at + 2, size(nodes))")).alias("b"))
    many = member.where(F.col("n") > small).withColumn("draw", F.xxhash64("node")).withColumn("salt", F.pmod("draw", F.lit(salts)))
    salted = many.groupBy("key", "salt").agg(F.min_by("node", "draw").alias("own"), F.min("draw").alias("low"), F.max_by("node", "draw").alias("far"), F.max("draw").alias("high"))
    ends = salted.groupBy("key").agg(F.min_by("own", "low").alias("first"), F.max_by("far", "high").alias("last"))
    star = many.join(salted.select("key", "salt", "own"), ["key", "salt"]).join(ends, "key")
    star = star.select("node", F.explode(F.array("own", "first", "last")).alias("other")).where("node != other")
    star = star.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    return few.unionByName(star).distinct()


def unsettled_nodes(member: DataFrame, classes: DataFrame, small: int) -> DataFrame:
    """(node, component) of the large buckets that hold several classes."""
    many = member.where(F.col("n") > small).select("key", "node").join(classes, "node", "left")
    many = many.withColumn("component", F.coalesce("component", "node"))
    parts = many.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    return many.join(parts.select("key"), "key").select("node", "component").distinct()


def canopies(nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(node, canopy): the ``nodes`` that may reach ``similarity`` with another, grouped so that all such pairs share a canopy.

    Prefix filtering: probability Jaccard is at most the common mass of the two texts' normalised weights. So if each text's
    shingles are put in one order (that of their hashes), two texts that reach it share one among those that come
    before 1 - similarity of the mass is used up. Texts that share one are in one canopy.
    """
    texts = texts.join(nodes.select(F.col("node").alias("doc_id")), "doc_id")

    def prefixes(batches):
        for batch in batches:
            for lo, hi, buf, offsets in slices(pc.utf8_lower(pc.fill_null(batch.column("text"), ""))):
                row, code, weight, *_ = shingles(buf, offsets)
                share = weight / np.bincount(row, weights=weight, minlength=hi - lo)[row]
                total = np.cumsum(share)
                used = total - share - np.concatenate([[0.0], total])[np.searchsorted(row, row)]
                keep = used <= 1 - similarity + 1e-6
                ids = batch.column("doc_id").slice(lo, hi - lo).take(pa.array(row[keep]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(code[keep].view(np.int64))], names=["node", "shingle"])

    rows = stash(texts.select("doc_id", "text").mapInArrow(prefixes, "node long, shingle long"), "prefixes")
    shared = rows.groupBy("shingle").agg(F.count("*").alias("df"), F.min("node").alias("first")).where("df > 1")
    links = rows.join(shared, "shingle").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    return components(links).withColumnRenamed("component", "canopy")


def mass_bound(left: list[tuple[np.ndarray, np.ndarray]], right: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Upper bounds of the probability Jaccard of all left and right texts, given their (shingles, weights).

    With p and q the masses of either text inside the other, the two minima agree at most as if they came
    from one exponential variable: 1 / (1/p + 1/q - 1).
    """
    sides = []
    for texts in (left, right):
        code = np.concatenate([c for c, _ in texts])
        row = np.repeat(np.arange(len(texts)), [len(c) for c, _ in texts])
        sides.append((code, row, np.concatenate([w / w.sum() for _, w in texts])))
    common = np.intersect1d(sides[0][0], sides[1][0])
    p, q = np.zeros((len(left), len(right))), np.zeros((len(left), len(right)))
    for lo in range(0, len(common), 4096):  # bounds the dense matrices
        some = common[lo : lo + 4096]
        dense = []
        for (code, row, share), texts in zip(sides, (left, right)):
            at = np.minimum(np.searchsorted(some, code), len(some) - 1)
            hit = some[at] == code
            mass, held = np.zeros((len(texts), len(some)), np.float32), np.zeros((len(texts), len(some)), np.float32)
            mass[row[hit], at[hit]], held[row[hit], at[hit]] = share[hit], 1
            dense.append((mass, held))
        (mass_l, held_l), (mass_r, held_r) = dense
        p += mass_l @ held_r.T
        q += held_l @ mass_r.T
    with np.errstate(divide="ignore"):
        return 1 / (1 / np.minimum(p, 1) + 1 / np.minimum(q, 1) - 1)


def links_between_classes(nodes: DataFrame, texts: DataFrame, similarity: float, left_rows: int = 256, right_rows: int = 512) -> DataFrame:
    """Links (a, b) that join all components of ``nodes`` (node, component) between which some pair reaches ``similarity``.

    In a canopy, blocks of nodes outside its largest component meet blocks of all its nodes; a task holds two
    blocks and returns only links that join components it has not yet joined.
    """
    grouped = nodes.join(canopies(nodes, texts, similarity), "node").join(texts.select(F.col("doc_id").alias("node"), "text"), "node")
    grouped = stash(grouped, "canopies")
    sizes = grouped.groupBy("canopy", "component").agg(F.count("*").alias("size"))
    sizes = sizes.groupBy("canopy").agg(F.max_by("component", F.struct("size", "component")).alias("largest"), F.sum("size").alias("all"), F.max("size").alias("most"), F.count("*").alias("parts"))
    blocks = [F.ceil((F.col("all") - F.col("most")) / left_rows).cast("int").alias("lefts"), F.ceil(F.col("all") / right_rows).cast("int").alias("rights")]
    rows = grouped.join(sizes.where("parts > 1").select("canopy", "largest", *blocks), "canopy")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where("component != largest").withColumn("i", F.pmod(F.xxhash64("node"), "lefts").cast("int")).withColumn("j", every("rights"))
    right = rows.withColumn("j", F.pmod(F.xxhash64("node", F.lit(1)), "rights").cast("int")).withColumn("i", every("lefts"))
    columns = ["canopy", "i", "j", "node", "component", "text"]
    right = right.select(columns).toDF(*columns)

    def meet(one: pa.Table, other: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if one.num_rows and other.num_rows:
            bags = []
            for table in (one, other):
                bag = []
                for lo, hi, buf, offsets in slices(pc.utf8_lower(pc.fill_null(table["text"], ""))):
                    row, code, weight, *_ = shingles(buf, offsets)
                    cut = np.searchsorted(row, np.arange(1, hi - lo))
                    bag += zip(np.split(code, cut), np.split(weight, cut))
                bags.append(bag)
            bound = mass_bound(*bags)
            (a, ca), (b, cb) = ((t["node"].to_pylist(), t["component"].to_pylist()) for t in (one, other))
            x, y = np.nonzero((bound >= similarity - 1e-4) & (np.array(ca)[:, None] != np.array(cb)[None]))
            root = {c: c for c in [*ca, *cb]}

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            for k in np.argsort(-bound[x, y], kind="stable").tolist():
                i, j = x[k], y[k]
                c, d = find(ca[i]), find(cb[j])
                if c != d and probability_jaccard(*bags[0][i], *bags[1][j]) >= similarity:
                    root[max(c, d)] = min(c, d)
                    found.append((a[i], b[j]))
        return pa.table({"a": pa.array([p for p, _ in found], pa.int64()), "b": pa.array([p for _, p in found], pa.int64())})

    return left.select(columns).groupBy("canopy", "i", "j").cogroup(right.groupBy("canopy", "i", "j")).applyInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = 0.8, bands: int = 20, band_rows: int = 5, small: int = 24, salts: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``class_id`` (smallest doc_id of the class), ``kept`` (is that one), ``n_shingles``."""
    sketched = stash(sketches(docs, bands, band_rows), "sketches")
    usable = sketched.where("n_shingles > 0 and doc_id is not null")
    nodes = usable.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("node"), F.min("bands").alias("bands"))
    rows = nodes.select("node", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    member = stash(rows.join(buckets, "key"), "buckets")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(member.select(F.col("node").alias("doc_id")).distinct(), "doc_id")
    texts = stash(texts.groupBy("doc_id").agg(F.min("text").alias("text")), "candidates")
    links = stash(verified(candidate_pairs(member, small, salts), texts, similarity), "pairs")
    classes = components(links)
    rest = stash(unsettled_nodes(member, classes, small), "unsettled")
    if not rest.isEmpty():
        more = stash(links_between_classes(rest, texts, similarity), "more-links")
        if not more.isEmpty():
            links = links.unionByName(more)
            classes = components(links)
    by_text = nodes.select("fp1", "fp2", "node").join(classes, "node", "left").select("fp1", "fp2", F.coalesce("component", "node").alias("class"))
    out = sketched.drop("bands").join(by_text, ["fp1", "fp2"], "left")
    class_id = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("class")).otherwise(F.col("doc_id"))
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce(F.col("doc_id") == class_id, F.lit(True)).alias("kept"), "n_shingles")


def without_near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """One row of ``docs`` per class: that of the smallest doc_id. Rows with a null id stay.

    Rows that share an id but not their text are documents of their own here, so that no text goes unless one like
    it stays; of rows equal in both, one stays. Such further rows of an id have a number of their own, so in their
    classes the smallest number stays.
    """
    number = "_number" + "_" * sum(c.startswith("_number") for c in docs.columns)
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.xxhash64("text")).alias("first")).where("n > 1")
    again = stash(again.select("doc_id", "first"), "repeated-ids")
    key = F.col("doc_id").cast("long")
    if again.isEmpty():
        docs = docs.withColumn(number, key)
    else:
        renamed = again.select(F.col("doc_id").alias(f"{number}i"), F.col("first").alias(f"{number}f"))
        docs = docs.join(renamed, F.col("doc_id") == F.col(f"{number}i"), "left")
        other = F.col(f"{number}f").isNotNull() & (F.xxhash64("text") != F.col(f"{number}f"))
        docs = docs.withColumn(number, F.when(other, F.xxhash64("doc_id", "text")).otherwise(key)).drop(f"{number}i", f"{number}f")
        docs = stash(docs, "numbered")
    classes = near_duplicates(docs.select(F.col(number).alias("doc_id"), "text"), **parameters)
    gone = classes.where(~F.col("kept")).select(F.col("doc_id").alias(number)).distinct()
    named = docs.where(F.col(number).isNotNull()).join(gone, number, "left_anti").dropDuplicates([number])
    return named.unionByName(docs.where(F.col(number).isNull())).drop(number)
