"""Repeated passages and trie search against plain computations."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesync.llm import fp_search, repeats
from tablesync.llm.fp_search import Trie, share, trie_search
from tablesync.llm.repeats import long_factors, nearest_smaller, remove_repeats, window_runs


def plain_repeats(rows, length=50):
    first, texts = {}, [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - length + 1) if d is not None else ():
            s = b[i : i + length]
            first[s] = min(d, first.get(s, d))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1) if d is not None else ():
            if first[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((d, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def found_repeats(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "2 as bucket", "3 as n_bytes")
    got = remove_repeats(docs.repartition(3), **options).collect()
    return sorted(((r["doc_id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in got), key=repr)


def passages(rnd, n):
    """Documents of random words, shared passages, near copies and repeated lines."""
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(1, 6)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(k) for k in (10, 14, 25, 60)]
    out = []
    for i in range(n):
        parts = [text(rnd.randint(0, 30)) for _ in range(rnd.randint(0, 4))]
        for _ in range(rnd.randint(0, 2)):
            parts.insert(rnd.randint(0, len(parts)), rnd.choice(shared))
        if out and rnd.random() < 0.2:
            other = list(rnd.choice(out)[1])
            if other:
                other[rnd.randrange(len(other))] = "#"
            parts = ["".join(other)]
        out.append((i * 7 % n, "\n".join(parts)))
    return out


@pytest.mark.parametrize("seed, hot", [(1, 4096), (2, 3)])
def test_repeats_against_all_positions(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SLICE", 500)
    rows = passages(random.Random(seed), 120)
    assert found_repeats(spark, rows, block_bytes=4000, bucket_anchors=500) == plain_repeats(rows)


def test_repeats_of_periodic_texts_copies_and_odd_rows(spark):
    rows = [(1, "ab" * 300), (2, "ab" * 26), (3, "a" * 400), (4, "x" + "a" * 60 + "y"), (5, None), (6, ""), (7, "short"), (None, "ab" * 300), (8, "b" * 49), (9, "b" * 49)]
    rows += [(k, "one and the same text of more than fifty bytes, many times over") for k in range(10, 60)]
    rows += [(60, "twice " * 20), (60, "twice " * 20), (61, "é" * 40 + "z"), (62, "z" + "é" * 40), (63, "w " * 60_000 + "q"), (64, "v" + "w " * 50_000)]
    assert found_repeats(spark, rows) == plain_repeats(rows)


def test_repeats_of_an_empty_table_and_lengths(spark):
    assert found_repeats(spark, []) == []
    rows = passages(random.Random(5), 40)
    assert found_repeats(spark, rows, length=30) == plain_repeats(rows, 30)
    with pytest.raises(ValueError):
        remove_repeats(spark.createDataFrame([], "doc_id long, text string"), length=20)


def test_window_runs_cover_every_position_once():
    rnd = random.Random(3)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 200))) for _ in range(50)] + [b"a" * 300]
    offsets = np.cumsum([0, *map(len, texts)])
    start, n, anchor = window_runs(np.frombuffer(b"".join(texts), np.uint8), offsets, 50, 20)
    covered = np.concatenate([np.arange(s, s + k) for s, k in zip(start, n)])
    want = [p for k, t in enumerate(texts) for p in range(offsets[k], offsets[k] + len(t) - 49)]
    assert sorted(covered.tolist()) == want and n.max() <= 31
    joined, by = b"".join(texts), {}
    for s, k, a in zip(start, n, anchor):  # equal strings have equal anchors
        for p in range(s, s + k):
            assert by.setdefault(joined[p : p + 50], a) == a


def test_long_factors_are_the_longest_previous_ones():
    rnd = random.Random(9)
    text = bytes(rnd.choice(b"ab") for _ in range(400))
    docs = np.array([p // 100 for p in range(400)])
    at = np.arange(350)
    got = long_factors(np.frombuffer(text + bytes(64), np.uint8), at, docs[at], 12)
    for p in at:
        longest = max((next((k for k in range(12) if text[p + k] != text[q + k]), 12) for q in at if docs[q] < docs[p]), default=0)
        assert got[p] == (longest if longest == 12 else 0)


def test_nearest_smaller():
    rnd = np.random.default_rng(4)
    docs, lcp = rnd.integers(0, 6, 200), rnd.integers(0, 9, 200)
    got = nearest_smaller(docs, lcp, 1)
    for i in range(200):
        low, want = 99, 0
        for j in range(i - 1, -1, -1):
            low = min(low, lcp[j + 1])
            if docs[j] < docs[i]:
                want = low
                break
        assert got[i] == want


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, k):
    bags = [(d, terms_of(t)) for d, t in docs]
    bags = [(d, len(t), Counter(t)) for d, t in bags if t]
    n_docs, n_terms = len(bags), sum(n for _, n, _ in bags)
    df = Counter(t for _, _, bag in bags for t in bag)
    out = []
    for item, text in items:
        found = []
        for d, n, bag in bags:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in set(terms_of(text)) if t in bag)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def words_of(rnd, n):
    return " ".join(rnd.choice(["the", "of", "Ünder", "ok1"]) if rnd.random() < 0.5 else f"t{int(rnd.paretovariate(0.6)) % 300}" for _ in range(n))


def found_hits(spark, docs, items, **options):
    one = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as terms", "3 as item")
    other = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as number")
    return sorted((tuple(r) for r in trie_search(one.repartition(3), other, **options).collect()), key=repr)


@pytest.mark.parametrize("seed, sample, group", [(1, 20_000, 1_000_000), (2, 40, 60)])
def test_search_against_every_document(spark, monkeypatch, seed, sample, group):
    """Also with a sample for the first thresholds, several groups and blocks of items, and several tries a task."""
    monkeypatch.setattr(fp_search, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(fp_search, "CHUNK_DOCS", 70)
    monkeypatch.setattr(fp_search, "LEAF", 4)
    rnd = random.Random(seed)
    docs = [(i, words_of(rnd, rnd.randint(0, 60))) for i in range(300)]
    items = [(i, words_of(rnd, rnd.randint(0, 15))) for i in range(12)]
    assert found_hits(spark, docs, items, k=7, sample=sample, group_terms=group) == plain_search(docs, items, 7)


def test_search_of_odd_rows(spark):
    docs = [(None, "same words here"), (5, "same words here"), (5, "same words here"), (3, "SAME, words-here!"), (1, None), (2, ""), (4, "?!"), (6, "long " * 50_000 + "here"), (7, "Änder änder")]
    items = [(1, "words same"), (1, "words same"), (2, None), (3, ""), (None, "here"), (4, "missing"), (5, "Änder here long"), (6, "a " * 3000 + "here")]
    assert found_hits(spark, docs, items, k=3) == plain_search(docs, items, 3)
    assert found_hits(spark, [], items) == [] and found_hits(spark, docs, []) == []


def test_bounds_cut_subtrees_and_stay_above_the_scores():
    rnd = np.random.default_rng(2)
    rows = [np.unique(rnd.integers(0, 40, rnd.integers(1, 12))) for _ in range(500)]
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    term, tf, m = np.concatenate(rows), rnd.integers(1, 5, ptr[-1]), rnd.integers(50, 200, 500)
    weight = rnd.integers(1, 9000, 40)
    trie = Trie(ptr, term, tf, m, weight)

    def below(node):
        return list(range(trie.leaf_at[node], trie.leaf_at[node + 1])) if isinstance(node, int) else [d for x in node["below"] for d in below(x)]

    todo, tree = [trie.bounded()], 0
    assert sorted(below(todo[0])) == list(range(500))
    while todo:
        node = todo.pop()
        if isinstance(node, int):
            continue
        tree += 1
        todo += node["below"]
        for k, child in enumerate(node["below"]):
            for d in below(child):
                i = trie.order[d]
                for t, f in zip(term[ptr[i] : ptr[i + 1]], tf[ptr[i] : ptr[i + 1]]):
                    assert share(weight[t], f, m[i]) <= node["bounds"][k, np.searchsorted(node["terms"], t)]
    assert tree > 5


def test_repeats_query_columns(spark):
    from tablesync.llm.queries import QUERIES

    out = QUERIES["op13_previous_factors"](spark, "/root/testdata/sf0.001")
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    clean = out.where("n_removed = 0").join(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id")
    assert clean.count() and clean.where(F.sha2("text", 256) != F.col("kept_sha256")).count() == 0
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit("").cast("binary"), 256)).first()[0]
