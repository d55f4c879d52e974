"""BM25 search and license scans against plain computations."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tablesync.llm import bm25
from tablesync.llm.bm25 import top_k_search
from tablesync.llm.licenses import scan_licenses


def plain_search(docs, queries, k):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    bags = [(i, Counter(re.findall("[a-z0-9\u0080-\U0010ffff]+", low(t)))) for i, t in docs]
    df = Counter(w for _, b in bags for w in b)
    n, mean = len(bags), sum(sum(b.values()) for _, b in bags) / len(bags)
    out = []
    for q, t in queries:
        found = []
        for i, b in bags:
            words = set(re.findall("[a-z0-9\u0080-\U0010ffff]+", low(t))) & b.keys()
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean)) for w in words)
            if words:
                found.append((-round(s, 6), i is None, i or 0))
        out += [(q, rank + 1, None if null else i, pytest.approx(-s, abs=2e-6)) for rank, (s, null, i) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("postings", [60, 3000])
def test_search_against_all_rows(spark, postings):
    rnd = random.Random(8)
    words = [f"{c}{k}" for c in "abÀ" for k in range(40)]
    text = lambda: rnd.choice([" ", ", "]).join(rnd.choice(words[: rnd.choice([5, 30, 120])]).upper() for _ in range(rnd.randint(1, 60)))
    docs = [(i, text()) for i in range(400)]
    docs += docs[:20] + [(1000, None), (1001, ""), (None, docs[3][1]), (1002, "?!"), (1003, "a1 " * 20_000)]
    queries = [d for d in docs if d[0] is not None and d[0] % 25 == 0 and d[0] < 400][:16] + [(500, "unseenword"), (501, None)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string").selectExpr("*", "1 score", "2 h")
    got = top_k_search(frame(docs, "doc_id").repartition(3), frame(queries, "query_id"), k=7, shard_postings=postings, block_words=90).collect()
    got = sorted((tuple(r) for r in got), key=lambda r: r[:2])
    assert got == sorted(plain_search(docs, dict(queries).items(), 7), key=lambda r: r[:2])



def test_search_for_more_queries_than_a_group(spark):
    rnd = random.Random(18)
    words = [[f"{c}{k}" for k in range(60)] for c in "abc"]
    docs = [(i, " ".join([own[0], *rnd.choices(own, k=rnd.randint(2, 12))])) for i in range(300) for own in [rnd.choice(words)]]
    frame = lambda name: spark.createDataFrame(docs, f"{name} long, text string")
    got = top_k_search(frame("doc_id").repartition(2), frame("query_id"), k=3, shard_postings=500).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_search(docs, docs, 3), key=lambda x: x[:2])


def test_index_is_stored_and_searched_shard_by_shard(spark, monkeypatch, tmp_path):
    docs = spark.range(240, numPartitions=1).selectExpr("id doc_id", "concat_ws(' ', transform(sequence(0, 9999), x -> concat('w', id * 10000 + x))) text")
    stashed, stash = {}, bm25.stash

    def seen(df, name, **how):
        stashed[name] = how, df
        return stash(df, name, **how)

    monkeypatch.setattr(bm25, "stash", seen)
    got = top_k_search(docs, docs.where("doc_id = 7").withColumnRenamed("doc_id", "query_id"), shard_postings=100_000)
    assert [r["doc_id"] for r in got.collect()] == [7]
    assert stashed["answers"][0]["batch_rows"] == 1
    how, index = stashed["index"]
    index.write.options(**how).parquet(f"{tmp_path}/index")
    groups = [g for f in tmp_path.glob("index/*.parquet") for m in [pq.ParquetFile(f).metadata] for g in map(m.row_group, range(m.num_row_groups))]
    assert len(groups) > 1 and sum(g.num_rows for g in groups) > 20  # shards of 0.8 MB of words and more
    assert max(g.total_byte_size for g in groups) < 24e6


def test_shards_of_short_documents_are_bounded(spark):
    docs = spark.range(5000, numPartitions=1).selectExpr("id doc_id", "if(id % 100 = 0, 'some words', '') text")
    index = bm25.stash(bm25.build_index(docs, 32_000), "index")
    assert [r["n_docs"] for r in index.collect()] == [1000] * 5
    got = top_k_search(docs, docs.where("doc_id = 700").withColumnRenamed("doc_id", "query_id"), k=3, shard_postings=32_000)
    assert [r["doc_id"] for r in got.orderBy("rank").collect()] == [0, 100, 200]


def test_search_keeps_one_shard_in_memory(monkeypatch):
    alive, most = [0], [0]

    class Counted(bm25.Shard):
        def __init__(self, *a):
            alive[0] += 1
            most[0] = max(most[0], alive[0])
            super().__init__(*a)

        def __del__(self):
            alive[0] -= 1

    class Functions:
        def mapInArrow(self, function, schema):
            return function

    class Shared:
        value = bm25._query_block(pa.table({"query_id": [5], "h": pa.array([11], pa.int64()), "idf": [1.0]}))

    monkeypatch.setattr(bm25, "Shard", Counted)
    arrays = {"doc_ids": ([1, 2], "i8"), "is_null": ([0, 0], "?"), "lengths": ([1, 2], "i8"), "terms": ([11, 12], "u8"), "starts": ([0, 2, 3], "i8"), "ords": ([0, 1, 1], "u4"), "counts": ([1, 1, 1], "u4")}
    shard = {"n_docs": 2, "words": 3} | {k: bm25.packed(bm25.np.array(v, kind)) for k, (v, kind) in arrays.items()}
    search = bm25._search_block(Functions(), Shared(), 10, 1.5, 1.2, 0.75)
    found = list(search([pa.RecordBatch.from_pylist([shard] * 3)] * 2))
    assert [b.column("doc_id").to_pylist() for b in found] == [[1, 2]] * 6
    assert most[0] == 1


class InProcess:
    """In place of a DataFrame: gives the function of mapInArrow."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        return function


def shards_and_queries(n):
    rnd = random.Random(28)
    words = [f"{c}{k}" for c in "abc" for k in range(3000)]
    texts = [" ".join(rnd.choices(words, cum_weights=range(1, 9001), k=rnd.randint(1, 250))) for _ in range(n)]
    docs = pa.record_batch({"doc_id": pa.array(range(n), pa.int64()), "text": texts})
    shards = [r for b in bm25.build_index(InProcess(), 9_000)(docs.slice(i, 80) for i in range(0, n, 80)) for r in b.to_pylist()]
    asked = [(i, h) for lo, _, row, hashes, _ in bm25.bags(docs.column("text")) for i, h in zip((lo + row).tolist(), hashes.view("i8").tolist()) if i % 3 == 0]
    query, h = map(list, zip(*asked))
    idf = [1 + (x % 1000) / 500 for x in h]
    return shards, bm25._query_block(pa.table({"query_id": query, "h": pa.array(h, pa.int64()), "idf": idf}))


def searched(shards, block, floor=None):
    """The scores of all answers by (query, document)."""
    shared = type("Shared", (), {"value": block})
    batches = [pa.RecordBatch.from_pylist(shards)]
    floor = floor if floor is None else type("Floor", (), {"value": floor})
    found = [r for b in bm25._search_block(InProcess(), shared, 5, 130.0, 1.2, 0.75, floor)(batches) for r in b.to_pylist()]
    return {(r["query_id"], r["doc_id"]): r["score"] for r in found}


def test_long_queries_are_added_up_with_the_answers_of_block_maxima(spark, monkeypatch):
    shards, block = shards_and_queries(400)
    assert len(shards) > 2 and len(block[0]) > bm25.QUERIES
    used, best = [], bm25.Shard.best
    monkeypatch.setattr(bm25.Shard, "best", lambda *a: used.append(1) or best(*a))
    summed = searched(shards, block)
    assert not used
    monkeypatch.setattr(bm25, "BLOCKS_PAY", 0)
    assert searched(shards, block) == pytest.approx(summed, abs=2e-6) and used
    monkeypatch.setattr(bm25, "BLOCKS_PAY", float("inf"))
    monkeypatch.setattr(bm25, "POSTS", 1)
    assert searched(shards, block) == pytest.approx(summed, abs=2e-6)


def test_known_scores_leave_the_best_answers(spark):
    shards, block = shards_and_queries(400)
    every, order = searched(shards, block), lambda found, q: sorted((-s, d) for (i, d), s in found.items() if i == q)[:5]
    kth = bm25.np.array([-order(every, q)[-1][0] for q in block[0]])
    some = searched(shards, block, kth)
    assert len(some) < len(every) and all(order(some, q) == order(every, q) for q in block[0])


def test_some_shards_are_searched_first(spark, monkeypatch):
    rnd = random.Random(38)
    words = [f"w{k}" for k in range(80)]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 20)))) for i in range(2000)]
    first, stash = {}, bm25.stash
    monkeypatch.setattr(bm25, "stash", lambda df, name, **how: first.setdefault(name, stash(df, name, **how)) if name in ("kth-scores", "first-shards") else stash(df, name, **how))
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string")
    got = top_k_search(frame(docs, "doc_id").repartition(48), frame(docs[:12], "query_id"), k=3, shard_postings=320).collect()
    want = plain_search(docs, docs[:12], 3)
    assert sorted(tuple(r) for r in got) == sorted(want, key=lambda x: x[:2])
    least = {r["query_id"]: r["score"] for r in first["kth-scores"].collect()}
    assert least and all(s <= r["score"] + 1e-6 for r in got if r["rank"] == 3 and (s := least.get(r["query_id"])) is not None)
    assert 0 < first["first-shards"].count() < 24  # of 48


def test_search_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b"), (1, "b"), (None, "a")], "query_id long, text string")
    assert top_k_search(none, one).count() == 0
    docs = spark.createDataFrame([(3, "a b"), (2, "a b"), (None, "a b")], "doc_id long, text string")
    assert [r["doc_id"] for r in top_k_search(docs, one, k=5).orderBy("rank").collect()] == [2, 3, None]
    assert top_k_search(docs, one.limit(0)).count() == 0


def test_license_scan(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    rows = [
        (1, "a/LICENSE", apache),
        (2, "a/b/c/x.txt", "no notice"),
        (3, "a/b/LICENSE.md", f"# head\n{mit}\nmore words that are not a notice at all, in another line"),
        (4, "a/b/c/y.txt", None),
        (5, "a/z.txt", f"code\r\n{mit}\r\ncode code code"),
        (6, "c/x.txt", "the license of this poem is a matter of debate among its many readers"),
        (7, None, mit),
        (8, "top.txt", ""),
        (9, "ab/x.txt", "x"),
        (9, "ab/x.txt", "x"),
        (10, "a/w.txt", "words " * 50_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string").selectExpr("*", "1 score", "2 license", "3 file")
    got = {r["doc_id"]: (r["own_license"], r["license"], r["inherited_from"]) for r in scan_licenses(docs).collect()}
    assert got == {
        1: ("Apache-2.0", "Apache-2.0", None),
        2: (None, "MIT", "a/b"),
        3: ("MIT", "MIT", None),
        4: (None, "MIT", "a/b"),
        5: ("MIT", "MIT", None),
        6: (None, None, None),
        7: ("MIT", "MIT", None),
        8: (None, None, None),
        9: (None, None, None),
        10: (None, "Apache-2.0", "a"),
    }
    assert scan_licenses(docs).count() == len(rows)
    assert scan_licenses(docs.limit(0)).count() == 0


def test_license_tags_and_wrapped_headers(spark):
    apache = (
        "Licensed under the Apache License, Version 2.0 (the \"License\");|you may not use this file except in compliance with the License.|You may obtain a copy of the License at||    http://www.apache.org/licenses/LICENSE-2.0||"
        "Unless required by applicable law or agreed to in writing, software|distributed under the License is distributed on an \"AS IS\" BASIS,|WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ).split("|")
    code = "\n".join(f"value{k} = compute{k}(alpha{k}, beta{k})" for k in range(300))
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:"
    agpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Affero General Public License as\n# published by the Free Software Foundation, either version 3 of the\n# License, or (at your option) any later version."
    texts = {
        "MIT": "// SPDX-License-Identifier: MIT\n" + code,
        "Apache-2.0": code + "\n" + "\n".join(" * " + line for line in apache) + "\n" + code,
        "BSD-3-Clause": code + "\n" + bsd + "\n" + code,
        "AGPL-3.0": agpl + "\n" + code,
        "GPL-3.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n" + "The licenses for most works are designed to take away your freedom. " * 50,
        "LGPL-2.1": "/* SPDX-License-Identifier: LGPL-2.1-or-later */",
        "": "// SPDX-License-Identifier: LicenseRef-Own\n" + code,
    }
    docs = spark.createDataFrame([(k, f"d{k}/f", t) for k, t in enumerate(texts.values())], "doc_id long, path string, text string")
    got = {r["doc_id"]: r["own_license"] for r in scan_licenses(docs).collect()}
    assert got == {k: name or None for k, name in enumerate(texts)}


def test_the_sql_finds_wrapped_headers_too(spark, tmp_path):
    """Runs of lines, in the operator and in its SQL."""
    import duckdb

    from tablesync.llm.queries import ORACLE, QUERIES

    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:"
    code = "\n".join(f"value{k} = compute{k}(alpha{k})" for k in range(40))
    texts = [f"{code}\n{bsd}\n{code}", f"{code}\r\n{bsd}", bsd, "Released under the\nMIT License.", "license " * 400, "a license\n\n\n" + "word " * 300 + "\nReleased under the MIT License.", code, None, ""]
    rows = [(20 * k, t, "en", "s", 1) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    order = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    got = QUERIES["op10_license_scan"](spark, str(tmp_path))
    want = con.sql(ORACLE["op10_license_scan"]).select(*got.columns).fetchall()
    assert order(map(tuple, got.collect())) == order(want)
    assert [r["own_license"] for r in got.orderBy("doc_id").collect()][:4] == ["BSD-3-Clause"] * 3 + ["MIT"]


def test_queries_are_pruned_together(monkeypatch):
    """One call prunes the blocks of a whole group of queries, with the best documents of each."""
    import numpy as np

    from tablesync.llm import bm25

    rng = np.random.default_rng(3)
    tf = rng.integers(0, 4, (30, 400)) * (rng.random((30, 400)) < 0.1)
    tf[0, :100] = 1  # a frequent word
    term, doc = np.nonzero(tf)
    size = tf.sum(axis=0).astype(np.int64)
    arrays = {"doc_ids": np.arange(400), "is_null": np.zeros(400, bool), "lengths": size, "terms": np.arange(30, dtype=np.uint64),
              "starts": np.searchsorted(term, np.arange(31)), "ords": doc.astype(np.uint32), "counts": tf[term, doc].astype(np.uint32)}
    shard = bm25.Shard({k: v.tobytes() for k, v in arrays.items()}, float(size.mean()), 1.2, 0.75)
    held = [np.sort(rng.choice(40, 12, replace=False)) for _ in range(50)]  # words 30 to 39 are in no document
    first, words = np.cumsum([0, *map(len, held)]), np.concatenate(held)
    distinct, number = np.unique(words.astype(np.uint64), return_inverse=True)
    idf = 1 + (words % 7) / 3
    calls, one = [], bm25.Shard.best
    monkeypatch.setattr(bm25.Shard, "best", lambda self, *a: calls.append(1) or one(self, *a))
    found = {int(q): dict(zip(docs.tolist(), scores)) for q, docs, scores in shard.search(first, distinct, number, idf, 10, np.zeros(50))}
    assert len(calls) <= 2
    gain = tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / size.mean()))
    for q, mine in enumerate(held):
        score = sum(w * gain[t] if t < 30 else 0 for t, w in zip(mine, idf[first[q] : first[q + 1]]))
        for d in np.argsort(-score, kind="stable")[:10]:
            assert score[d] == 0 or abs(found[q][int(d)] - score[d]) < 1e-9
