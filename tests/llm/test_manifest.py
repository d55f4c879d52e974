"""The Merkle manifest against trees built one hash at a time."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tablesync.llm.manifest import fold, manifest_nodes, merkle_manifest, proof_digest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def expected(rows):
    """(doc_id, leaf, subroot, root, siblings) of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    order = lambda row: (row[0] is not None, row[0] or 0, leaf_of(row))
    trees = [levels_of([leaf_of(r) for r in sorted(groups[lang], key=order)]) for lang in langs]
    top = levels_of([t[-1][0] for t in trees])
    out = []
    for q, lang in enumerate(langs):
        for r, row in enumerate(sorted(groups[lang], key=order)):
            siblings = []
            for levels, at in ((trees[q], r), (top, q)):
                for level in levels[:-1]:
                    siblings += [level[at ^ 1]] if at ^ 1 < len(level) else []
                    at >>= 1
            out.append((row[0], leaf_of(row), trees[q][-1][0], top[-1][0], digest(*siblings)))
    return sorted(out, key=str)


def found(spark, rows, bits=2):
    out = merkle_manifest(spark.createDataFrame(rows, SCHEMA), FIELDS, "lang", "doc_id", [F.col("doc_id")], bits)
    got = out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")), fold(F.col("leaf"), F.col("path")).alias("folded")).collect()
    assert all(r.folded == r.root for r in got)
    return sorted((tuple(r)[:5] for r in got), key=str)


@pytest.mark.parametrize("n", [1, 2, 5, 17, 65])
def test_trees_of_all_heights(spark, n):
    rows = [(i, "s", "de" if i % 3 else "fr", i, f"text {i}") for i in range(n)]
    assert found(spark, rows) == expected(rows)


def test_nulls_ties_repeats_long_texts(spark):
    rows = [(None, None, None, None, None), (1, "", "", 0, ""), (1, "", "", 0, ""), (1, "x", "", 0, "é€"), (7, "a", "zz", 3, "w " * 200_000), (8, "a", "é", 3, None), (None, "a", "é", 3, "")]
    rows += [(9, "copy", "hot", 1, "same")] * 40
    assert found(spark, rows) == expected(rows)


def test_empty_table_and_other_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merkle_manifest(none, FIELDS, "lang", "doc_id", [F.col("doc_id")]).collect() == []
    rows = [(i, "s", "de", i, "t") for i in range(6)]
    more = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as lo", "'x' as tree", "2 as digest", "3 as total", "4 as path", "5 as own")
    assert {r.root for r in merkle_manifest(more, FIELDS, "lang", "doc_id", [F.col("doc_id")]).collect()} == {expected(rows)[0][3]}


def test_a_changed_field_does_not_verify(spark):
    rows = [(i, "s", "de", i, "t") for i in range(9)]
    out = merkle_manifest(spark.createDataFrame(rows, SCHEMA), FIELDS, "lang", "doc_id", [F.col("doc_id")], 2)
    forged = F.lit(leaf_of((4, "s", "de", 5, "t")))
    assert [r.doc_id for r in out.where(fold(F.when(F.col("doc_id") == 4, forged).otherwise(F.col("leaf")), F.col("path")) != F.col("root")).collect()] == [4]


def test_nodes_carry_their_intervals(spark):
    rows = [(i, "s", "de", i, "t") for i in range(11)]
    nodes = manifest_nodes(spark.createDataFrame(rows, SCHEMA), FIELDS, "lang", "doc_id", 2).collect()
    levels = levels_of([leaf_of(r) for r in rows])
    want = {("de", k, i << k, min((i + 1) << k, 11), d) for k, level in enumerate(levels) for i, d in enumerate(level)}
    assert {tuple(n) for n in nodes} == want and len(nodes) == len(want)
