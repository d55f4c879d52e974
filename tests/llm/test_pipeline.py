"""The pipeline as a whole, its stages' contracts, and the queries with SQL."""

import os
import sys

import numpy as np
import pytest

from tablesync.llm.packing import lower_bound

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_clean_documents(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dups", "pii", "mixing", "packing"]
    found = P.language_id(spark, docs, SF)
    assert found.columns == P.COLUMNS and found.count() == docs.count()
    junk = spark.createDataFrame([(-1, "123 456", None, "x", 7), (-2, None, None, "x", 0)], docs.schema)
    assert P.language_id(spark, docs.union(junk), SF).where("doc_id < 0").count() == 0
    apart = P.near_dups(spark, docs, SF)
    assert apart.columns == P.COLUMNS and apart.count() == apart.select("doc_id").distinct().count() < docs.count()
    assert P.pii(spark, docs, SF).where("n_chars != length(text)").count() == 0
    mixed = P.mixing(spark, docs, SF)
    assert mixed.columns == P.COLUMNS and mixed.groupBy("doc_id").count().where("count > 2").count() == 0


def test_run(spark):
    import corpus_pipeline as P

    rows = P.run(spark, SF).collect()
    ends = {}
    for r in rows:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["offset"] + r["length"]))
    for places in ends.values():
        at = 0
        for a, b in sorted(places):
            assert a == at
            at = b
        assert at <= 1024
    sizes = np.array([r["length"] for r in rows])
    assert len(ends) <= lower_bound(sizes, 1024) + 2


def test_an_empty_table_runs_through(spark, tmp_path):
    import corpus_pipeline as P

    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_sql_agrees(spark):
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from oracle_check import compare

    from tablesync.llm.queries import ORACLE

    for name, status in compare(spark, SF, sorted(ORACLE), verbose=False).items():
        assert status[0] == "OK", (name, status)


@pytest.mark.parametrize("n", range(1, 14))
def test_every_operator_has_a_query(n):
    from tablesync.llm.queries import QUERIES

    assert sum(name.startswith(f"op{n}_") for name in QUERIES) == 1
