"""Every registered query against its DuckDB oracle (rows, column names, values)."""

import os

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tools.oracle_check import compare

from tablesync.plans import registry

registry.load_all()
NAMES = sorted(registry.QUERIES)  # the other queries have tests of their own
SF = os.environ.get("TABLESYNC_TEST_SF", SF_SMALL)


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res[0] in ("OK", "NO_ORACLE"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-2:] == ["INSERT_DATE", "UPDATE_DATE"]
