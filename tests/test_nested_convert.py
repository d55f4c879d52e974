"""Nested flatten on a hand-made document; conversions and retention edge cases."""

import pytest
from pyspark.sql import functions as F

from tablesync.functions.convert import age_days, cast_columns, purge_due
from tablesync.operators.nested import Level, explode_column, flatten_long, pivot_points
from tablesync.operators.retention import purge_by_id, purge_expired
from tablesync.plans.documents import DOCUMENT, LONG_LEVELS, METRIC_LEVELS


def _doc(spark):
    def pts(n, base):
        return [{"value": float(base + i), "ts": None, "order_key": base, "line_no": i} for i in range(n)]

    def metric(mid, n, base):
        return {"metricid": mid, "data": pts(n, base)}

    def director(did, base):
        return {"directorId": did, "portMetricDataList": [[metric("m1", 2, base), metric("m2", 2, base + 10)],
                                                           [metric("m3", 2, base + 20), metric("m4", 2, base + 30)]]}

    full = {"ip": "d1", "storageidlist": [
        {"storageid": "s1", "fedirectorList": [director("a", 100), director("b", 200)]},
        {"storageid": "s2", "fedirectorList": [director("c", 300), director("d", 400)]},
    ]}
    edge = {"ip": "d2", "storageidlist": [
        {"storageid": "s3", "fedirectorList": None},
        {"storageid": "s4", "fedirectorList": [{"directorId": "e", "portMetricDataList": [[
            {"metricid": "empty", "data": []}, {"metricid": "one", "data": pts(1, 500)}]]}]},
    ]}
    return spark.createDataFrame([full, edge], DOCUMENT)


def test_correlated_flatten_has_only_true_pairs(spark):
    out = flatten_long(_doc(spark).where("ip = 'd1'"), ["ip"], LONG_LEVELS)
    rows = out.collect()
    assert len(rows) == 32  # 2 storages x 2 directors x 2 groups x 2 metrics x 2 points
    pairs = {(r["storageid"], r["directorid"]) for r in rows}
    assert pairs == {("s1", "a"), ("s1", "b"), ("s2", "c"), ("s2", "d")}


def test_flatten_edges_inner_and_outer(spark):
    d = _doc(spark).where("ip = 'd2'")
    inner = flatten_long(d, ["ip"], LONG_LEVELS).collect()
    assert [(r["metricid"], r["value"]) for r in inner] == [("one", 500.0)]
    outer_levels = [Level(lv.array, lv.keep, lv.position, outer=True) for lv in LONG_LEVELS]
    outer = flatten_long(d, ["ip"], outer_levels).collect()
    assert sorted((r["storageid"], r["metricid"]) for r in outer) == [("s3", None), ("s4", "empty"), ("s4", "one")]


def test_wide_form_nulls_for_missing_points(spark):
    m = flatten_long(_doc(spark).where("ip = 'd2'"), ["ip"], METRIC_LEVELS)
    w = {r["metricid"]: r for r in pivot_points(m, "data", 2, {"value": "value"}).collect()}
    assert w["one"]["value_1"] == 500.0 and w["one"]["value_2"] is None
    assert w["empty"]["value_1"] is None


def test_explode_outer_keeps_empty(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, a array<int>")
    assert explode_column(df, "a", "x").count() == 2
    assert explode_column(df, "a", "x", outer=True).count() == 4


def test_cast_columns_bad_text_and_unknown_type(spark):
    df = spark.createDataFrame([("12", "true", "2024-01-02", "x")], "a string, b string, c string, d string")
    r = cast_columns(df, {"a": "Integer", "b": "Boolean", "c": "Date", "d": "Integer"}).collect()[0]
    assert (r["a"], r["b"], str(r["c"]), r["d"]) == (12, True, "2024-01-02", None)
    with pytest.raises(ValueError):
        cast_columns(df, {"a": "Float"})


def test_age_days_has_no_year_wrap(spark):
    """D9: 370 days is 370 (the reference's modulo 365 would give 5, not due)."""
    df = spark.createDataFrame([("2023-01-01 00:00:00", "2024-01-06 00:00:00")], "a string, b string") \
        .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    r = df.select(age_days(F.col("a"), F.col("b")).alias("d"), purge_due(F.col("a"), F.col("b")).alias("due")).collect()[0]
    assert (r["d"], r["due"]) == (370, True)


def test_purge_null_date_kept_and_by_key(spark):
    df = spark.createDataFrame(
        [(1, "2000-01-01"), (1, "2023-12-31"), (2, None), (3, "2023-12-31")], "k int, d string"
    ).select("k", F.col("d").cast("timestamp_ntz").alias("UPDATE_DATE"))
    by_row = sorted(r["k"] for r in purge_expired(df, 30, "2024-01-01 00:00:00").collect())
    by_key = sorted(r["k"] for r in purge_expired(df, 30, "2024-01-01 00:00:00", keys=["k"]).collect())
    assert by_row == [1, 2, 3] and by_key == [2, 3]
    assert sorted(r["k"] for r in purge_by_id(df, "k", 1).collect()) == [2, 3]
