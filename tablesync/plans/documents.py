"""nested metric documents built from ``lineitem``, shaped like the reference's port-metric
report (storage -> director -> groups of metrics -> data points).

Mapping: one document per block of ``DOC_ORDERS`` consecutive order keys, a natural key whose size does not grow with
the table; storages are return flags, directors line statuses; ``portMetricDataList`` holds one group per line
number present, in order; a metric is the last digit of the supplier; its data points are the lines, sorted by
(ship date, order key, supplier, part, quantity), with ``value`` = quantity and ``ts`` = ship date.

All grouping levels share one shuffle: the lines are hash-partitioned once by the document key and every later grouping
key contains it. No supplier, part or flag is a key of its own, so none of them can be hot.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.nested import Level

DOC_ORDERS = 1024
FILE_DOCS = 1024  # documents in a file of one array

POINT = T.StructType([
    T.StructField("value", T.DoubleType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("order_key", T.LongType()),
    T.StructField("line_no", T.IntegerType()),
])
METRIC = T.StructType([T.StructField("metricid", T.StringType()), T.StructField("data", T.ArrayType(POINT))])
DIRECTOR = T.StructType([
    T.StructField("directorId", T.StringType()),
    T.StructField("portMetricDataList", T.ArrayType(T.ArrayType(METRIC))),
])
STORAGE = T.StructType([T.StructField("storageid", T.StringType()), T.StructField("fedirectorList", T.ArrayType(DIRECTOR))])
DOCUMENT = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField("errorcode", T.StringType()),
    T.StructField("errormessage", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("sublabel", T.StringType()),
    T.StructField("storageidlist", T.ArrayType(STORAGE)),
])


def _block():
    return F.floor(F.col("l_orderkey") / DOC_ORDERS).cast("long").alias("block")


def array_files(lineitem: DataFrame) -> int:
    """How many files of ``FILE_DOCS`` documents each ``metric_documents`` fills (reads the order keys)."""
    return max(1, math.ceil(lineitem.select(_block()).distinct().count() / FILE_DOCS))


def metric_documents(lineitem: DataFrame) -> DataFrame:
    block = _block()
    metric = F.pmod("l_suppkey", F.lit(10)).cast("string").alias("metric")
    cols = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_shipdate", "l_orderkey", "l_suppkey", "l_partkey"]
    pts = lineitem.select(block, metric, *cols).repartition("block")
    sort_point = F.struct(
        F.col("l_shipdate").alias("s"), F.col("l_orderkey").alias("o"), F.col("l_suppkey").alias("u"), F.col("l_partkey").alias("p"),
        F.col("l_quantity").alias("q"), F.col("l_linenumber").alias("l"),
    )
    metrics = pts.groupBy("block", "l_returnflag", "l_linestatus", "l_linenumber", "metric").agg(
        F.array_sort(F.collect_list(sort_point)).alias("_pts"), F.max("l_shipdate").alias("_last")
    ).select(
        "block", "l_returnflag", "l_linestatus", "l_linenumber", "_last",
        F.struct(
            F.col("metric").alias("metricid"),
            F.transform("_pts", lambda p: F.struct(
                p["q"].alias("value"), p["s"].alias("ts"), p["o"].alias("order_key"), p["l"].alias("line_no"))).alias("data"),
        ).alias("m"),
    )
    groups = metrics.groupBy("block", "l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.array_sort(F.collect_list("m")).alias("g"), F.max("_last").alias("_last")
    )
    directors = groups.groupBy("block", "l_returnflag", "l_linestatus").agg(
        F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("k"), F.col("g").alias("g")))).alias("_gs"),
        F.max("_last").alias("_last"),
    ).select(
        "block", "l_returnflag", "_last",
        F.struct(F.col("l_linestatus").alias("directorId"), F.transform("_gs", lambda x: x["g"]).alias("portMetricDataList")).alias("d"),
    )
    storages = directors.groupBy("block", "l_returnflag").agg(F.array_sort(F.collect_list("d")).alias("dirs"), F.max("_last").alias("_last")).select(
        "block", "_last", F.struct(F.col("l_returnflag").alias("storageid"), F.col("dirs").alias("fedirectorList")).alias("st")
    )
    docs = storages.groupBy("block").agg(F.array_sort(F.collect_list("st")).alias("storageidlist"), F.max("_last").alias("_last"))
    return docs.select(
        F.format_string("orders-%d", F.col("block")).alias("ip"),
        F.date_format("_last", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.lit("0").alias("errorcode"), F.lit("").alias("errormessage"), F.lit("port").alias("label"),
        F.lit("ok").alias("status"), F.lit("fe").alias("sublabel"),
        "storageidlist",
    )


# The stated goal of the flatten: ip, storageid, directorid, metricid, value, ts; one row per point.
LONG_LEVELS = [
    Level("storageidlist", {"storageid": "storageid"}),
    Level("fedirectorList", {"directorid": "directorId"}),
    Level("portMetricDataList", {}, position="group_no"),
    Level("", {"metricid": "metricid"}),
    Level("data", {"value": "value", "ts": "ts"}),
]

# Down to one row per metric, keeping its data array (for the wide form).
METRIC_LEVELS = [
    Level("storageidlist", {"storageid": "storageid"}),
    Level("fedirectorList", {"directorid": "directorId"}),
    Level("portMetricDataList", {}, position="group_no"),
    Level("", {"metricid": "metricid", "data": "data"}),
]
