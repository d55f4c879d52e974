"""Hot keys and hot groups: results stay whole and no group is collected into one row unbounded."""

import contextlib
import io
import json

from pyspark.sql import functions as F

from tablesync.operators.changes import collapse_changes
from tablesync.operators.nested import flatten_long
from tablesync.plans.documents import LONG_LEVELS, metric_documents
from tablesync.schema import TargetSpec
from tablesync.sources.envelope import change_rows, parse_envelope, split_bad

from conftest import SF_SMALL


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_collapse_with_a_hot_key(spark):
    """A key with a third of the batch: one survivor, the latest, and the plan combines per key
    before the shuffle (partial aggregate below the exchange)."""
    spec = TargetSpec.of("T.KV", spark.createDataFrame([], "k long, v string").schema, "k")
    lines = []
    for i in range(3000):
        k = 0 if i % 3 == 0 else i
        lines.append(json.dumps({"table": "T.KV", "op_type": "U", "op_ts": "2024-01-01 00:00:00.000000",
                                 "pos": f"{i:020d}", "after": {"k": k, "v": f"v{i}"}}))
    raw = spark.createDataFrame([(x,) for x in lines], "value string").repartition(8)
    ch, _ = change_rows(split_bad(parse_envelope(raw))[0], spec)
    out = collapse_changes(ch, ["k"])
    got = {r["k"]: r["_img"]["v"] for r in out.collect()}
    assert len(got) == 2001 and got[0] == "v2997"
    plan = _plan(out)
    assert "partial_max_by" in plan and plan.index("partial_max_by") > plan.index("Exchange")


def test_a_hot_supplier_gives_the_same_rows(spark):
    """Documents do not depend on how many lines a supplier has."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = li.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey")).cast("long"))
    for lines in (li, hot):
        flat = flatten_long(metric_documents(lines), ["ip"], LONG_LEVELS)
        assert flat.count() == li.count()
        want = lines.groupBy(F.pmod("l_suppkey", F.lit(10)).cast("string").alias("metricid"), F.col("l_returnflag").alias("storageid")).count()
        got = flat.groupBy("metricid", "storageid").count()
        assert sorted(want.collect()) == sorted(got.collect())
