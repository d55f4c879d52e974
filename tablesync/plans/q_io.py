"""Source and sink round trips: JSON lines, CSV, typed delimited text, ORC, text lines, and the
two-slot snapshot store. Files go below the session's checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import apply_changes
from ..operators.retention import purge_expired
from ..session import scratch_path
from ..sinks.files import write_csv, write_json_lines, write_orc
from ..sinks.bucketed import BucketedStore
from ..sinks.snapshot import SnapshotStore
from ..sources.envelope import log_shape
from ..sources.files import read_delimited, read_json, read_lines, read_orc, strip_header
from . import fixtures as fx
from .q_changes import MERGE_ORDERS_SQL, order_changes
from .q_retention import PURGE_AS_OF, PURGE_DAYS, PURGE_DEFAULT_SQL, audited_orders
from .registry import register


@register("json_lines_scan", "select * from events")
def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines written by Spark and scanned with the declared schema (no inference)."""
    ev = fx.table(spark, sf_dir, "events")
    path = scratch_path(spark, "events_json")
    write_json_lines(ev, path)
    return read_json(spark, path, ev.schema)


@register("csv_roundtrip", "select * from nation")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = fx.table(spark, sf_dir, "nation")
    path = scratch_path(spark, "nation_csv")
    write_csv(n, path)
    return read_delimited(spark, path, n.schema)


# Customers as employee-like records: a M/d/yyyy hire date and a manager written as the text NULL.
@register("csv_typed_scan", """
select c_custkey as empno, c_name as ename, c_mktsegment as designation,
       case when c_acctbal < 0 then null else c_nationkey end as manager,
       date '1980-01-01' + cast(floor(c_acctbal) as integer) as hire_date
from customer""")
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fx.table(spark, sf_dir, "customer")
    path = scratch_path(spark, "emp_csv")
    rows = c.select(
        F.col("c_custkey").alias("empno"), F.col("c_name").alias("ename"), F.col("c_mktsegment").alias("designation"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("manager"),
        F.date_format(F.date_add(F.lit("1980-01-01").cast("date"), F.floor("c_acctbal").cast("int")), "M/d/yyyy").alias("hire_date"),
    )
    rows.write.option("header", True).option("nullValue", "NULL").csv(path)
    schema = "empno bigint, ename string, designation string, manager int, hire_date date"
    return read_delimited(spark, path, schema, null_value="NULL", date_format="M/d/yyyy")


@register("orc_roundtrip", PURGE_DEFAULT_SQL.split(" where ")[0])
def orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = audited_orders(spark, sf_dir)
    path = scratch_path(spark, "orders_orc")
    write_orc(t, path)
    return read_orc(spark, path, t.schema)


@register("text_strip_header", """
select cast(c_custkey as varchar) || ',' || c_name || ',' || cast(c_nationkey as varchar) || ',' || c_mktsegment as value
from customer""")
def text_strip_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines with a header line in every part file; every line equal to the first line
    (the header) is dropped."""
    c = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = scratch_path(spark, "cust_text")
    write_csv(c, path)
    return strip_header(read_lines(spark, path))


@register("snapshot_swap", MERGE_ORDERS_SQL)
def snapshot_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the target (batch 0), merge the change log on the current snapshot and publish
    to the other slot (batch 1); read the current snapshot."""
    _, spec, target, changes, routed = order_changes(spark, sf_dir)
    store = SnapshotStore(spark, scratch_path(spark, "orders_store"), spec.table_schema)
    store.publish(target, 0)
    store.publish(apply_changes(store.read(), changes, spec, as_of=fx.AS_OF, **log_shape(routed, spec)), 1)
    return store.read()


@register("snapshot_purge", PURGE_DEFAULT_SQL)
def snapshot_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purge the current snapshot into the other slot (the slot read is never overwritten)."""
    t = audited_orders(spark, sf_dir)
    spec = fx.orders_spec(fx.table(spark, sf_dir, "orders"))
    store = SnapshotStore(spark, scratch_path(spark, "orders_purge"), spec.table_schema)
    store.publish(t, 0)
    store.publish(purge_expired(store.read(), PURGE_DAYS, PURGE_AS_OF), 1)
    return store.read()


@register("merge_bucketed", MERGE_ORDERS_SQL)
def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log merged into a bucketed store: only touched key buckets are read and
    rewritten (here the log touches every bucket); the table is read back whole."""
    _, spec, target, changes, routed = order_changes(spark, sf_dir)
    store = BucketedStore(spark, scratch_path(spark, "orders_bucketed"), spec, buckets=16)
    store.publish(target, 0)
    store.apply(changes, spec, fx.AS_OF, 1, **log_shape(routed, spec))
    return store.read()
