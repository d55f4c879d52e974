"""Streaming queries: envelope files drained by a file stream into snapshot-store targets.

The events are written as envelope text files in four time slices. Batches hold any number of files in any order: the
target keeps each row's log position and tombstones, so a late event changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import live_rows
from ..schema import TargetSpec
from ..sinks.bucketed import BucketedStore
from ..sinks.health import HealthLog
from ..sinks.snapshot import SnapshotStore
from ..session import scratch_path
from ..sources.streams import stream_changes
from ..streaming.sync import SyncJob, SyncTarget, read_metrics, read_quarantine, run_stream, targets_from_plan
from . import fixtures as fx
from .control import MASTER_SCHEMA, HEALTH_SCHEMA, TABLE_MASTER_SCHEMA, build_plan, plan_rows
from .q_changes import CHAIN_SQL, MERGE_ORDERS_SQL, chain_steps, mixed_topic
from .registry import register

SLICE_BOUNDS = ("2024-01-08", "2024-01-15", "2024-01-22")


def write_event_slices(spark: SparkSession, sf_dir: str, path: str, spec: TargetSpec, slices: tuple[int, ...] | None = None) -> None:
    ev = fx.table(spark, sf_dir, "events")
    bounds = [None, *SLICE_BOUNDS, None]
    ts_type = ev.schema["ts"].dataType
    for i in range(len(bounds) - 1):
        if slices is not None and i not in slices:
            continue
        cond = F.lit(True)
        if bounds[i]:
            cond = cond & (F.col("ts") >= F.lit(bounds[i]).cast(ts_type))
        if bounds[i + 1]:
            cond = cond & (F.col("ts") < F.lit(bounds[i + 1]).cast(ts_type))
        fx.event_envelopes(ev.where(cond), spec).write.mode("append").text(path)


def _user_job(spark: SparkSession, sf_dir: str, root: str, buckets: int = 0) -> tuple[SyncJob, TargetSpec]:
    spec = fx.users_spec(fx.table(spark, sf_dir, "events"), ordered=True)
    if buckets:
        store = BucketedStore(spark, f"{root}/target", spec, buckets)
    else:
        store = SnapshotStore(spark, f"{root}/target", spec.table_schema)
    job = SyncJob([SyncTarget(spec, store)], f"{root}/quarantine", f"{root}/metrics", as_of=fx.AS_OF)
    return job, spec


_STREAM_SQL = """
select user_id, event_type, value, ts as last_ts, event_id as last_event_id,
       timestamp '2024-01-01 00:00:00' as INSERT_DATE, timestamp '2024-01-01 00:00:00' as UPDATE_DATE
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
where rn = 1 and event_type <> 'error'"""


@register("stream_apply", _STREAM_SQL)
def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope files -> file stream (a few files per trigger) -> foreachBatch merge into a
    snapshot store; drained with an availableNow trigger."""
    root = scratch_path(spark, "stream_apply")
    job, spec = _user_job(spark, sf_dir, root)
    write_event_slices(spark, sf_dir, f"{root}/in", spec)
    src = stream_changes(spark, "files", path=f"{root}/in", max_per_trigger=spark.sparkContext.defaultParallelism)
    q = run_stream(src, job, f"{root}/ckpt", {"availableNow": True})
    q.awaitTermination()
    return live_rows(job.targets[0].store.read(), spec)


@register("stream_apply_bucketed", _STREAM_SQL)
def stream_apply_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream into a bucketed store: each batch rewrites only the buckets it touches."""
    root = scratch_path(spark, "stream_bucketed")
    job, spec = _user_job(spark, sf_dir, root, buckets=16)
    write_event_slices(spark, sf_dir, f"{root}/in", spec)
    src = stream_changes(spark, "files", path=f"{root}/in", max_per_trigger=spark.sparkContext.defaultParallelism)
    run_stream(src, job, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return live_rows(job.targets[0].store.read(), spec)


@register("stream_restart", _STREAM_SQL)
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain half the slices, stop; more files arrive; restart from the same checkpoint and
    drain the rest. The checkpoint resumes where the first run stopped."""
    root = scratch_path(spark, "stream_restart")
    job, spec = _user_job(spark, sf_dir, root)
    for part in ((0, 1), (2, 3)):
        write_event_slices(spark, sf_dir, f"{root}/in", spec, part)
        src = stream_changes(spark, "files", path=f"{root}/in", max_per_trigger=spark.sparkContext.defaultParallelism)
        run_stream(src, job, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return live_rows(job.targets[0].store.read(), spec)


def _mixed_job(spark: SparkSession, sf_dir: str, root: str) -> SyncJob:
    orders = fx.table(spark, sf_dir, "orders")
    cust = fx.table(spark, sf_dir, "customer")
    ospec = fx.orders_spec(orders)
    cspec = TargetSpec("TPCH.CUSTOMER", cust.schema, ("c_custkey",))
    ostore = SnapshotStore(spark, f"{root}/orders", ospec.table_schema)
    ostore.publish(fx.order_target(orders), -1)
    cstore = SnapshotStore(spark, f"{root}/customer", cspec.table_schema)
    return SyncJob([SyncTarget(ospec, ostore), SyncTarget(cspec, cstore)], f"{root}/quarantine", f"{root}/metrics",
                   as_of=fx.AS_OF, parallelism=2)


def _run_mixed(spark: SparkSession, sf_dir: str) -> tuple[SyncJob, str]:
    root = scratch_path(spark, "mixed")
    job = _mixed_job(spark, sf_dir, root)
    mixed_topic(spark, sf_dir, with_broken=True).write.text(f"{root}/in")
    run_stream(stream_changes(spark, "files", path=f"{root}/in"), job, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return job, root


@register("quarantine_bad_rows", """
select 'malformed' as reason, count(*) as n from customer where c_acctbal < 0""")
def quarantine_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes cut short land in the quarantine table with their reason; the rest sync."""
    job, _ = _run_mixed(spark, sf_dir)
    q = read_quarantine(spark, job.quarantine_path)
    return q.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("batch_metrics", """
select 'TPCH.ORDERS' as target, case o_orderpriority when '1-URGENT' then 'I' when '2-HIGH' then 'U' else 'D' end as op,
       count(*) as n
from orders where o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by all
union all
select 'TPCH.CUSTOMER' as target, 'I' as op, count(*) as n from customer where c_acctbal >= 0""")
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics rows of the mixed-topic run, summed per (target, op)."""
    job, _ = _run_mixed(spark, sf_dir)
    m = read_metrics(spark, job.metrics_path)
    return m.groupBy("target", "op").agg(F.sum("n").alias("n"))


@register("sync_table", """
with tgt as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
                    o_orderdate as INSERT_DATE, o_orderdate as UPDATE_DATE
             from orders where o_orderpriority <> '1-URGENT'
               and not (o_orderdate + interval 9000 day <= timestamp '2024-01-01 00:00:00')),
chg as (select o_orderkey,
               case o_orderpriority when '1-URGENT' then 'I' when '2-HIGH' then 'U' else 'D' end as op,
               o_custkey, 'X' as o_orderstatus, o_totalprice + 100 as o_totalprice, o_orderdate, o_orderpriority
        from orders where o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM'))
select coalesce(t.o_orderkey, g.o_orderkey) as o_orderkey,
       case when g.op is null then t.o_custkey else g.o_custkey end as o_custkey,
       case when g.op is null then t.o_orderstatus else g.o_orderstatus end as o_orderstatus,
       case when g.op is null then t.o_totalprice else g.o_totalprice end as o_totalprice,
       case when g.op is null then t.o_orderdate else g.o_orderdate end as o_orderdate,
       case when g.op is null then t.o_orderpriority else g.o_orderpriority end as o_orderpriority,
       case when g.op is null then t.INSERT_DATE else coalesce(t.INSERT_DATE, timestamp '2024-01-01 00:00:00') end as INSERT_DATE,
       case when g.op is null then t.UPDATE_DATE else timestamp '2024-01-01 00:00:00' end as UPDATE_DATE
from tgt t full outer join chg g on t.o_orderkey = g.o_orderkey
where g.op is null or g.op <> 'D'""")
def sync_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sync step with purging on: purge the current table (9000 days, UPDATE_DATE), then
    merge the batch, publish; the batch goes through the foreachBatch function."""
    orders = fx.table(spark, sf_dir, "orders")
    spec = fx.orders_spec(orders)
    root = scratch_path(spark, "sync_table")
    store = SnapshotStore(spark, f"{root}/orders", spec.table_schema)
    store.publish(fx.order_target(orders), -1)
    job = SyncJob([SyncTarget(spec, store, purge_days=9000)], f"{root}/quarantine", f"{root}/metrics", as_of=fx.AS_OF)
    fx.order_envelopes(orders, spec).write.text(f"{root}/in")
    run_stream(stream_changes(spark, "files", path=f"{root}/in"), job, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return store.read()



@register("stream_key_chain", CHAIN_SQL)
def stream_key_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of moves through the stream into a bucketed store."""
    root = scratch_path(spark, "stream_chain")
    orders = fx.table(spark, sf_dir, "orders")
    spec = fx.orders_spec(orders)
    store = BucketedStore(spark, f"{root}/orders", spec, buckets=8)
    store.publish(fx.order_target(orders), 0)
    job = SyncJob([SyncTarget(spec, store)], f"{root}/quarantine", f"{root}/metrics", as_of=fx.AS_OF)
    fx.order_steps(orders, spec, chain_steps()).write.text(f"{root}/in")
    run_stream(stream_changes(spark, "files", path=f"{root}/in"), job, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return store.read()


@register("plan_sync", MERGE_ORDERS_SQL)
def plan_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan-driven sync: control rows for three op types of one table make one target on a bucketed store,
    merged once per batch in log order; the topic also holds a table that the plan does not want."""
    root = scratch_path(spark, "plan_sync")
    orders = fx.table(spark, sf_dir, "orders")
    spec = fx.orders_spec(orders)
    master = spark.createDataFrame([
        (n, "JOB", n, "hdfs://namenode/warehouse", "table", fx.ORDERS_TABLE, None, "o_orderkey", "/a", "/b", op, "N", None, None, "orders")
        for n, op in ((1, "I"), (2, "U"), (3, "D"))
    ], MASTER_SCHEMA)
    plan = build_plan(master, spark.createDataFrame([], TABLE_MASTER_SCHEMA), spark.createDataFrame([], HEALTH_SCHEMA), "JOB", fx.AS_OF)
    store = BucketedStore(spark, f"{root}/orders", spec, buckets=8)
    store.publish(fx.order_target(orders), 0)
    job = SyncJob(targets_from_plan(plan_rows(plan), lambda _: spec, lambda *_: store), f"{root}/quarantine", f"{root}/metrics", as_of=fx.AS_OF)
    mixed_topic(spark, sf_dir).write.text(f"{root}/in")
    src = stream_changes(spark, "files", path=f"{root}/in")
    run_stream(src, job, f"{root}/ckpt", {"availableNow": True}, plan=plan, topics=["orders"]).awaitTermination()
    return store.read()


@register("health_log", """
select target, count(*) as n from (
  select 'C' || c_custkey as target from customer where c_custkey % 30 < 15
  union all select unnest(['TPCH.ORDERS', 'TPCH.CUSTOMER'])) group by target""")
def health_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed job with a health log: each batch purges the ids that are due (here made of the customers, last run
    up to 29 days ago) and adds a row per target."""
    root = scratch_path(spark, "health")
    job = _mixed_job(spark, sf_dir, root)
    cust = fx.table(spark, sf_dir, "customer")
    ago = F.make_dt_interval(F.pmod("c_custkey", F.lit(30)).cast("int"))
    rows = cust.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("target"), (F.lit(fx.AS_OF).cast("timestamp") - ago).alias("last_run"))
    job.health = HealthLog(spark, f"{root}/health")
    job.health.publish(rows)
    mixed_topic(spark, sf_dir).write.text(f"{root}/in")
    run_stream(stream_changes(spark, "files", path=f"{root}/in"), job, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return job.health.read().groupBy("target").agg(F.count(F.lit(1)).alias("n"))
