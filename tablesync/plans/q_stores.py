"""Queries over the merge-on-read store: batches of changes folded on read, compaction, late moves, purges by
statistics, group commits, changed column types, and stores picked by the control plan."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import apply_changes
from ..operators.retention import Purge
from ..schema import TargetSpec
from ..session import scratch_path
from ..sinks.bucketed import BucketedStore
from ..sinks.merge_on_read import MergeOnReadStore
from ..sinks.routing import store_router
from ..sinks.versions import CommitLog
from ..sources.envelope import change_rows, log_shape, parse_envelope, route, split_bad
from ..sources.streams import stream_changes
from ..streaming.sync import SyncJob, SyncTarget, make_batch_fn, run_stream, targets_from_plan
from . import fixtures as fx
from .control import HEALTH_SCHEMA, MASTER_SCHEMA, TABLE_MASTER_SCHEMA, build_plan, plan_rows
from .q_changes import _ALL, _MERGE_SELECT, _TGT_SQL, _chg_sql, CHAIN_SQL, MERGE_ORDERS_SQL, chain_steps, mixed_topic, order_changes
from .q_stream import _STREAM_SQL, write_event_slices
from .registry import register


def _orders_store(spark: SparkSession, root: str, orders: DataFrame, **options) -> MergeOnReadStore:
    store = MergeOnReadStore(spark, f"{root}/orders", fx.orders_spec(orders), buckets=16, **options)
    store.publish(fx.order_target(orders), 0, "seed")
    return store


def _three_batches(changes: DataFrame) -> list[DataFrame]:
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    return [changes.where(part == n) for n in range(3)]


def _merged_in_batches(spark: SparkSession, sf_dir: str) -> MergeOnReadStore:
    orders, spec, _, changes, _ = order_changes(spark, sf_dir)
    store = _orders_store(spark, scratch_path(spark, "merge_on_read"), orders)
    changes = changes.persist()
    for n, batch in enumerate(_three_batches(changes)):
        store.apply(batch, spec, fx.AS_OF, n, stream="orders", key_changes=False, rebirths=False)
    changes.unpersist()
    return store


@register("merge_on_read", MERGE_ORDERS_SQL)
def merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log in three batches; each writes its changed keys only, the reader folds them over the base."""
    return _merged_in_batches(spark, sf_dir).read()


@register("merge_on_read_compacted", MERGE_ORDERS_SQL)
def merge_on_read_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after compaction, opened anew: the rows are the base's."""
    store = _merged_in_batches(spark, sf_dir)
    store.compact()
    return MergeOnReadStore(spark, store.root, store.spec, store.buckets).read()


@register("late_moves", CHAIN_SQL)
def late_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three moves of each row, the last one delivered first: INSERT_DATE still follows the chain."""
    orders = fx.table(spark, sf_dir, "orders")
    store = _orders_store(spark, scratch_path(spark, "late_moves"), orders, order="log")
    spec, steps = store.spec, chain_steps()
    routed = route(split_bad(parse_envelope(fx.order_steps(orders, spec, steps)))[0], fx.ORDERS_TABLE)
    changes = change_rows(routed, spec)[0].persist()
    step = F.pmod(F.col("_seq.pos").cast("long"), F.lit(10))
    for n in reversed(range(len(steps))):
        store.apply(changes.where(step == n), spec, fx.AS_OF, len(steps) - n, stream="orders", key_changes=True)
    changes.unpersist()
    return store.read()


@register("stream_log_order", _STREAM_SQL)
def stream_log_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' slices arrive newest first, each a batch of its own; the store applies them by their position."""
    root = scratch_path(spark, "stream_log_order")
    spec = fx.users_spec(fx.table(spark, sf_dir, "events"))
    store = MergeOnReadStore(spark, f"{root}/users", spec, buckets=16, order="log", lateness=90 * 86400.0)
    job = SyncJob([SyncTarget(spec, store)], f"{root}/quarantine", f"{root}/metrics", as_of=fx.AS_OF)
    for n in reversed(range(4)):
        write_event_slices(spark, sf_dir, f"{root}/in", spec, (n,))
        run_stream(stream_changes(spark, "files", path=f"{root}/in"), job, f"{root}/ckpt", {"availableNow": True}).awaitTermination()
    return store.read()


@register("apply_update_partial_before", f"with {_TGT_SQL}, {_chg_sql(chr(39) + '2-HIGH' + chr(39))} {_MERGE_SELECT}")
def apply_update_partial_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates whose before image holds the changed columns only, without the key: they are no moves."""
    orders = fx.table(spark, sf_dir, "orders")
    spec = fx.orders_spec(orders)
    topic = fx.order_envelopes(orders, spec, priorities=(fx.PRIO_UPDATE,))
    topic = topic.select(F.regexp_replace("value", r'("before":\{)"o_orderkey":-?\d+,"o_custkey":-?\d+,', "$1").alias("value"))
    routed = route(split_bad(parse_envelope(topic))[0], fx.ORDERS_TABLE)
    changes, _ = change_rows(routed, spec)
    return apply_changes(fx.order_target(orders), changes, spec, None, fx.AS_OF, **log_shape(routed, spec))


_PURGED_SQL = f"""
with {_TGT_SQL}
select * from tgt where not (o_orderdate + interval 9000 day <= timestamp '2024-01-01 00:00:00')"""


@register("purge_by_statistics", _PURGED_SQL)
def purge_by_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scheduled purge by order date: the log's least dates tell which buckets can hold an expired row."""
    orders = fx.table(spark, sf_dir, "orders")
    store = _orders_store(spark, scratch_path(spark, "purge_statistics"), orders, date_column="o_orderdate")
    store.purge(Purge(9000, fx.AS_OF, "o_orderdate"), at=0.0)
    return store.read()


class _FailsOnce:
    """A store whose first ``apply`` fails, to stop a batch between two tables."""

    def __init__(self, store: MergeOnReadStore):
        self._store, self.failed = store, False

    def __getattr__(self, name: str):
        return getattr(self._store, name)

    def apply(self, *args, **kw):
        if not self.failed:
            self.failed = True
            raise OSError("lost")
        return self._store.apply(*args, **kw)


@register("group_commit", """
with t as (select count(*) as n from orders where o_orderpriority <> '1-URGENT'),
merged as (select count(*) as n from orders where o_orderpriority <> '3-MEDIUM'),
c as (select count(*) as n from customer)
select 'failed' as phase, 'TPCH.ORDERS' as target, n from t
union all select 'failed', 'TPCH.CUSTOMER', 0::bigint from t
union all select 'replayed', 'TPCH.ORDERS', n from merged
union all select 'replayed', 'TPCH.CUSTOMER', n from c""")
def group_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch for two tables fails after the first one is prepared: readers see neither; its replay makes both current."""
    root = scratch_path(spark, "group_commit")
    orders, cust = fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "customer")
    cspec = TargetSpec("TPCH.CUSTOMER", cust.schema, ("c_custkey",))
    first = _orders_store(spark, root, orders)
    second = MergeOnReadStore(spark, f"{root}/customer", cspec, buckets=16)
    commits = CommitLog(spark, f"{root}/_commits")
    job = SyncJob([SyncTarget(first.spec, first), SyncTarget(cspec, _FailsOnce(second))], f"{root}/quarantine", f"{root}/metrics", as_of=fx.AS_OF, commits=commits)
    batch, run = mixed_topic(spark, sf_dir), make_batch_fn(job)

    def counts(phase: str) -> DataFrame:
        seen = commits.tokens()  # both tables as of one instant
        tables = [MergeOnReadStore(spark, s.root, s.spec, s.buckets).refresh(seen).read().select(F.lit(s.spec.name).alias("target")) for s in (first, second)]
        found = tables[0].unionByName(tables[1]).groupBy("target").agg(F.count(F.lit(1)).alias("n"))
        names = spark.createDataFrame([(s.spec.name,) for s in (first, second)], "target string")
        return names.join(found, "target", "left").select(F.lit(phase).alias("phase"), "target", F.coalesce("n", F.lit(0)).alias("n"))

    try:
        run(batch, 0)
    except OSError:
        pass
    failed = counts("failed")
    run(batch, 0)
    return failed.unionByName(counts("replayed"))


@register("schema_change", f"""
with m as ({MERGE_ORDERS_SQL})
select * replace (o_custkey::varchar as o_custkey) from m""")
def schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared type of a column changes between two batches: rows of both, and of the base, read as the new one."""
    orders, spec, _, changes, _ = order_changes(spark, sf_dir)
    store = _orders_store(spark, scratch_path(spark, "schema_change"), orders)
    batches = _three_batches(changes)
    store.apply(batches[0], spec, fx.AS_OF, 0, stream="orders", key_changes=False, rebirths=False)
    spec = spec.with_type("o_custkey", T.StringType())
    store = MergeOnReadStore(spark, store.root, spec, store.buckets)
    routed = route(split_bad(parse_envelope(fx.order_envelopes(orders, spec)))[0], fx.ORDERS_TABLE)
    retyped = _three_batches(change_rows(routed, spec)[0])
    for n in (1, 2):
        store.apply(retyped[n], spec, fx.AS_OF, n, stream="orders", key_changes=False, rebirths=False)
    return store.read()


def _plan_row(n: int, table: str, key: str, op: str, db_table: str | None, purging: str, days: int | None, column: str | None) -> tuple:
    return (n, "JOB", n, "hdfs://namenode/warehouse", "table", table, db_table, key, "/a", "/b", op, purging, None if days is None else Decimal(days), column, "orders")


@register("plan_routes", f"""
with m as (select * from ({MERGE_ORDERS_SQL}) where o_orderdate + interval 9000 day > timestamp '2024-01-01 00:00:00'),
r as (select 'TPCH.ORDERS' as target, 'files' as sink, count(*) as n, sum(o_custkey)::bigint as total from m
union all select 'TPCH.CUSTOMER', 'db', count(*), sum(c_custkey)::bigint from customer)
select * from r""")
def plan_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan with both kinds of sinks: files go to a merge-on-read store, database tables to what the caller gives (here a
    bucketed store, as no database runs); the third plan row of the orders turns purging on, for all of them."""
    root = scratch_path(spark, "plan_routes")
    orders, cust = fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "customer")
    specs = {fx.ORDERS_TABLE: fx.orders_spec(orders), "TPCH.CUSTOMER": TargetSpec("TPCH.CUSTOMER", cust.schema, ("c_custkey",))}
    ops = [(1, "I", "N", None, None), (2, "U", "N", None, None), (3, "D", "Y", 9000, "o_orderdate")]
    master = [_plan_row(n, fx.ORDERS_TABLE, "o_orderkey", op, None, purging, days, column) for n, op, purging, days, column in ops]
    master.append(_plan_row(4, "TPCH.CUSTOMER", "c_custkey", "I", "crm.customer", "N", None, None))
    plan = build_plan(spark.createDataFrame(master, MASTER_SCHEMA), spark.createDataFrame([], TABLE_MASTER_SCHEMA), spark.createDataFrame([], HEALTH_SCHEMA), "JOB", fx.AS_OF)
    router = store_router(spark, db=lambda row, spec: BucketedStore(spark, f"{root}/db/{row['db_table']}", spec, 16), root=root, buckets=16, date_column="o_orderdate")
    job = SyncJob(targets_from_plan(plan_rows(plan), specs.__getitem__, router), f"{root}/quarantine", f"{root}/metrics", as_of=fx.AS_OF)
    stores = {t.spec.name: t.store for t in job.targets}
    stores[fx.ORDERS_TABLE].publish(fx.order_target(orders), 0, "seed")
    mixed_topic(spark, sf_dir).write.text(f"{root}/in")
    run_stream(stream_changes(spark, "files", path=f"{root}/in"), job, f"{root}/ckpt", {"availableNow": True}, plan=plan, topics=["orders"]).awaitTermination()

    def summary(name: str, key: str) -> DataFrame:
        sink = "files" if isinstance(stores[name], MergeOnReadStore) else "db"
        return stores[name].read().agg(F.lit(name).alias("target"), F.lit(sink).alias("sink"), F.count(F.lit(1)).alias("n"), F.sum(_long(key)).alias("total"))

    return summary(fx.ORDERS_TABLE, "o_custkey").unionByName(summary("TPCH.CUSTOMER", "c_custkey"))


def _long(name: str) -> Column:
    return F.col(name).cast("long")
