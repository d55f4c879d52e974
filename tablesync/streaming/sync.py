"""Structured Streaming table sync: ``readStream`` -> ``foreachBatch`` -> per-target merge.

Per micro-batch: skip an empty batch; persist the parsed batch once; set malformed and unwanted envelopes
aside in the quarantine table; then for each target: route by its tag -> shape changes
(bad images and NULL keys to quarantine) -> net change per key in log order, of the op types the plan names ->
merge (after a purge of the rows read, if enabled) -> publish to the target's store, whose log is the batch ledger.
A target without rows in the batch is left alone. Quarantine and metrics rows are written before the ledger row, each
(stream, batch, target) to a folder of its own by overwrite, so a replay neither loses nor doubles
them, and a target already published is skipped. Infrastructure errors are not swallowed: the query fails and, on
restart, the checkpoint replays the batch.

State across batches is the target table itself; there is no keyed stream state.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..operators.changes import has_rebirths, of_ops, utc_column
from ..operators.retention import Purge
from ..schema import TargetSpec
from ..sinks.bucketed import BucketedStore
from ..sinks.health import HEALTH_DDL, HealthLog  # noqa: F401
from ..sinks.jdbc import JdbcStore
from ..sinks.merge_on_read import MergeOnReadStore
from ..sinks.snapshot import SnapshotStore
from ..sinks.versions import CommitLog
from ..functions.convert import control_type
from ..functions.text import error_text
from ..sources.envelope import DOC, RAW, REASON, change_rows, parse_envelope, route, split_bad, unrouted

METRICS_DDL = "batch_id long, target string, op string, n long, started_at timestamp, ms long"
QUARANTINE_DDL = "batch_id long, target string, reason string, raw string"
ENVELOPES = "_envelopes"  # stands for a target where a row belongs to none
# A batch is kept on the executors' disks: in memory, Spark looks at what a partition takes only every 16 blocks of 10,000 rows,
# and a large batch fills the heap.
KEPT = StorageLevel.DISK_ONLY
ERROR_DDL = "batch_id long, failed_at timestamp, error string"


@dataclass
class SyncTarget:
    """One target of a sync job (one plan entry, or all op types of a table at once)."""

    spec: TargetSpec
    store: SnapshotStore | BucketedStore | MergeOnReadStore | JdbcStore
    tag_col: str = "table"
    op_order: tuple[str, ...] | None = None  # the op types to apply (all if None); the log orders them
    purge_days: int | None = None
    purge_column: str | None = None
    purge_keys: tuple[str, ...] | None = None
    full_purge_hours: float = 24.0  # how often all expired rows go; in between, those that a batch rewrites anyway
    insert_mode: str = "replace"
    strategy: str = "auto"


@dataclass
class SyncJob:
    targets: list[SyncTarget]
    quarantine_path: str
    metrics_path: str
    as_of: object = None  # None: current time per batch
    error_path: str | None = None  # one row per failed batch (then the query fails)
    parallelism: int = 1  # targets merged at once within a batch (FAIR pools; set spark.scheduler.mode=FAIR)
    health: HealthLog | None = None  # one row per target and batch, replayed ones included; ids due are purged
    health_days: int = 15
    health_hours: float = 24.0  # how often the health log is compacted and purged
    commits: CommitLog | None = None  # the targets of a batch become current together (their stores must be merge-on-read)
    stream_id: str = ""  # set by run_stream from the checkpoint
    last_batch: dict = field(default_factory=dict)
    # Control refresh: every ``refresh_hours`` the targets are rebuilt by ``refresh()``
    # (typically: re-read the control tables, build_plan, targets_from_plan).
    refresh: Callable[[], list[SyncTarget]] | None = None
    refresh_hours: float = 4.0
    _refreshed_at: float | None = None
    _purged_at: dict = field(default_factory=dict)
    _health_at: float | None = None

    def maybe_refresh(self, now: float) -> bool:
        if self.refresh is None:
            return False
        if self._refreshed_at is None:
            self._refreshed_at = now
            return False
        if now - self._refreshed_at < self.refresh_hours * 3600:
            return False
        self.targets = self.refresh()
        self._refreshed_at = now
        return True


def targets_from_plan(rows: list[dict], spec_for: Callable[[str], TargetSpec],
                      store_for: Callable[[dict, TargetSpec], object]) -> list[SyncTarget]:
    """Plan rows (``plans.control.plan_rows``: one per table and op type, in SEQUENCE order)
    -> one target per table applying its op types, in the order of the log.

    Every row of a table counts: it is purged if any row says PURGING = 'Y', and every table_master column type (COLUMNNAME,
    DATATYPE) declares that image column with the control type, so the image parse casts it (a value that does not
    convert sends the row to quarantine). Rows of a table that contradict each other raise: two purges with other days or columns, two
    types of a column, two keys, tags, or sinks."""
    by_table: dict[str, list[dict]] = {}
    for r in rows:
        by_table.setdefault(r["table_name"], []).append(r)
    out = []
    for name, rs in by_table.items():
        spec, first = spec_for(name), rs[0]

        def one(what: str, values: list):
            if len({repr(v) for v in values}) > 1:
                raise ValueError(f"plan rows of {name} differ in {what}: {values}")
            return values[0] if values else None

        one("key", [list(r["keys"]) for r in rs])
        for what in ("tag_column", "sink_kind", "db_table"):
            one(what, [r.get(what) for r in rs])
        if list(first["keys"]) != spec.key_cols:
            raise ValueError(f"plan key {first['keys']} differs from the key of {name}: {spec.key_cols}")
        types: dict[str, list[str]] = {}
        for r in rs:
            if r.get("cast_column") and r.get("cast_type"):
                types.setdefault(r["cast_column"], []).append(r["cast_type"])
        for column, kinds in types.items():
            spec = spec.with_type(column, control_type(one(f"type of {column}", kinds), spec.audit_type))
        purge = one("purge", [(r["purge_days"], r["purge_column"]) for r in rs if r["purge"] and r["purge_days"] is not None])
        days, column = purge or (None, None)
        out.append(SyncTarget(spec, store_for(first, spec), tag_col=first["tag_column"], op_order=tuple(r["op_type"] for r in rs), purge_days=days, purge_column=column))
    return out


def sync_table(batch: DataFrame, t: SyncTarget, batch_id: int, as_of=None, stream: str = "", full_purge: bool = False,
               before_publish: Callable[[list, DataFrame], None] | None = None, **store_kw) -> list:
    """Apply one batch to one target and publish it (``store_kw``: more for the store); returns the counts per op type.

    ``before_publish`` gets (counts, bad rows) once they are known. With no row for the target nothing is
    published, unless a full purge is due.
    """
    changes, bad = change_rows(route(batch, t.spec.name, t.tag_col), t.spec)
    if t.op_order:
        changes = of_ops(changes, list(t.op_order))
    changes = changes.persist(KEPT)  # images are parsed once for the counts, the touched buckets and the merge
    try:
        stats = changes.groupBy("_op").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.col("_prev").isNotNull()).alias("moves")
        ).collect()  # at most one row per op type
        counts = [(r["_op"], r["n"]) for r in stats]
        if before_publish:
            before_publish(counts, bad)
        pre = None
        if t.purge_days is not None:
            pre = Purge(t.purge_days, as_of, t.purge_column, t.purge_keys)
        if counts or (pre and full_purge):
            t.store.apply(changes, t.spec, as_of, batch_id, pre=pre, full_pre=full_purge, stream=stream, insert_mode=t.insert_mode, strategy=t.strategy,
                          key_changes=any(r["moves"] for r in stats), rebirths=has_rebirths(changes, t.spec.key_cols), **store_kw)
        return counts
    finally:
        changes.unpersist()


def _own_folder(path: str, stream: str, batch_id: int, target: str) -> str:
    return f"{path}/p_stream={stream or 'none'}/p_batch={batch_id}/p_target={target}"


def make_batch_fn(job: SyncJob):
    """The ``foreachBatch`` function of a sync job."""
    if job.commits and not all(hasattr(t.store, "finish") for t in job.targets):
        raise ValueError("a group commit needs stores that can prepare a version")

    def run(raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        started = time.time()
        tags = tuple(dict.fromkeys(t.tag_col for t in job.targets)) or ("table",)
        # Persist the parsed batch first: the partitions the emptiness test reads stay cached,
        # so no part of the source is read twice. The whole document is not kept beside its fields and images.
        parsed = parse_envelope(raw, tags=tags).drop(DOC).persist(KEPT)
        try:
            if parsed.isEmpty():
                return
            if job.maybe_refresh(started) and any(t.tag_col not in parsed.columns for t in job.targets):
                parsed.unpersist()
                parsed = parse_envelope(raw, tags=tuple(dict.fromkeys(t.tag_col for t in job.targets))).drop(DOC).persist(KEPT)
            good, bad_env = split_bad(parsed)

            def quarantine(rows: DataFrame, target: str | None) -> None:
                rows = rows.select(F.lit(batch_id).cast("long").alias("batch_id"), F.lit(target).cast("string").alias("target"),
                                   F.col(REASON).alias("reason"), F.col(RAW).alias("raw"))
                if not rows.isEmpty():  # reads the persisted batch; stops at the first bad row
                    rows.write.mode("overwrite").parquet(_own_folder(job.quarantine_path, job.stream_id, batch_id, target or ENVELOPES))

            quarantine(bad_env.select(RAW, REASON).unionByName(unrouted(good, [(t.tag_col, t.spec.name) for t in job.targets])), None)

            def one(t: SyncTarget):
                if job.parallelism > 1:  # each target's jobs share the cluster fairly
                    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"sync-{t.spec.name}")
                t0 = time.time()
                as_of = job.as_of if job.as_of is not None else utc_column(started, t.spec.audit_type)
                # file stores with a log remember their last full purge over restarts
                logged = hasattr(t.store, "last_purge")
                purged = t.store.last_purge() if logged else job._purged_at.get(t.spec.name, float("-inf"))
                full = t.purge_days is not None and started - purged >= t.full_purge_hours * 3600

                def before_publish(counts: list, bad: DataFrame) -> None:
                    quarantine(bad, t.spec.name)
                    ms = int((time.time() - t0) * 1000)
                    rows = spark.createDataFrame([(batch_id, t.spec.name, op, n, ms) for op, n in counts], "batch_id long, target string, op string, n long, ms long")
                    rows.select("batch_id", "target", "op", "n", F.timestamp_seconds(F.lit(started)).alias("started_at"), "ms") \
                        .coalesce(1).write.mode("overwrite").parquet(_own_folder(job.metrics_path, job.stream_id, batch_id, t.spec.name))

                sync_table(good, t, batch_id, as_of, job.stream_id, full, before_publish, **({"at": started} if logged else {}), **({"commit": token} if token else {}))
                if full:
                    job._purged_at[t.spec.name] = started

            token = job.commits.token(job.stream_id, batch_id) if job.commits else None
            todo = [t for t in job.targets if not t.store.has_batch(batch_id, job.stream_id)]
            if job.parallelism > 1 and len(todo) > 1:
                # Targets are distinct tables (one per table, see targets_from_plan): independent.
                with ThreadPoolExecutor(max_workers=job.parallelism) as pool:
                    list(pool.map(one, todo))
            else:
                for t in todo:
                    one(t)
            if job.commits and todo:
                job.commits.commit(token, batch_id=batch_id, targets=[t.spec.name for t in todo])
                for t in todo:
                    t.store.finish()
            if job.health is not None:  # a replayed batch too: its rows may be what the failure prevented
                instant = F.lit(str(job.as_of)).cast("timestamp") if job.as_of is not None else F.timestamp_seconds(F.lit(started))
                job.health.record([t.spec.name for t in job.targets], instant, batch_id, job.stream_id)
                if job._health_at is None or started - job._health_at >= job.health_hours * 3600:
                    job.health.compact(instant, job.health_days)
                    job._health_at = started
            job.last_batch = {"batch_id": batch_id, "targets": len(job.targets)}
        except Exception as e:
            # Log the failure, then fail the query: the checkpoint replays the batch on restart
            # and the ledger skips targets already published.
            if job.error_path:
                text = f"{type(e).__name__}: {e}"
                err = spark.createDataFrame([(batch_id, text)], "batch_id long, error string")
                err.select("batch_id", F.current_timestamp().alias("failed_at"), error_text(F.col("error")).alias("error")) \
                    .coalesce(1).write.mode("append").parquet(job.error_path)
            raise
        finally:
            parsed.unpersist()

    return run


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint folder, made on first use and kept in it."""
    path = f"{checkpoint.rstrip('/')}/sync_stream"
    try:
        return spark.read.schema("id string").json(path).first()["id"]
    except (AnalysisException, TypeError):
        stream = uuid.uuid4().hex
        spark.createDataFrame([(stream,)], "id string").coalesce(1).write.mode("overwrite").json(path)
        return stream


def run_stream(source: DataFrame, job: SyncJob, checkpoint: str, trigger: dict | None = None, query_name: str | None = None,
               plan: DataFrame | None = None, topics: list[str] | None = None):
    """Start the sync query. ``trigger``: e.g. {"processingTime": "60 seconds"} (the default)
    or {"availableNow": True} to drain what is there and stop. With ``plan`` and ``topics``, the plan's topics are
    checked first."""
    if plan is not None and topics is not None:
        from ..plans.control import validate_topics

        validate_topics(plan, topics)
    job.stream_id = stream_identity(source.sparkSession, checkpoint)
    trigger = trigger or {"processingTime": "60 seconds"}
    w = source.writeStream.foreachBatch(make_batch_fn(job)).option("checkpointLocation", checkpoint).trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def _read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    try:
        names = [c.split()[0] for c in ddl.split(", ")]
        return spark.read.schema(ddl).parquet(path).select(*names)
    except AnalysisException:  # nothing written yet
        return spark.createDataFrame([], ddl)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, METRICS_DDL)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, QUARANTINE_DDL)


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, ERROR_DDL)
