"""Streams, stores and side tables under restarts, replays, late files and odd settings."""

import contextlib
import glob
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.changes import live_rows, utc_column
from tablesync.operators.retention import purge_expired
from tablesync.plans import fixtures as fx
from tablesync.plans.q_stream import write_event_slices
from tablesync.schema import TargetSpec
from tablesync.session import scratch_path
from tablesync.sinks.bucketed import BucketedStore
from tablesync.sinks.snapshot import SnapshotStore
from tablesync.sources.envelope import change_rows, parse_envelope, split_bad
from tablesync.sources.streams import stream_changes
from tablesync.streaming import sync
from tablesync.streaming.sync import SyncJob, SyncTarget, make_batch_fn, read_metrics, read_quarantine, run_stream

from conftest import SF_SMALL
from test_store_stream import _env

DAY = "2024-01-01 00:00:00"


def kv_spec(spark):
    return TargetSpec.of("T.KV", spark.createDataFrame([], "k long, v string").schema, "k")


def lines(spark, *texts):
    return spark.createDataFrame([(x,) for x in texts], "value string")


def test_a_new_checkpoint_is_a_new_stream(spark):
    """A store that has seen batch 0 of one stream still takes batch 0 of another."""
    spec, root = kv_spec(spark), scratch_path(spark, "t_streams")
    for n, cls in enumerate((SnapshotStore, BucketedStore)):
        for run in (1, 2):
            store = cls(spark, f"{root}/kv{n}", *([spec.table_schema] if cls is SnapshotStore else [spec, 4]))
            lines(spark, _env("I", run, f"v{run}", run)).coalesce(1).write.text(f"{root}/in{n}{run}")
            job = SyncJob([SyncTarget(spec, store)], f"{root}/q", f"{root}/m", as_of=DAY)
            run_stream(stream_changes(spark, "files", path=f"{root}/in{n}{run}"), job, f"{root}/ckpt{n}{run}", {"availableNow": True}).awaitTermination()
        assert sorted(r["k"] for r in store.read().collect()) == [1, 2]


def test_files_per_trigger_do_not_matter(spark):
    got = []
    for files in (1, 7):
        root = scratch_path(spark, "t_slices")
        spec = fx.users_spec(fx.table(spark, SF_SMALL, "events"), ordered=True)
        store = BucketedStore(spark, f"{root}/t", spec, 4)
        job = SyncJob([SyncTarget(spec, store)], f"{root}/q", f"{root}/m", as_of=DAY)
        for part in (3, 0, 2, 1):  # late slices first
            fx_dir = f"{root}/in"
            write_event_slices(spark, SF_SMALL, f"{root}/raw{part}", spec, (part,))
            spark.read.text(f"{root}/raw{part}").coalesce(2).write.mode("append").text(fx_dir)
        run_stream(stream_changes(spark, "files", path=f"{root}/in", max_per_trigger=files), job, f"{root}/c", {"availableNow": True}).awaitTermination()
        got.append(sorted(map(tuple, live_rows(store.read(), spec).drop("INSERT_DATE").collect())))
    assert got[0] == got[1]


@pytest.mark.parametrize("step", ["quarantine", "metrics", "publish"])
def test_replay_after_a_failure_between_steps(spark, step, monkeypatch):
    """Whatever step fails once, the replay leaves every row exactly once."""
    spec, root = kv_spec(spark), scratch_path(spark, "t_replay")
    other = TargetSpec("T.OTHER", spec.data_schema, spec.keys)
    stores = [SnapshotStore(spark, f"{root}/{n}", s.table_schema) for n, s in (("kv", spec), ("other", other))]
    job = SyncJob([SyncTarget(s, st) for s, st in zip((spec, other), stores)], f"{root}/q", f"{root}/m", as_of=DAY)
    fn = make_batch_fn(job)
    batch = lines(spark, _env("I", 1, "a", 1), _env("I", "x", "bad", 2), "{broken", _env("I", 5, "o", 3).replace("T.KV", "T.OTHER"), _env("I", 6, "n", 4).replace("T.KV", "T.NONE"))
    real, calls = sync._own_folder, {"n": 0}

    def failing(path, stream, batch_id, target):
        if (step == "quarantine" and path.endswith("/q") and target == "T.KV") or (step == "metrics" and path.endswith("/m") and target == "T.OTHER"):
            calls["n"] += 1
            if calls["n"] == 1:
                raise OSError("lost")
        return real(path, stream, batch_id, target)

    monkeypatch.setattr(sync, "_own_folder", failing)
    if step == "publish":
        real_publish = stores[1].publish

        def publish(*a, **k):
            calls["n"] += 1
            if calls["n"] == 1:
                raise OSError("lost")
            return real_publish(*a, **k)

        stores[1].publish = publish
    with pytest.raises(OSError):
        fn(batch, 0)
    fn(batch, 0)
    fn(batch, 0)
    assert [(r["k"], r["v"]) for s in stores for r in s.read().collect()] == [(1, "a"), (5, "o")]
    assert sorted(r["reason"] for r in read_quarantine(spark, job.quarantine_path).collect()) == ["bad_image", "malformed", "no_target"]
    assert sorted((r["target"], r["n"]) for r in read_metrics(spark, job.metrics_path).collect()) == [("T.KV", 1), ("T.OTHER", 1)]
    assert stores[0].history().count() == 1


def test_tables_without_rows_get_no_version(spark):
    spec, root = kv_spec(spark), scratch_path(spark, "t_untouched")
    other = TargetSpec("T.OTHER", spec.data_schema, spec.keys)
    stores = [BucketedStore(spark, f"{root}/{n}", s, 4) for n, s in (("kv", spec), ("other", other))]
    job = SyncJob([SyncTarget(s, st) for s, st in zip((spec, other), stores)], f"{root}/q", f"{root}/m", as_of=DAY)
    make_batch_fn(job)(lines(spark, _env("I", 1, "a", 1)), 0)
    assert [s._version for s in stores] == [1, 0]


def filled(spark, root, spec, **kw):
    store = BucketedStore(spark, root, spec, 8, **kw)
    day = F.lit("2020-01-01").cast("timestamp_ntz")
    store.publish(spark.range(400).select(F.col("id").alias("k"), F.lit("a").alias("v"), day.alias("INSERT_DATE"), day.alias("UPDATE_DATE")).repartition(6), 0)
    return store


def kv_changes(spark, spec, *texts):
    return change_rows(split_bad(parse_envelope(lines(spark, *texts)))[0], spec)[0]


def test_bucket_files_count_and_vacuum(spark):
    spec, root = kv_spec(spark), scratch_path(spark, "t_buckets")
    store = filled(spark, root, spec, files_per_bucket=2)
    local = root.removeprefix("file:")
    assert all(1 <= len(glob.glob(f"{local}/v=1/_bucket={b}/part-*")) <= 2 for b in range(8))
    with pytest.raises(ValueError):
        BucketedStore(spark, root, spec, 16).read()
    store.apply(kv_changes(spark, spec, _env("U", 5, "b", 1)), spec, DAY, 1)
    assert store.vacuum(older_than_hours=24) == 0 and store.vacuum(older_than_hours=-1) == 1
    assert BucketedStore(spark, root, spec, 8).read().count() == 400


def test_purge_leaves_untouched_buckets_alone(spark):
    spec = kv_spec(spark)
    store = filled(spark, scratch_path(spark, "t_purge"), spec)
    before = dict(store._paths)
    purge = lambda df: purge_expired(df, 30, DAY)
    store.apply(kv_changes(spark, spec, _env("U", 5, "b", 1)), spec, DAY, 1, pre=purge)
    changed = {b for b in before if before[b] != store._paths[b]}
    assert len(changed) == 1 and store.read().where("v = 'b'").count() == 1 and store.read().count() < 400
    store.apply(kv_changes(spark, spec, _env("U", 5, "c", 2)), spec, DAY, 2, pre=purge, full_pre=True)
    assert [r["v"] for r in store.read().collect()] == ["c"]


def test_purge_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        purge_expired(orders, 365, "2000-01-01 00:00:00", "o_orderdate").explain("formatted")
    assert "GreaterThan(o_orderdate" in out.getvalue()


def test_audit_clock_outside_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(utc_column(1_700_000_000, T.TimestampType()).cast("long").alias("t"), utc_column(1_700_000_000, T.TimestampNTZType()).cast("string").alias("n")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["t"] == 1_700_000_000 and row["n"] == "2023-11-14 22:13:20"


def test_bad_time_goes_to_quarantine(spark):
    _, bad = split_bad(parse_envelope(lines(spark, _env("I", 1, "a", 1).replace("2024-01-01", "yesterday"))))
    assert [r["_reason"] for r in bad.collect()] == ["bad_op_ts"]
