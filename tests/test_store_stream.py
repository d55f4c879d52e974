"""Snapshot store slots and ledger, control plan checks, and the stream batch function."""

import json

import pytest
from pyspark.sql import functions as F

from tablesync.plans.control import build_plan, plan_rows, validate_topics
from tablesync.plans.q_control import control_tables
from tablesync.schema import TargetSpec
from tablesync.session import scratch_path
from tablesync.sinks.snapshot import SnapshotStore
from tablesync.streaming.sync import SyncJob, SyncTarget, make_batch_fn, read_metrics, read_quarantine

from conftest import SF_SMALL


def test_store_alternates_slots_and_survives_a_torn_publish(spark):
    schema = spark.createDataFrame([], "k long, v string").schema
    store = SnapshotStore(spark, scratch_path(spark, "t_store"), schema)
    assert store.read().count() == 0 and store.head() is None
    store.publish(spark.createDataFrame([(1, "a")], schema), 0)
    store.publish(store.read().union(spark.createDataFrame([(2, "b")], schema)), 1)
    assert store.head()["slot"] == "b" and store.read().count() == 2
    # A crash after writing the idle slot but before the log row: readers still see version 2.
    spark.createDataFrame([(9, "torn")], schema).write.mode("overwrite").orc(store.slot_path("a"))
    assert sorted(r["k"] for r in store.read().collect()) == [1, 2]
    assert store.has_batch(1) and not store.has_batch(2)


def test_plan_order_sinks_and_topics(spark):
    master, tm, health = control_tables(spark, SF_SMALL)
    job = master.select("JOBNAME").first()["JOBNAME"]
    plan = build_plan(master, tm, health, job, "1999-01-01 00:00:00")
    rows = plan_rows(plan)
    assert [r["SEQUENCE"] for r in rows] == sorted(r["SEQUENCE"] for r in rows)
    for r in rows:
        assert (r["sink_kind"] == "db") == (r["db_table"] is not None)
        assert r["keys"] == ["l_orderkey", "l_linenumber"]
        assert (r["cast_type"] is None) == (r["op_type"] == "D")
    validate_topics(plan, ["orders", "lineitem"])
    with pytest.raises(ValueError):
        validate_topics(plan, ["orders"])


def _env(op, k, v, pos):
    d = {"table": "T.KV", "op_type": op, "op_ts": "2024-01-01 00:00:00.000000", "pos": f"{pos:020d}"}
    if op == "D":
        d["before"] = {"k": k}
    else:
        d["after"] = {"k": k, "v": v}
    return json.dumps(d)


def test_batch_fn_ledger_quarantine_metrics(spark):
    spec = TargetSpec.of("T.KV", spark.createDataFrame([], "k long, v string").schema, "k")
    root = scratch_path(spark, "t_batch")
    store = SnapshotStore(spark, f"{root}/kv", spec.table_schema)
    job = SyncJob([SyncTarget(spec, store)], f"{root}/q", f"{root}/m", as_of="2024-01-01 00:00:00")
    fn = make_batch_fn(job)
    b0 = spark.createDataFrame([(_env("I", 1, "a", 1),), (_env("I", 2, "b", 2),), ("{broken",)], "value string")
    fn(b0, 0)
    b1 = spark.createDataFrame([(_env("U", 1, "a2", 3),), (_env("D", 2, None, 4),)], "value string")
    fn(b1, 1)
    fn(b1, 1)  # replay of batch 1: skipped by the ledger
    fn(spark.createDataFrame([], "value string"), 2)  # empty batch: nothing happens
    assert sorted((r["k"], r["v"]) for r in store.read().collect()) == [(1, "a2")]
    assert store.history().count() == 2
    assert [r["reason"] for r in read_quarantine(spark, job.quarantine_path).collect()] == ["malformed"]
    m = read_metrics(spark, job.metrics_path).groupBy("op").agg(F.sum("n").alias("n"))
    assert sorted((r["op"], r["n"]) for r in m.collect()) == [("D", 1), ("I", 2), ("U", 1)]


def test_bucketed_store_rewrites_only_touched_buckets(spark):
    from tablesync.sinks.bucketed import BucketedStore
    from tablesync.sources.envelope import change_rows, parse_envelope, split_bad

    spec = TargetSpec.of("T.KV", spark.createDataFrame([], "k long, v string").schema, "k")
    store = BucketedStore(spark, scratch_path(spark, "t_bucketed"), spec, buckets=8)
    base = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v"),
                                   F.lit("2020-01-01").cast("timestamp_ntz").alias("INSERT_DATE"),
                                   F.lit("2020-01-01").cast("timestamp_ntz").alias("UPDATE_DATE"))
    store.publish(base, 0)
    before = dict(store._paths)
    raw = spark.createDataFrame([(_env("U", 5, "b", 1),), (_env("D", 7, None, 2),), (_env("I", 500, "n", 3),)], "value string")
    ch, _ = change_rows(split_bad(parse_envelope(raw))[0], spec)
    touched = store.touched(ch)
    assert 1 <= len(touched) <= 3
    store.apply(ch, spec, "2024-01-01 00:00:00", 1)
    changed = {b for b in before if before[b] != store._paths[b]}
    assert changed == set(touched)
    got = {r["k"]: r["v"] for r in store.read().collect()}
    assert len(got) == 200 and got[5] == "b" and 7 not in got and got[500] == "n"
    assert store.read().columns == spec.table_schema.fieldNames()


def test_targets_from_plan_and_refresh(spark):
    from tablesync.streaming.sync import targets_from_plan

    master, tm, health = control_tables(spark, SF_SMALL)
    job_name = master.select("JOBNAME").first()["JOBNAME"]
    rows = plan_rows(build_plan(master, tm, health, job_name, "1999-01-01 00:00:00"))
    schema = spark.createDataFrame([], "l_orderkey long, l_linenumber int, l_shipdate string").schema
    made = []

    def spec_for(name):
        return TargetSpec.of(name, schema, "l_orderkey, l_linenumber")

    def store_for(row, spec):
        made.append(row["table_name"])
        return SnapshotStore(spark, scratch_path(spark, "t_plan"), spec.table_schema)

    targets = targets_from_plan(rows, spec_for, store_for)
    assert len(targets) == len({r["table_name"] for r in rows}) == len(made)
    assert all(t.op_order == ("I", "U", "D") for t in targets)
    # table_master says l_shipdate is a Timestamp: the image column is declared with that type
    assert all(t.spec.data_schema["l_shipdate"].dataType.simpleString() == "timestamp_ntz" for t in targets)
    for t in targets:
        row = next(r for r in rows if r["table_name"] == t.spec.name)
        assert (t.purge_days is not None) == row["purge"]

    job = SyncJob(targets, "q", "m", refresh=lambda: targets[:1], refresh_hours=4)
    assert not job.maybe_refresh(0.0) and not job.maybe_refresh(3600.0)
    assert job.maybe_refresh(5 * 3600.0) and len(job.targets) == 1


def test_failed_batch_writes_error_row_and_raises(spark):
    from tablesync.functions.text import ERROR_TEXT_MAX
    from tablesync.streaming.sync import read_errors

    spec = TargetSpec.of("T.KV", spark.createDataFrame([], "k long, v string").schema, "k")
    root = scratch_path(spark, "t_fail")
    store = SnapshotStore(spark, f"{root}/kv", spec.table_schema, fmt="no_such_format")
    job = SyncJob([SyncTarget(spec, store)], f"{root}/q", f"{root}/m", as_of="2024-01-01 00:00:00", error_path=f"{root}/err")
    with pytest.raises(Exception):
        make_batch_fn(job)(spark.createDataFrame([(_env("I", 1, "a", 1),)], "value string"), 7)
    errs = read_errors(spark, job.error_path).collect()
    assert [r["batch_id"] for r in errs] == [7] and 0 < len(errs[0]["error"]) <= ERROR_TEXT_MAX
    assert not store.has_batch(7)


def test_parallel_targets_publish_the_same_tables(spark):
    from tablesync.plans.q_changes import mixed_topic
    from tablesync.plans.q_stream import _mixed_job

    raw = mixed_topic(spark, SF_SMALL, with_broken=True)
    out = []
    for par in (1, 2):
        job = _mixed_job(spark, SF_SMALL, scratch_path(spark, f"t_par{par}"))
        job.parallelism = par
        make_batch_fn(job)(raw, 0)
        out.append([sorted(tuple(r) for r in t.store.read().collect()) for t in job.targets])
    assert out[0] == out[1] and all(len(t) > 0 for t in out[0])
