"""Batches and tables that grow: what is broadcast, held by one task or written by one is bounded, with the same rows."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from tablesync.operators.changes import net_changes
from tablesync.plans import documents as docs
from tablesync.plans import fixtures as fx
from tablesync.plans import q_changes, q_nested
from tablesync.schema import TargetSpec
from tablesync.session import scratch_path
from tablesync.sinks.bucketed import BucketedStore
from tablesync.sinks.merge_on_read import MergeOnReadStore
from tablesync.sinks.snapshot import SnapshotStore
from tablesync.sources.envelope import DOC, change_rows, parse_envelope, split_bad
from tablesync.sources import streams
from tablesync.streaming import sync

from conftest import SF_SMALL

LINE = '{"table": "T.KV", "op_type": "%s", "op_ts": "2024-01-01 00:00:00.000000", "pos": "%020d", "before": %s, "after": %s}'
IMAGE = '{"k": %d, "v": "%s"}'


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _event(n, op, old, new):
    return (LINE % (op, n, "null" if old is None else IMAGE % old, "null" if new is None else IMAGE % new),)


@pytest.mark.parametrize("moves, rebirths", [(False, True), (True, False), (True, True)])
def test_no_look_at_a_batch_is_broadcast_by_an_estimate(spark, moves, rebirths):
    """The files are small, so Spark takes the images made of their texts for small too."""
    target = spark.createDataFrame([(k, "old", "2020-01-01 00:00:00", "2020-01-01 00:00:00") for k in range(4)], "k long, v string, i string, u string")
    target = target.selectExpr("k", "v", "cast(i as timestamp_ntz) as INSERT_DATE", "cast(u as timestamp_ntz) as UPDATE_DATE")
    spec = TargetSpec("T.KV", target.select("k", "v").schema, ("k",), target.schema["INSERT_DATE"].dataType)
    events = [_event(1, "D", (0, "old"), None), _event(2, "I", None, (0, "new"))] if rebirths else []
    events += [_event(3, "U", (1, "old"), (11, "a")), _event(4, "U", (11, "a"), (12, "b"))] if moves else []
    path = scratch_path(spark, "t_estimate")
    spark.createDataFrame(events, "value string").write.text(path)
    changes, _ = change_rows(split_bad(parse_envelope(spark.read.text(path)))[0], spec)
    net = net_changes(target, changes, ["k"], moves, rebirths)
    assert "Broadcast" not in _plan(net)
    got = {r["k"]: (r["_op"], r["_fresh"], str(r["_carry"])) for r in net.collect()}
    want = {0: ("I", True, "None")} if rebirths else {}
    want |= {1: ("D", False, "None"), 11: ("D", False, "None"), 12: ("U", False, "2020-01-01 00:00:00")} if moves else {}
    assert {k: (v[0], v[1], v[2] if v[0] != "D" else "None") for k, v in got.items()} == want


def test_partitions_of_a_topic_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(fx, "TOPIC_ROWS", 100)
    topic = fx.as_topic(spark.range(2500))
    assert topic.rdd.getNumPartitions() >= 25 and max(topic.rdd.glom().map(len).collect()) <= 120
    assert sorted(r["id"] for r in topic.collect()) == list(range(2500))


def test_customers_of_a_topic_are_bounded_like_orders(spark, monkeypatch):
    monkeypatch.setattr(fx, "TOPIC_ROWS", 10)
    root = scratch_path(spark, "t_topic")
    orders, cust = fx.table(spark, SF_SMALL, "orders"), fx.table(spark, SF_SMALL, "customer")
    orders.limit(20).write.parquet(f"{root}/orders.parquet")
    cust.limit(1).crossJoin(spark.range(150)).withColumn("c_custkey", F.col("id")).drop("id").coalesce(1).write.parquet(f"{root}/customer.parquet")
    parts = q_changes.mixed_topic(spark, root).rdd.glom().map(len).collect()
    assert max(parts) <= 20 and sum(parts) >= 150


def test_a_file_of_one_array_is_bounded(spark, monkeypatch):
    """Twelve documents, with a document a file: several tasks write them, where one did."""
    monkeypatch.setattr(docs, "FILE_DOCS", 1)
    tables, path = scratch_path(spark, "t_array_lines"), scratch_path(spark, "t_array_files")
    monkeypatch.setattr(q_nested, "scratch_path", lambda *_: path)
    lines = fx.table(spark, SF_SMALL, "lineitem")
    lines.withColumn("l_orderkey", lines["l_orderkey"] * 8).write.parquet(f"{tables}/lineitem.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = q_nested.json_array_scan(spark, tables)
        assert got.exceptAll(q_nested.nested_flatten_long(spark, tables)).count() == 0 and got.count() == lines.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([n for n in os.listdir(path.removeprefix("file://")) if n.startswith("part-")]) > 1


def test_a_batch_is_kept_without_the_whole_documents(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(sync, "split_bad", lambda parsed: kept.append(parsed.columns) or split_bad(parsed))
    target = spark.createDataFrame([], "k long, v string")
    spec = TargetSpec("T.KV", target.schema, ("k",))
    root = scratch_path(spark, "t_kept")
    store = SnapshotStore(spark, f"{root}/t", spec.table_schema)
    job = sync.SyncJob([sync.SyncTarget(spec, store)], f"{root}/q", f"{root}/m", as_of=fx.AS_OF)
    sync.make_batch_fn(job)(spark.createDataFrame([_event(1, "I", None, (1, "a"))], "value string"), 0)
    assert [(r["k"], r["v"]) for r in store.read().collect()] == [(1, "a")]
    assert DOC not in kept[0]


def test_a_batch_takes_no_heap_while_it_is_kept(spark, monkeypatch):
    """The parsed batch and the changes of a target are kept on disk: a large batch filled the executors' heap."""
    levels = []
    spec = TargetSpec("T.KV", spark.createDataFrame([], "k long, v string").schema, ("k",), spark.sql("select timestamp_ntz'2024-01-01' as t").schema["t"].dataType)
    store = MergeOnReadStore(spark, scratch_path(spark, "t_heap"), spec, 2)
    apply = store.apply
    monkeypatch.setattr(sync, "split_bad", lambda parsed: levels.append(parsed.storageLevel) or split_bad(parsed))
    monkeypatch.setattr(store, "apply", lambda changes, *args, **kw: levels.append(changes.storageLevel) or apply(changes, *args, **kw))
    root = scratch_path(spark, "t_heap_job")
    job = sync.SyncJob([sync.SyncTarget(spec, store)], f"{root}/q", f"{root}/m", as_of=fx.AS_OF)
    sync.make_batch_fn(job)(spark.createDataFrame([_event(1, "I", None, (1, "a")), _event(2, "I", None, (2, "b"))], "value string"), 0)
    assert sorted((r["k"], r["v"]) for r in store.read().collect()) == [(1, "a"), (2, "b")]
    assert len(levels) == 2 and all(x.useDisk and not x.useMemory for x in levels)


def test_the_files_of_a_batch_are_read_in_small_splits(spark, monkeypatch):
    path, given = scratch_path(spark, "t_splits"), spark.conf.get(streams.SPLIT_CONF)
    spark.range(500).selectExpr("cast(id as string) as value").coalesce(1).write.text(path)
    monkeypatch.setattr(streams, "SPLIT_BYTES", 200)
    parts, rows = [], []
    source = streams.stream_changes(spark, "files", path=path)
    q = source.writeStream.foreachBatch(lambda df, _: parts.append(df.rdd.getNumPartitions()) or rows.extend(r["value"] for r in df.collect()))
    q.option("checkpointLocation", scratch_path(spark, "t_splits_ckpt")).trigger(availableNow=True).start().awaitTermination()
    assert parts[0] >= 5 and sorted(map(int, rows)) == list(range(500)) and spark.conf.get(streams.SPLIT_CONF) == given


def test_a_large_bucket_is_written_by_several_tasks(spark):
    spec = TargetSpec("T.KV", spark.createDataFrame([], "k long, v string").schema, ("k",), spark.sql("select timestamp_ntz'2024-01-01' as t").schema["t"].dataType)
    rows = spark.range(60_000).repartition(12).selectExpr("id as k", "sha2(string(id), 256) as v", "timestamp_ntz'2024-01-01' as INSERT_DATE", "timestamp_ntz'2024-01-01' as UPDATE_DATE")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "200k")
    try:
        for kind in (BucketedStore, MergeOnReadStore):
            store = kind(spark, scratch_path(spark, "t_bucket"), spec, 1)
            store.publish(rows, 0)
            assert store.read().select(F.input_file_name()).distinct().count() > 1
            assert sorted(store.read().collect()) == sorted(rows.collect())
    finally:
        spark.conf.unset(name)
