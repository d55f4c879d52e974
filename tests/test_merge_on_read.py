"""The merge-on-read store: batches against a sequential answer, log order, purges, crashes, leases, schemas."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.changes import live_rows
from tablesync.operators.retention import Purge
from tablesync.schema import INSERT_DATE, TargetSpec
from tablesync.session import scratch_path
from tablesync.sinks.bucketed import BucketedStore
from tablesync.sinks.health import HealthLog
from tablesync.sinks.merge_on_read import MergeOnReadStore
from tablesync.sinks.routing import store_router
from tablesync.sinks.snapshot import PER_FOLDER, SnapshotStore
from tablesync.sinks.versions import CommitLog, VersionLog
from tablesync.streaming import sync
from tablesync.streaming.sync import SyncJob, SyncTarget, make_batch_fn, targets_from_plan

from test_changes import AS_OF, OLD, SPEC, changes, rows
from test_merge_paths import START, lines_of, random_log, sequential, start
from test_store_stream import _env
from test_sync_faults import DAY, kv_changes, kv_spec, lines


def store_of(spark, name, spec=SPEC, buckets=4, **options):
    return MergeOnReadStore(spark, scratch_path(spark, name), spec, buckets, **options)


def again(store, spec=None, **options):
    return MergeOnReadStore(store.spark, store.root, spec or store.spec, store.buckets, order=store.order, lateness=store.lateness, date_column=store.date_column, **options)


@pytest.mark.parametrize("mode", ["replace", "keep"])
@pytest.mark.parametrize("size", [4, 9])
def test_batches_equal_the_sequence(spark, mode, size):
    log = random_log(random.Random(size), 18, 5)
    store = store_of(spark, "m_seq")
    store.publish(start(spark), 0)
    for n, at in enumerate(range(0, len(log), size), 1):
        ch, _, _ = changes(spark, lines_of(log[at : at + size], at))
        store.apply(ch, SPEC, AS_OF, n, insert_mode=mode)
    assert rows(store.read()) == sequential(START, log, mode=mode)
    store.compact()
    assert not store.state()["deltas"] and rows(again(store).read()) == sequential(START, log, mode=mode)


def test_a_large_set_of_changes_is_joined_whole(spark, monkeypatch):
    monkeypatch.setattr("tablesync.sinks.merge_on_read.DEFAULT_BROADCAST_ROWS", 2)
    log = random_log(random.Random(3), 12, 6)
    store = store_of(spark, "m_large")
    store.publish(start(spark), 0)
    for n in (0, 6):
        store.apply(changes(spark, lines_of(log[n : n + 6], n))[0], SPEC, AS_OF, n + 1)
    assert rows(store.read()) == sequential(START, log)


def test_tombstones_keep_late_events_out(spark):
    spec = TargetSpec(SPEC.name, SPEC.data_schema, SPEC.keys, seq_column="_pos", tombstone="_dead")
    store = store_of(spark, "m_dead", spec)
    store.publish(start(spark).withColumn("_pos", F.lit(None).cast("string")).withColumn("_dead", F.lit(False)), 0)
    log = [x if x[0] != "M" else ("U", *x[1:]) for x in random_log(random.Random(8), 12, 4)]
    for n, (part, at) in enumerate(((log[8:], 8), (log[:4], 0), (log[4:8], 4)), 1):
        store.apply(changes(spark, lines_of(part, at))[0], spec, AS_OF, n)
    want = {r[0]: r[2] for r in sequential(START, log)}
    assert {r["k"]: r["v"] for r in live_rows(store.read(), spec).collect()} == want


@pytest.mark.parametrize("seed", [4, 12])
def test_log_order_does_not_depend_on_the_order_of_batches(spark, seed):
    """All orders of the batches of a log with moves, deletes and returns, dates included."""
    log = random_log(random.Random(seed), 12, 4)
    parts = [changes(spark, lines_of(log[at : at + 4], at))[0].persist() for at in (0, 4, 8)]
    got = []
    for order in itertools.permutations(range(3)):
        store = store_of(spark, "m_perm", order="log")
        store.publish(start(spark), 0)
        for n, k in enumerate(order, 1):
            store.apply(parts[k], SPEC, AS_OF, n)
        got.append(rows(store.read()))
    assert all(x == sequential(START, log) for x in got)


def test_a_late_move_hands_its_date_on(spark):
    """Move 0 -> 7, update of 7; delete of 1 and its return: in order and the other way round."""
    log = [("M", 0, 7, "moved"), ("U", 7, 0, "updated"), ("D", 1, 0, ""), ("I", 1, 0, "back")]
    for order in ((0, 1, 2, 3), (3, 2, 1, 0)):
        store = store_of(spark, "m_late", order="log")
        store.publish(start(spark), 0)
        for n, k in enumerate(order, 1):
            store.apply(changes(spark, lines_of(log[k : k + 1], k))[0], SPEC, AS_OF, n)
        assert rows(store.read()) == sequential(START, log)
        found = {r["k"]: str(r[INSERT_DATE]) for r in store.read().collect()}
        assert found[7] == OLD and found[1] == AS_OF


def test_old_events_are_folded_and_later_ones_set_aside(spark):
    hour = lambda line, h: line.replace("2024-01-01 00:00:00", f"2024-01-01 {h:02d}:00:00")
    log = [("U", 0, 0, "a"), ("M", 1, 5, "b"), ("U", 5, 0, "c"), ("D", 2, 0, "")]
    text = [hour(x, h) for h, x in zip((1, 2, 9, 10), lines_of(log))]
    store = store_of(spark, "m_fold", order="log", lateness=3 * 3600.0)
    store.publish(start(spark), 0)
    for n, x in enumerate(text, 1):
        store.apply(changes(spark, [x])[0], SPEC, AS_OF, n)
    before = rows(store.read())
    assert before == sequential(START, log) and len(store.state()["deltas"]) == 4
    store.compact()
    assert rows(again(store).read()) == before and len(again(store).state()["deltas"]) == 2
    store.apply(changes(spark, [hour(lines_of([("U", 0, 0, "too late")])[0], 3), hour(lines_of([("U", 0, 0, "in time")], 8)[0], 8)])[0], SPEC, AS_OF, 9)
    assert store.late().count() == 1 and {r[0]: r[2] for r in rows(store.read())}[0] == "in time"
    store.compact()
    assert {r[0]: r[2] for r in rows(again(store).read())} == {0: "in time", 5: "c"}


def filled(spark, name, n=400, **options):
    spec = kv_spec(spark)
    store = store_of(spark, name, spec, 8, **options)
    day = F.expr("timestampadd(DAY, cast(id as int), timestamp_ntz'2020-01-01 00:00:00')")
    store.publish(spark.range(n).select(F.col("id").alias("k"), F.lit("a").alias("v"), day.alias("INSERT_DATE"), day.alias("UPDATE_DATE")), 0)
    return store, spec


def test_a_batch_writes_its_changes_only(spark):
    store, spec = filled(spark, "m_files")
    base = {b: x["path"] for b, x in store.state()["base"].items()}
    done = store.apply(kv_changes(spark, spec, _env("U", 5, "b", 1), _env("D", 7, None, 2), _env("I", 500, "n", 3), _env("U", 5, "c", 4)), spec, DAY, 1)
    delta = store.state()["deltas"][0]
    assert done["rows"] == 3 and spark.read.parquet(delta["path"]).count() == 3
    assert len([n for n in store.log.files.names("../delta/v=2") if n.startswith("part-")]) <= 3
    assert {b: x["path"] for b, x in store.state()["base"].items()} == base
    got = {r["k"]: r["v"] for r in again(store).read().collect()}
    assert len(got) == 400 and got[5] == "c" and got[500] == "n" and 7 not in got


def test_compaction_after_some_batches_and_of_some_buckets(spark):
    store, spec = filled(spark, "m_compact", compact_after=3)
    for n in range(1, 4):
        store.apply(kv_changes(spark, spec, _env("U", n, f"v{n}", n)), spec, DAY, n)
    assert not store.state()["deltas"]
    store.apply(kv_changes(spark, spec, *[_env("U", k, "w", 10 + k) for k in range(40)]), spec, DAY, 4)
    touched = sorted(map(int, store.state()["deltas"][0]["least"]))
    store.compact(touched[:3])
    assert store.state()["deltas"] and store.read().where("v = 'w'").count() == 40 == again(store).read().where("v = 'w'").count()
    assert store.read(touched[:1]).where("v = 'w'").count() > 0
    store.compact()
    assert not store.state()["deltas"] and store.read().where("v = 'w'").count() == 40


def test_a_crash_before_the_log_entry_changes_nothing(spark, monkeypatch):
    store, spec = filled(spark, "m_crash")
    batch = kv_changes(spark, spec, _env("U", 5, "b", 1))
    real, lost = VersionLog.append, []

    def append(self, entry):
        if not lost:
            lost.append(entry)
            raise OSError("lost")
        return real(self, entry)

    monkeypatch.setattr(VersionLog, "append", append)
    with pytest.raises(OSError):
        store.apply(batch, spec, DAY, 1)
    assert not again(store).has_batch(1) and again(store).read().where("v = 'b'").count() == 0
    reopened = again(store)
    reopened.apply(batch, spec, DAY, 1)
    assert again(store).has_batch(1) and not again(store).has_batch(2) and again(store).read().where("v = 'b'").count() == 1


def test_purge_rewrites_only_buckets_with_expired_rows(spark):
    for store, spec in (filled(spark, "m_purge"), bucketed(spark)):
        paths = lambda: {int(b): x["path"] for b, x in store.state()["base"].items()} if isinstance(store, MergeOnReadStore) else dict(store._paths)  # noqa: E731, B023
        before = paths()
        purge = Purge(30, "2020-02-03 00:00:00")  # ids 0 to 3 are expired
        held = {r["b"] for r in store.read().where("k <= 3").select(store.bucket_of().alias("b")).collect()}
        assert set(store.expirable(purge)) == held and len(held) < 8
        if isinstance(store, MergeOnReadStore):
            store.purge(purge, at=123.0)
        else:
            store.apply(kv_changes(spark, spec, _env("U", 5, "b", 1)).where("k < 0"), spec, DAY, 1, pre=purge, full_pre=True, at=123.0)
        assert {b for b in before if paths()[b] != before[b]} == held
        assert store.read().count() == 396 and store.read().agg(F.min("k")).first()[0] == 4
        assert not store.expirable(purge)
        fresh = again(store) if isinstance(store, MergeOnReadStore) else BucketedStore(spark, store.root, spec, 8)
        assert fresh.last_purge() == 123.0 and fresh.read().count() == 396


def bucketed(spark):
    spec = kv_spec(spark)
    store = BucketedStore(spark, scratch_path(spark, "m_bucketed"), spec, 8)
    day = F.expr("timestampadd(DAY, cast(id as int), timestamp_ntz'2020-01-01 00:00:00')")
    store.publish(spark.range(400).select(F.col("id").alias("k"), F.lit("a").alias("v"), day.alias("INSERT_DATE"), day.alias("UPDATE_DATE")), 0)
    return store, spec


def test_a_restart_does_not_purge_again(spark):
    store, spec = filled(spark, "m_restart")
    root = scratch_path(spark, "m_restart_job")
    versions = []
    for n in range(2):  # two processes
        store = again(store)
        job = SyncJob([SyncTarget(spec, store, purge_days=36500)], f"{root}/q", f"{root}/m")
        make_batch_fn(job)(lines(spark, _env("U", 5, f"v{n}", n)), n + 1)
        versions.append(store.state()["version"])
    assert versions == [3, 4]  # published, then batch and purge stamp, then a batch


def test_expired_rows_go_before_their_change(spark):
    """As in a store that purges the rows it reads: the returning row is a new one."""
    store, spec = filled(spark, "m_expired")
    store.apply(kv_changes(spark, spec, _env("U", 0, "b", 1), _env("U", 300, "c", 2)), spec, DAY, 1, pre=Purge(365, "2021-06-01 00:00:00"))
    got = {r["k"]: str(r[INSERT_DATE])[:10] for r in store.read().where("v <> 'a'").collect()}
    assert got == {0: DAY[:10], 300: "2020-10-27"}


def test_tables_of_a_batch_change_together(spark):
    spec, root = kv_spec(spark), scratch_path(spark, "m_group")
    other = TargetSpec("T.OTHER", spec.data_schema, spec.keys)
    stores = [MergeOnReadStore(spark, f"{root}/{n}", s, 4) for n, s in (("kv", spec), ("other", other))]
    commits = CommitLog(spark, f"{root}/commits")
    job = SyncJob([SyncTarget(s, st) for s, st in zip((spec, other), stores)], f"{root}/q", f"{root}/m", as_of=DAY, commits=commits)
    run, batch = make_batch_fn(job), lines(spark, _env("I", 1, "a", 1), _env("I", 5, "o", 3).replace("T.KV", "T.OTHER"))
    real = commits.commit
    commits.commit = lambda *a, **k: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        run(batch, 0)
    assert [again(s).read().count() for s in stores] == [0, 0] and not again(stores[0]).has_batch(0)
    before = commits.tokens()
    commits.commit = real
    fresh = [again(s) for s in stores]  # a restart; the prepared versions are written anew
    job = SyncJob([SyncTarget(s, st) for s, st in zip((spec, other), fresh)], f"{root}/q", f"{root}/m", as_of=DAY, commits=commits)
    make_batch_fn(job)(batch, 0)
    make_batch_fn(job)(batch, 0)
    assert [again(s).read().count() for s in stores] == [1, 1]
    assert [again(s).refresh(before).read().count() for s in stores] == [0, 0]  # a reader as of before the commit
    with pytest.raises(ValueError):
        make_batch_fn(SyncJob([SyncTarget(spec, SnapshotStore(spark, f"{root}/s", spec.table_schema))], f"{root}/q", f"{root}/m", commits=commits))


def test_a_type_that_changes_keeps_all_rows(spark):
    store, spec = filled(spark, "m_types", 20)
    store.apply(kv_changes(spark, spec, _env("U", 5, "17", 1)), spec, DAY, 1)
    wider = spec.with_type("v", T.IntegerType())
    store = again(store, wider)
    store.apply(kv_changes(spark, wider, _env("U", 6, 18, 2)), wider, DAY, 2)
    assert {r["k"]: r["v"] for r in store.read().collect()} == {**{k: None for k in range(20)}, 5: 17, 6: 18}
    store.compact()
    assert store.read().schema["v"].dataType == T.IntegerType() and store.read().count() == 20
    with pytest.raises(ValueError):
        again(store, wider.with_type("k", T.StringType())).read()


def test_slow_readers_and_vacuum(spark):
    store, spec = filled(spark, "m_lease")
    store.apply(kv_changes(spark, spec, _env("U", 5, "b", 1)), spec, DAY, 1)
    with store.pinned() as slow:
        store.publish(store.read(), 2)
        assert store.vacuum(older_than_hours=-1) == 0
        assert slow.where("v = 'b'").count() == 1
    assert store.vacuum(older_than_hours=-1) == 9 and store.read().count() == 400
    slots = SnapshotStore(spark, scratch_path(spark, "m_slots"), spec.table_schema)
    slots.publish(store.read(), 0)
    with slots.pinned() as slow:
        for n in range(1, 4):
            slots.publish(store.read().limit(n), n)
        assert slow.count() == 400 and slots.read().count() == 3


def test_opening_reads_a_checkpoint_and_a_tail(spark):
    root = scratch_path(spark, "m_log")
    log, state = VersionLog(spark, root), {"version": 0, "sum": 0}
    fold = lambda s, e: {"version": e["version"], "sum": s["sum"] + e["x"]}
    for n in range(1, 1001):
        log.append({"version": n, "x": n})
        state = fold(state, {"version": n, "x": n})
        log.keep(state)
    fresh = VersionLog(spark, root)
    assert fresh.load({"version": 0, "sum": 0}, fold) == state == {"version": 1000, "sum": 500500}
    assert len(fresh.opened) == 1 + 1000 % 64 and len(fresh.files.names()) < 200


def test_slot_store_opens_by_its_state_file(spark, monkeypatch):
    monkeypatch.setattr("tablesync.sinks.snapshot.PER_FOLDER", 3)
    assert PER_FOLDER == 64
    spec = kv_spec(spark)
    store = SnapshotStore(spark, scratch_path(spark, "m_slot_log"), spec.table_schema)
    empty = spark.createDataFrame([], spec.table_schema)
    for n in range(8):
        store.publish(empty, n, stream="ab"[n % 2])
    fresh = SnapshotStore(spark, store.root, spec.table_schema)
    assert fresh.head()["version"] == 8 and fresh.history().count() == 8
    assert fresh.has_batch(7, "b") and fresh.has_batch(6, "a") and not fresh.has_batch(8, "a")


@pytest.mark.parametrize("step", ["publish", "health"])
def test_health_rows_survive_a_replay(spark, step, monkeypatch):
    spec, root = kv_spec(spark), scratch_path(spark, "m_health")
    store = MergeOnReadStore(spark, f"{root}/kv", spec, 4)
    health = HealthLog(spark, f"{root}/health")
    job = SyncJob([SyncTarget(spec, store)], f"{root}/q", f"{root}/m", as_of=DAY, health=health)
    target, name = (MergeOnReadStore, "apply") if step == "publish" else (HealthLog, "record")
    real, failed = getattr(target, name), []

    def fails(*a, **k):
        if not failed:
            failed.append(1)
            raise OSError("lost")
        return real(*a, **k)

    monkeypatch.setattr(target, name, fails)
    run, batch = make_batch_fn(job), lines(spark, _env("I", 1, "a", 1))
    with pytest.raises(OSError):
        run(batch, 0)
    run(batch, 0)
    run(batch, 0)
    run(lines(spark, _env("I", 2, "a", 2)), 1)
    assert [(r["target"], str(r["last_run"])) for r in health.read().collect()] == [("T.KV", DAY)] * 2
    health.compact(F.lit(DAY).cast("timestamp"), 15)
    assert health.read().count() == 2 and HealthLog(spark, f"{root}/health").read().count() == 2
    health.compact(F.lit("2024-03-01").cast("timestamp"), 15)
    assert health.read().count() == 0


def plan_row(**more):
    row = {"table_name": "T.KV", "tag_column": "table", "db_table": None, "keys": ["k"], "op_type": "U", "sink_kind": "files", "location1": "/a", "purge": False,
           "purge_days": None, "purge_column": "UPDATE_DATE", "cast_column": None, "cast_type": None}
    return row | more


def test_every_plan_row_of_a_table_counts(spark):
    spec = kv_spec(spark)
    made = lambda rs: targets_from_plan(rs, lambda _: spec, lambda *_: None)[0]
    t = made([plan_row(), plan_row(op_type="I", cast_column="v", cast_type="Integer"), plan_row(op_type="D", purge=True, purge_days=7)])
    assert (t.purge_days, t.purge_column, t.op_order) == (7, "UPDATE_DATE", ("U", "I", "D"))
    assert isinstance(t.spec.data_schema["v"].dataType, T.IntegerType)
    for other in ({"purge": True, "purge_days": 8}, {"keys": ["v"]}, {"tag_column": "tbl"}, {"sink_kind": "db"}, {"cast_column": "v", "cast_type": "Date"}):
        with pytest.raises(ValueError):
            made([plan_row(purge=True, purge_days=7, cast_column="v", cast_type="Integer"), plan_row(**other)])


def test_stores_follow_the_sink_kind(spark):
    spec, root = kv_spec(spark), scratch_path(spark, "m_route")
    stub = object()
    router = store_router(spark, "bucketed", db=lambda row, _: (stub, row["db_table"]), root=root, buckets=4)
    assert router(plan_row(sink_kind="db", db_table="crm.kv"), spec) == (stub, "crm.kv")
    assert isinstance(router(plan_row(), spec), BucketedStore)
    assert isinstance(store_router(spark)(plan_row(location1=root), spec), MergeOnReadStore)
    assert isinstance(store_router(spark, "slots")(plan_row(location1=root), spec), SnapshotStore)
    for bad in (lambda: store_router(spark, "tape"), lambda: router(plan_row(sink_kind="tape"), spec), lambda: store_router(spark)(plan_row(sink_kind="db"), spec), lambda: store_router(spark)(plan_row(location1=None), spec)):
        with pytest.raises(ValueError):
            bad()


def test_an_update_without_the_old_key_is_in_place(spark):
    ch, bad, _ = changes(spark, ['{"table":"T","op_type":"U","op_ts":"2024-01-01 00:00:00","pos":"1","before":{"v":"y"},"after":{"k":1,"k2":"a","v":"n"}}'.replace('"T"', f'"{SPEC.name}"')])
    assert [(r["k"], r["_op"], r["_prev"]) for r in ch.collect()] == [(1, "U", None)]
    assert sync.has_rebirths(ch, SPEC.key_cols) is False
