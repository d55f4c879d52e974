"""Random change logs against a plain sequential answer: every path, one batch, several batches, one event a batch."""

import random

import pytest
from pyspark.sql import functions as F

from tablesync.operators.changes import apply_changes
from tablesync.schema import INSERT_DATE
from tablesync.session import scratch_path
from tablesync.sinks.bucketed import BucketedStore

from test_changes import AS_OF, OLD, SPEC, changes, env, rows, target


def random_log(rnd, n, keys):
    """Events over few keys, with moves back and forth, in log order."""
    out = []
    for pos in range(n):
        k, other = rnd.randrange(keys), rnd.randrange(keys)
        op = rnd.choice(["I", "U", "U", "M", "M", "D"])
        out.append((op, k, other if other != k else (k + 1) % keys, f"v{pos}"))
    return out


def lines_of(log, start=0):
    out = []
    for pos, (op, k, other, v) in enumerate(log, start):
        row = lambda key: {"k": key, "k2": "a", "v": v}
        if op == "D":
            out.append(env("D", pos, before=row(k)))
        elif op == "M":
            out.append(env("U", pos, row(other), row(k)))
        else:
            out.append(env(op, pos, row(k)))
    return out


def sequential(state, log, as_of=AS_OF, mode="replace"):
    """One event after the other on a dictionary: key -> (value, insert date, update date)."""
    state = dict(state)
    for op, k, other, v in log:
        if op == "D":
            state.pop(k, None)
        elif op == "M":
            old = state.pop(k, None)
            here = state.get(other) or old
            state[other] = (v, here[1] if here else as_of, as_of)
        elif not (op == "I" and mode == "keep" and k in state):
            state[k] = (v, state[k][1] if k in state else as_of, as_of)
    return sorted((k, "a", *row) for k, row in state.items())


START = {0: ("x", OLD, OLD), 1: ("y", OLD, OLD), 2: ("z", OLD, OLD)}


def start(spark):
    return target(spark, [(k, "a", v) for k, (v, _, _) in START.items()])


def local(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("strategy", ["general", "broadcast"])
@pytest.mark.parametrize("mode", ["replace", "keep"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_batch_equals_the_sequence(spark, seed, mode, strategy):
    log = random_log(random.Random(seed), 24, 6)
    ch, _, _ = changes(spark, lines_of(log))
    out = apply_changes(start(spark), ch, SPEC, None, AS_OF, insert_mode=mode, strategy=strategy)
    assert rows(out) == sequential(START, log, mode=mode)


@pytest.mark.parametrize("size", [1, 5])
def test_batches_equal_the_sequence(spark, size):
    log = random_log(random.Random(11), 10, 5)
    t = start(spark)
    for at in range(0, len(log), size):
        ch, _, _ = changes(spark, lines_of(log[at : at + size], at))
        t = local(spark, apply_changes(t, ch, SPEC, None, AS_OF, strategy="broadcast"))
    assert rows(t) == sequential(START, log)


def test_bucketed_store_equals_the_sequence(spark):
    log = random_log(random.Random(5), 30, 9)
    store = BucketedStore(spark, scratch_path(spark, "t_paths"), SPEC, buckets=5)
    store.publish(start(spark), 0)
    for n, at in enumerate(range(0, 30, 15), 1):
        ch, _, _ = changes(spark, lines_of(log[at : at + 15], at))
        store.apply(ch, SPEC, AS_OF, n)
    assert rows(store.read()) == sequential(START, log)


def test_moves_in_a_circle_end(spark):
    """1 -> 2, 2 -> 1, 1 -> 2: the first life of key 1 is the origin."""
    log = [("M", 1, 2, "a"), ("M", 2, 1, "b"), ("M", 1, 2, "c")]
    t = target(spark, [(1, "a", "y")])
    ch, _, _ = changes(spark, lines_of(log))
    assert rows(apply_changes(t, ch, SPEC, None, AS_OF)) == [(2, "a", "c", OLD, AS_OF)]


def test_a_key_used_as_swap_slot_many_times(spark):
    log = []
    for k in range(60):
        log += [("M", k, 1000, "out"), ("M", 1000, k, "back")]
    t = target(spark, [(k, "a", "v") for k in range(60)])
    ch, _, _ = changes(spark, lines_of(log))
    out = apply_changes(t, ch, SPEC, None, AS_OF)
    assert out.count() == 60 and {str(r[INSERT_DATE]) for r in out.collect()} == {OLD}


@pytest.mark.parametrize("seed", [1, 6])
def test_hot_keys_are_dealt_out_by_ranges(spark, seed, monkeypatch):
    monkeypatch.setattr("tablesync.operators.changes.HOT_KEY_EVENTS", 2)
    log = random_log(random.Random(seed), 30, 4)
    ch, _, _ = changes(spark, lines_of(log))
    assert rows(apply_changes(start(spark), ch, SPEC, None, AS_OF)) == sequential(START, log)


def test_moved_rows_and_op_types(spark):
    """A move belongs to the updates: without them in the plan, its old row stays."""
    log = [("I", 7, 0, "new"), ("M", 1, 8, "moved"), ("D", 2, 0, "")]
    t = start(spark)
    ch, _, _ = changes(spark, lines_of(log))
    without = {r[0]: r[2] for r in rows(apply_changes(t, ch, SPEC, ["I", "D"], AS_OF))}
    assert without == {0: "x", 1: "y", 7: "new"}
    assert rows(apply_changes(t, ch, SPEC, ["D", "U", "I"], AS_OF)) == sequential(START, log)


def test_tombstones_keep_late_events_out(spark):
    from pyspark.sql import types as T

    from tablesync.operators.changes import live_rows
    from tablesync.schema import TargetSpec

    spec = TargetSpec(SPEC.name, SPEC.data_schema, SPEC.keys, seq_column="_pos", tombstone="_dead")
    t = start(spark).withColumn("_pos", F.lit(None).cast("string")).withColumn("_dead", F.lit(False))
    assert isinstance(spec.table_schema["_dead"].dataType, T.BooleanType)
    log = random_log(random.Random(8), 12, 4)
    log = [x if x[0] != "M" else ("U", x[1], x[2], x[3]) for x in log]
    batches = [log[8:], log[:4], log[4:8]]  # the last part arrives first
    for part, at in zip(batches, (8, 0, 4)):
        ch, _, _ = changes(spark, lines_of(part, at))
        t = local(spark, apply_changes(t, ch, spec, None, AS_OF, strategy="general"))
    want = {r[0]: r[2] for r in sequential(START, log)}
    assert {r["k"]: r["v"] for r in live_rows(t, spec).collect()} == want
