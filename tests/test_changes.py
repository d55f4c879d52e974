
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.changes import apply_changes, apply_phases, collapse_changes
from tablesync.schema import INSERT_DATE, UPDATE_DATE, TargetSpec, data_columns, key_list
from tablesync.sources.envelope import change_rows, parse_envelope, split_bad

SPEC = TargetSpec(
    "T.ITEMS",
    T.StructType([T.StructField("k", T.LongType()), T.StructField("k2", T.StringType()), T.StructField("v", T.StringType())]),
    ("k", "k2"),
)
AS_OF = "2024-06-01 00:00:00"
OLD = "2020-01-01 00:00:00"


def env(op, pos, after=None, before=None, table="T.ITEMS", ts="2024-01-01 00:00:00.000000"):
    d = {"table": table, "op_type": op, "op_ts": ts, "pos": f"{pos:020d}"}
    if after is not None:
        d["after"] = after
    if before is not None:
        d["before"] = before
    return json.dumps(d)


def target(spark, rows):
    data = [(k, k2, v, OLD, OLD) for k, k2, v in rows]
    df = spark.createDataFrame(data, "k long, k2 string, v string, i string, u string")
    return df.select("k", "k2", "v", F.col("i").cast("timestamp_ntz").alias(INSERT_DATE), F.col("u").cast("timestamp_ntz").alias(UPDATE_DATE))


def changes(spark, lines):
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = split_bad(parse_envelope(raw))
    ch, bad_rows = change_rows(good, SPEC)
    return ch, bad, bad_rows


def rows(df):
    return sorted((r["k"], r["k2"], r["v"], str(r[INSERT_DATE]), str(r[UPDATE_DATE])) for r in df.collect())


@pytest.mark.parametrize("strategy", ["general", "broadcast"])
def test_update_decided_per_row(spark, strategy):
    """D1: a matched update replaces its row, an unmatched one is inserted, in one batch."""
    t = target(spark, [(1, "a", "x"), (2, "a", "y")])
    ch, _, _ = changes(spark, [
        env("U", 1, {"k": 1, "k2": "a", "v": "x2"}, {"k": 1, "k2": "a", "v": "x"}),
        env("U", 2, {"k": 3, "k2": "a", "v": "z"}, {"k": 3, "k2": "a", "v": "z0"}),
    ])
    out = rows(apply_changes(t, ch, SPEC, "U", AS_OF, strategy=strategy))
    assert out == [
        (1, "a", "x2", OLD, AS_OF),
        (2, "a", "y", OLD, OLD),
        (3, "a", "z", AS_OF, AS_OF),
    ]


def test_key_change_moves_row_and_keeps_insert_date(spark):
    """D2: the old key is deleted, the new key upserted, INSERT_DATE carried over."""
    t = target(spark, [(1, "a", "x"), (2, "a", "y")])
    ch, _, _ = changes(spark, [env("U", 1, {"k": 10, "k2": "a", "v": "moved"}, {"k": 1, "k2": "a", "v": "x"})])
    out = rows(apply_changes(t, ch, SPEC, None, AS_OF))
    assert out == [(2, "a", "y", OLD, OLD), (10, "a", "moved", OLD, AS_OF)]


def test_untouched_rows_keep_date_order(spark):
    """D3: the union is by name, so untouched rows keep INSERT_DATE and UPDATE_DATE in place."""
    t = target(spark, [(1, "a", "x"), (2, "a", "y")]).withColumn(UPDATE_DATE, F.lit("2021-05-05").cast("timestamp_ntz"))
    ch, _, _ = changes(spark, [env("U", 1, {"k": 1, "k2": "a", "v": "x2"})])
    out = {r["k"]: r for r in apply_changes(t, ch, SPEC, "U", AS_OF).collect()}
    assert str(out[2][INSERT_DATE]) == OLD and str(out[2][UPDATE_DATE]) == "2021-05-05 00:00:00"


def test_latest_event_wins(spark):
    """D4: several changes of one key in a batch resolve by (op_ts, pos), not arbitrarily."""
    t = target(spark, [])
    ch, _, _ = changes(spark, [
        env("I", 3, {"k": 1, "k2": "a", "v": "third"}),
        env("I", 1, {"k": 1, "k2": "a", "v": "first"}),
        env("U", 2, {"k": 1, "k2": "a", "v": "second"}),
        env("D", 5, before={"k": 2, "k2": "a"}),
        env("I", 4, {"k": 2, "k2": "a", "v": "gone"}),
        env("I", 9, {"k": 1, "k2": "b", "v": "early"}, ts="2024-01-01 00:00:00.000001"),
        env("U", 10, {"k": 1, "k2": "b", "v": "late-pos-early-ts"}, ts="2024-01-01 00:00:00.000000"),
    ])
    out = rows(apply_changes(t, ch, SPEC, None, AS_OF))
    assert [(r[0], r[1], r[2]) for r in out] == [(1, "a", "third"), (1, "b", "early")]


def test_collapse_equals_row_number_twin(spark):
    """The aggregate collapse picks the same rows as the window form."""
    lines = [env("U" if i % 3 else "I", i, {"k": i % 7, "k2": "a", "v": f"v{i}"}) for i in range(60)]
    ch, _, _ = changes(spark, lines)
    agg = collapse_changes(ch, ["k", "k2"]).select("k", "k2", F.col("_img.v").alias("v"))
    w = Window.partitionBy("k", "k2").orderBy(F.col("_seq").desc())
    win = ch.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("k", "k2", F.col("_img.v").alias("v"))
    assert sorted(agg.collect()) == sorted(win.collect())


def test_insert_on_existing_key_modes(spark):
    t = target(spark, [(1, "a", "x")])
    ch, _, _ = changes(spark, [env("I", 1, {"k": 1, "k2": "a", "v": "new"})])
    assert rows(apply_changes(t, ch, SPEC, "I", AS_OF)) == [(1, "a", "new", OLD, AS_OF)]
    assert rows(apply_changes(t, ch, SPEC, "I", AS_OF, insert_mode="keep")) == [(1, "a", "x", OLD, OLD)]


def test_delete_absent_key_is_noop(spark):
    t = target(spark, [(1, "a", "x")])
    ch, _, _ = changes(spark, [env("D", 1, before={"k": 5, "k2": "a"})])
    assert rows(apply_changes(t, ch, SPEC, "D", AS_OF)) == [(1, "a", "x", OLD, OLD)]


def test_missing_before_field_is_null(spark):
    """D7: an envelope without ``before`` parses; the image is NULL, not a failure."""
    ch, bad, _ = changes(spark, [env("I", 1, {"k": 1, "k2": "a"})])
    r = ch.collect()[0]
    assert r["_img"]["v"] is None and bad.count() == 0


def test_bad_rows_go_to_quarantine(spark):
    """D8, D11: NULL key parts, malformed text, unknown op types and missing images are set aside."""
    lines = [
        env("I", 1, {"k": None, "k2": "a", "v": "nullkey"}),
        env("X", 2, {"k": 1, "k2": "a", "v": "badop"}),
        '{"table": "T.ITEMS", "op_type": "I", "op_ts": "2024-01-01 00:00:',
        env("U", 3),
        env("I", 4, {"k": "not-a-number", "k2": "a", "v": "badcast"}),
        env("I", 5, {"k": 2, "k2": "a", "v": "ok"}),
    ]
    ch, bad, bad_rows = changes(spark, lines)
    assert sorted(r["_reason"] for r in bad.collect()) == ["malformed", "missing_image", "unknown_op"]
    assert sorted(r["_reason"] for r in bad_rows.collect()) == ["bad_image", "null_key"]
    assert [r["k"] for r in ch.collect()] == [2]


def test_phases_equal_one_pass_when_one_change_per_key(spark):
    t = target(spark, [(1, "a", "x"), (2, "a", "y"), (3, "a", "z")])
    ch, _, _ = changes(spark, [
        env("I", 1, {"k": 4, "k2": "a", "v": "n"}),
        env("U", 2, {"k": 1, "k2": "a", "v": "x2"}),
        env("D", 3, before={"k": 2, "k2": "a"}),
    ])
    a = rows(apply_phases(t, ch, SPEC, ["I", "U", "D"], AS_OF))
    b = rows(apply_changes(t, ch, SPEC, None, AS_OF))
    assert a == b


def test_batches_replays_and_one_batch_agree(spark):
    """Applying a log as one batch, as N batches, or with a batch replayed gives the same rows."""
    lines = [env(("I", "U", "D")[i % 3], i, {"k": i % 5, "k2": "a", "v": f"v{i}"} if i % 3 != 2 else None,
                 {"k": i % 5, "k2": "a"} if i % 3 == 2 else None) for i in range(30)]
    t0 = target(spark, [])

    def merge(t, part):
        ch, _, _ = changes(spark, part)
        return spark.createDataFrame(apply_changes(t, ch, SPEC, None, AS_OF).collect(), t0.schema)

    one = rows(merge(t0, lines))
    t = t0
    for i in range(0, 30, 7):
        t = merge(t, lines[i:i + 7])
    assert rows(t) == one
    assert rows(merge(t, lines[28:30])) == one  # a replayed last batch changes nothing


def test_exact_audit_column_names():
    """D10: audit columns are excluded by exact name only."""
    assert data_columns(["A", "LAST_UPDATE_DATE", "INSERT_DATE", "UPDATE_DATE"]) == ["A", "LAST_UPDATE_DATE"]
    assert key_list(" a , b,") == ["a", "b"]
    with pytest.raises(ValueError):
        key_list(" , ")


def test_key_change_chain_in_one_batch(spark):
    """a -> b -> c in one batch: only c remains, with a's INSERT_DATE (origin of the chain)."""
    t = target(spark, [(1, "a", "x"), (9, "a", "other")])
    ch, _, _ = changes(spark, [
        env("U", 1, {"k": 2, "k2": "a", "v": "hop1"}, {"k": 1, "k2": "a", "v": "x"}),
        env("U", 2, {"k": 3, "k2": "a", "v": "hop2"}, {"k": 2, "k2": "a", "v": "hop1"}),
        env("U", 3, {"k": 4, "k2": "a", "v": "hop3"}, {"k": 3, "k2": "a", "v": "hop2"}),
    ])
    out = rows(apply_changes(t, ch, SPEC, None, AS_OF))
    assert out == [(4, "a", "hop3", OLD, AS_OF), (9, "a", "other", OLD, OLD)]
    out_u = rows(apply_phases(t, ch, SPEC, ["I", "U", "D"], AS_OF))
    assert out_u == out


@pytest.mark.parametrize("strategy", ["general", "broadcast"])
def test_sequence_guard_ignores_late_changes(spark, strategy):
    """With a sequence column, an event older than the stored row neither overwrites nor deletes it."""
    spec = TargetSpec("T.ITEMS", SPEC.data_schema, SPEC.keys, seq_column="_last_pos")
    newer = "2024-01-02 00:00:00.000000|00000000000000000005"
    t = target(spark, [(1, "a", "x"), (2, "a", "y"), (3, "a", "z")]).withColumn("_last_pos", F.lit(newer))
    day1, day3 = "2024-01-01 00:00:00.000000", "2024-01-03 00:00:00.000000"
    ch, _, _ = changes(spark, [
        env("U", 1, {"k": 1, "k2": "a", "v": "late"}, ts=day1),
        env("D", 2, before={"k": 2, "k2": "a"}, ts=day1),
        env("U", 3, {"k": 3, "k2": "a", "v": "fresh"}, ts=day3),
        env("I", 4, {"k": 4, "k2": "a", "v": "new"}, ts=day1),
    ])
    out = apply_changes(t, ch, spec, None, AS_OF, strategy=strategy)
    got = {r["k"]: (r["v"], r["_last_pos"]) for r in out.collect()}
    assert got == {
        1: ("x", newer),
        2: ("y", newer),
        3: ("fresh", "2024-01-03 00:00:00.000000|00000000000000000003"),
        4: ("new", "2024-01-01 00:00:00.000000|00000000000000000004"),
    }
    assert out.columns == spec.table_schema.fieldNames()
