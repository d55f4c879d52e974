"""Fixtures derived from the given tables (FIXTURES.md §3), built with Spark so they grow with the data.

Order change classes come from an attribute of each order, so every order takes part:
priority ``1-URGENT`` orders are new (not in the target) and arrive as inserts, ``2-HIGH``
orders are updated (status 'X', price + 100), ``3-MEDIUM`` orders are deleted; the other
priorities stay untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import INSERT_DATE, UPDATE_DATE, TargetSpec
from ..sources.envelope import envelope_columns

# Fixed values of the fixtures (mirrored in the oracle SQL).
AS_OF = "2024-01-01 00:00:00"
ORDERS_TABLE = "TPCH.ORDERS"
USERS_TABLE = "APP.USER_STATE"
CHANGE_TS = "2024-01-01 00:00:00.000000"
PRIO_INSERT, PRIO_UPDATE, PRIO_DELETE = "1-URGENT", "2-HIGH", "3-MEDIUM"
EVENTS_CUT = "2024-01-15 00:00:00"
TOPIC_ROWS = 250_000  # of a partition of a topic: some 100 MB of envelopes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_topic(df: DataFrame) -> DataFrame:
    """The producer side of a change log: rows spread over at least as many partitions as
    the cluster has cores, of about ``TOPIC_ROWS`` rows at most, as a partitioned topic would deliver them.
    A source that already has that many splits is left as it is."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / TOPIC_ROWS))
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_spec(orders: DataFrame) -> TargetSpec:
    data = T.StructType([orders.schema[c] for c in ORDER_COLS])
    return TargetSpec(ORDERS_TABLE, data, ("o_orderkey",), orders.schema["o_orderdate"].dataType)


def order_target(orders: DataFrame) -> DataFrame:
    """orders not in the insert class, both audit dates = order date."""
    return orders.where(F.col("o_orderpriority") != PRIO_INSERT).select(
        *ORDER_COLS, F.col("o_orderdate").alias(INSERT_DATE), F.col("o_orderdate").alias(UPDATE_DATE)
    )


def _changed_image() -> list:
    return [
        F.col("o_orderkey"), F.col("o_custkey"), F.lit("X").alias("o_orderstatus"),
        (F.col("o_totalprice") + 100).alias("o_totalprice"), F.col("o_orderdate"), F.col("o_orderpriority"),
    ]


def moved_key(step: int = 1) -> Column:
    """A key that no order has (they are not negative), another for each order and step."""
    return -F.col("o_orderkey") * 8 - step


def order_envelopes(orders: DataFrame, spec: TargetSpec, move_keys: bool = False,
                    priorities: tuple[str, ...] | None = (PRIO_INSERT, PRIO_UPDATE, PRIO_DELETE),
                    update_prio: str = PRIO_UPDATE, insert_prio: str = PRIO_INSERT) -> DataFrame:
    """F2 (and F3 with ``move_keys``): envelopes in ``value`` for the change classes (``priorities`` None: for all orders;
    those neither inserted nor updated are deleted)."""
    prio = F.col("o_orderpriority")
    op = F.when(prio == insert_prio, "I").when(prio == update_prio, "U").otherwise("D")
    after_img = _changed_image()
    if move_keys:
        after_img[0] = moved_key().alias("o_orderkey")
    after = F.when(op != "D", F.struct(*after_img))
    before = F.when(op != "I", F.struct(*[F.col(c) for c in ORDER_COLS]))
    src = as_topic(orders if priorities is None else orders.where(prio.isin(*priorities)))
    return envelope_columns(
        src, spec, op, F.lit(CHANGE_TS), F.lpad(F.col("o_orderkey").cast("string"), 20, "0"), ORDERS_TABLE, before, after
    )


def order_steps(orders: DataFrame, spec: TargetSpec, steps: list[tuple[str, Column | None, Column | None, str]]) -> DataFrame:
    """Several events of each updated order, in order: (op, key before, key after, status after)."""
    rest = lambda status: [F.lit(status).alias("o_orderstatus") if c == "o_orderstatus" else F.col(c) for c in ORDER_COLS[1:]]
    image = lambda key, status: F.struct(key.alias("o_orderkey"), *rest(status)) if key is not None else F.lit(None).cast(spec.data_schema)
    events = F.array(*[
        F.struct(F.lit(n).alias("n"), F.lit(op).alias("op"), image(before, "O").alias("b"), image(after, status).alias("a"))
        for n, (op, before, after, status) in enumerate(steps)
    ])
    rows = as_topic(orders.where(F.col("o_orderpriority") == PRIO_UPDATE)).select(F.col("o_orderkey").alias("k"), F.explode(events).alias("e")).select("k", "e.*")
    pos = F.lpad((F.col("k") * 10 + F.col("n")).cast("string"), 20, "0")
    return envelope_columns(rows, spec, F.col("op"), F.lit(CHANGE_TS), pos, ORDERS_TABLE, F.col("b"), F.col("a"))


USER_COLS = ["user_id", "event_type", "value", "last_ts", "last_event_id"]


def users_spec(events: DataFrame, ordered: bool = False) -> TargetSpec:
    """``ordered``: with log position and tombstones, so that batches may arrive in any order."""
    data = T.StructType(
        [
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("last_ts", events.schema["ts"].dataType),
            T.StructField("last_event_id", T.LongType()),
        ]
    )
    extra = ("_last_pos", "_deleted") if ordered else (None, None)
    return TargetSpec(USERS_TABLE, data, ("user_id",), events.schema["ts"].dataType, *extra)


def event_envelopes(events: DataFrame, spec: TargetSpec) -> DataFrame:
    """each event is a change of its user's state; 'error' events delete the user."""
    op = F.when(F.col("event_type") == "error", "D").otherwise("U")
    img = F.struct(
        F.col("user_id"), F.col("event_type"), F.col("value"), F.col("ts").alias("last_ts"), F.col("event_id").alias("last_event_id")
    )
    return envelope_columns(
        as_topic(events), spec, op, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.lpad(F.col("event_id").cast("string"), 20, "0"), USERS_TABLE,
        F.struct(F.col("user_id")), F.when(op == "U", img),
    )


def user_target(events: DataFrame) -> DataFrame:
    """State of each user from the events before the cut: latest event wins, error deletes;
    both audit dates = time of that event."""
    early = events.where(F.col("ts") < F.lit(EVENTS_CUT).cast(events.schema["ts"].dataType))
    last = early.groupBy("user_id").agg(
        F.max_by(F.struct("event_type", "value", "ts", "event_id"), F.struct("ts", "event_id")).alias("e")
    )
    return last.where(F.col("e.event_type") != "error").select(
        "user_id", F.col("e.event_type").alias("event_type"), F.col("e.value").alias("value"),
        F.col("e.ts").alias("last_ts"), F.col("e.event_id").alias("last_event_id"),
        F.col("e.ts").alias(INSERT_DATE), F.col("e.ts").alias(UPDATE_DATE),
    )


def late_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("ts") >= F.lit(EVENTS_CUT).cast(events.schema["ts"].dataType))
