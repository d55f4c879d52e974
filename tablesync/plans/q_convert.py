"""Queries over conversion and text functions (casts, clock formats, elapsed time, string parts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.convert import age_days, cast_columns, format_clock, parse_clock, purge_due, refresh_due, time_of_day
from ..functions.text import error_text, list_item, take_right
from ..sources.envelope import parse_envelope, probe_fields, split_bad
from . import fixtures as fx
from .registry import register

# Text forms of event fields, as they arrive in images before the target's types apply.
_TEXT_SQL_SRC = """
select event_id, cast(user_id as varchar) as user_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts_text,
       strftime(ts, '%Y-%m-%d') as day_text,
       case event_type when 'error' then 'true' when 'view' then 'false' else event_type end as flag,
       json_extract_string(props, '$.k') as k, event_type
from events"""


@register("cast_columns", f"""
select event_id, try_cast(user_id as integer) as user_id, try_cast(ts_text as timestamp) as ts_text,
       try_cast(day_text as date) as day_text, try_cast(flag as boolean) as flag,
       try_cast(k as integer) as k, cast(event_type as varchar) as event_type
from ({_TEXT_SQL_SRC})""")
def cast_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts by control-table type name; text that does not convert becomes NULL."""
    ev = fx.table(spark, sf_dir, "events")
    src = ev.select(
        "event_id", F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"),
        F.when(F.col("event_type") == "error", "true").when(F.col("event_type") == "view", "false")
        .otherwise(F.col("event_type")).alias("flag"),
        F.get_json_object("props", "$.k").alias("k"), "event_type",
    )
    return cast_columns(src, {"user_id": "Integer", "ts_text": "Timestamp", "day_text": "Date", "flag": "Boolean",
                              "k": "Integer", "event_type": "String"})


@register("json_scalar", "select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events")
def json_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One field of a JSON text column parsed with a declared schema."""
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", F.col("p.k").alias("k"))


@register("format_clock", """
select event_id, strftime(ts, '%d-%b-%Y %I:%M.%S %p') as clock, strftime(ts, '%H:%M:%S') as time_of_day from events""")
def format_clock_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", format_clock(F.col("ts")).alias("clock"), time_of_day(F.col("ts")).alias("time_of_day"))


@register("parse_clock", """
select event_id, strptime(strftime(ts, '%d-%b-%Y %I:%M.%S %p'), '%d-%b-%Y %I:%M.%S %p') as parsed from events""")
def parse_clock_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock text back to time (to the second)."""
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", parse_clock(format_clock(F.col("ts"))).alias("parsed"))


@register("age_days", """
select event_id, (epoch_us(timestamp '2024-02-15 00:00:00') - epoch_us(ts)) // 86400000000 as age_days,
       (epoch_us(timestamp '2024-02-15 00:00:00') - epoch_us(ts)) // 86400000000 >= 15 as purge_due
from events""")
def age_days_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole days since each event at a fixed clock, and the 15-day purge test."""
    ev = fx.table(spark, sf_dir, "events")
    now = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    return ev.select("event_id", age_days(F.col("ts"), now).cast("bigint").alias("age_days"),
                     purge_due(F.col("ts"), now).alias("purge_due"))


@register("refresh_due", """
select event_id, ts >= date_trunc('day', ts) + interval 4 hour as refresh_due from events""")
def refresh_due_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh test: a stream started at midnight, checked at each event, every 4 hours."""
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", refresh_due(F.date_trunc("DAY", "ts"), F.col("ts"), 4).alias("refresh_due"))


@register("string_parts", """
select c_custkey, right(c_name, 9) as name_no, substring(c_name, 1, 8) as name_head,
       regexp_replace(c_name, '#0*', '-', 'g') as name_clean,
       string_split(c_mktsegment, 'I')[1] as seg_head,
       length(substring(repeat(c_name, 120), 1, 1990)) as err_len
from customer""")
def string_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """take-right, substring, replace-all, split + index, and error text bounded under 2000."""
    c = fx.table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", take_right(F.col("c_name"), 9).alias("name_no"), F.substring("c_name", 1, 8).alias("name_head"),
        F.regexp_replace("c_name", "#0*", "-").alias("name_clean"), list_item(F.col("c_mktsegment"), "I", 1).alias("seg_head"),
        F.length(error_text(F.repeat(F.col("c_name"), 120))).cast("bigint").alias("err_len"),
    )


@register("field_probe", """
select true as has_op_ts, o_orderpriority in ('1-URGENT', '2-HIGH') as has_after,
       o_orderpriority in ('1-URGENT', '2-HIGH') as has_after_key,
       false as has_unknown_field
from orders""")
def field_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field-present probes on raw envelopes (a typed read of each path that succeeds or not)."""
    orders = fx.table(spark, sf_dir, "orders")
    env = split_bad(parse_envelope(fx.order_envelopes(orders, fx.orders_spec(orders), priorities=None)))[0]
    return probe_fields(env, {
        "has_op_ts": ("$.op_ts", "string"),
        "has_after": ("$.after", "struct"),
        "has_after_key": ("$.after.o_orderkey", "bigint"),
        "has_unknown_field": ("$.after.METRIC_COLUMN_ID", "bigint"),
    })

