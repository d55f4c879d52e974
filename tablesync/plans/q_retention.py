"""Queries over retention operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.retention import purge_by_id, purge_expired, purge_health
from ..schema import INSERT_DATE, UPDATE_DATE
from . import fixtures as fx
from .registry import register

PURGE_AS_OF = "2000-01-01 00:00:00"
PURGE_DAYS = 365


def audited_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with both audit dates = order date (F8)."""
    o = fx.table(spark, sf_dir, "orders")
    return o.select(*fx.ORDER_COLS, F.col("o_orderdate").alias(INSERT_DATE), F.col("o_orderdate").alias(UPDATE_DATE))


PURGE_DEFAULT_SQL = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       o_orderdate as INSERT_DATE, o_orderdate as UPDATE_DATE
from orders where not coalesce(o_orderdate + interval 365 day <= timestamp '2000-01-01 00:00:00', false)"""


@register("purge_expired_default", PURGE_DEFAULT_SQL)
def purge_expired_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row form (key is unique): rows whose UPDATE_DATE + 365 days is past the clock go."""
    return purge_expired(audited_orders(spark, sf_dir), PURGE_DAYS, PURGE_AS_OF)


@register("purge_expired_keyed", PURGE_DEFAULT_SQL)
def purge_expired_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same purge in key form (anti join with the expired keys): same rows on a unique key."""
    return purge_expired(audited_orders(spark, sf_dir), PURGE_DAYS, PURGE_AS_OF, keys=["o_orderkey"])


@register("purge_expired_column", """
select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate from lineitem l
where not exists (select 1 from lineitem e
                  where e.l_orderkey = l.l_orderkey and e.l_linenumber = l.l_linenumber
                    and e.l_shipdate + interval 365 day <= timestamp '2000-01-01 00:00:00')""")
def purge_expired_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purge by a named date column on a table whose key repeats: a key with any expired row
    loses all its rows."""
    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    return purge_expired(li, PURGE_DAYS, PURGE_AS_OF, column="l_shipdate", keys=["l_orderkey", "l_linenumber"])


@register("purge_by_id", "select event_id, user_id as ID_FK, ts as LAST_RUN_TIME from events where user_id <> 7")
def purge_by_id_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health log (events as runs of ids): all rows of one id removed."""
    health = fx.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("ID_FK"), F.col("ts").alias("LAST_RUN_TIME"))
    return purge_by_id(health, "ID_FK", 7)


@register("purge_health", """
with last as (select user_id, max(ts) as last_ts from events group by user_id)
select e.event_id, e.user_id as ID_FK, e.ts as LAST_RUN_TIME
from events e join last l using (user_id)
where (epoch_us(timestamp '2024-02-14 00:00:00') - epoch_us(l.last_ts)) // 86400000000 < 15""")
def purge_health_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids whose last run is 15 or more days old lose their health rows (all ids at once)."""
    health = fx.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("ID_FK"), F.col("ts").alias("LAST_RUN_TIME"))
    return purge_health(health, "ID_FK", "LAST_RUN_TIME", "2024-02-14 00:00:00")
