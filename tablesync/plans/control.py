"""Control tables -> a sync plan: one row per (target table, op type), in SEQUENCE order.

The plan is built with joins (master ⟕ table_master ⟕ latest health run), not per-row
lookups; only the finished plan of one job (a handful of control rows) is collected to the
driver, which then drives the per-table steps while the data stays distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import HEALTH_PURGE_DAYS, age_days
from ..functions.text import database_name, is_file_connection, trimmed_list
from ..operators.changes import as_of_column, latest_by

MASTER_SCHEMA = T.StructType([
    T.StructField("ID", T.IntegerType()),
    T.StructField("JOBNAME", T.StringType()),
    T.StructField("SEQUENCE", T.IntegerType()),
    T.StructField("CONNECTIONSTRING", T.StringType()),
    T.StructField("TABLENAME_TAG_IN_TOPIC", T.StringType()),
    T.StructField("TABLENAME_IN_TABLE_TAG", T.StringType()),
    T.StructField("TABLENAME_IN_DB", T.StringType()),
    T.StructField("PRIMARYKEY", T.StringType()),
    T.StructField("HDFSLOCATION1", T.StringType()),
    T.StructField("HDFSLOCATION2", T.StringType()),
    T.StructField("OTTYPE_TAG_IN_KAFKA", T.StringType()),
    T.StructField("PURGING", T.StringType()),
    T.StructField("PURGING_DAYS", T.DecimalType(38, 10)),
    T.StructField("PURGING_COLUMN", T.StringType()),
    T.StructField("INPUT_KAFKA_TOPIC", T.StringType()),
])
TABLE_MASTER_SCHEMA = T.StructType([
    T.StructField("ID_FK", T.IntegerType()),
    T.StructField("COLUMNNAME", T.StringType()),
    T.StructField("DATATYPE", T.StringType()),
    T.StructField("INPUT_DATETIME_FORMAT", T.StringType()),
    T.StructField("OUTPUT_DATETIME_FORMAT", T.StringType()),
])
HEALTH_SCHEMA = T.StructType([T.StructField("ID_FK", T.IntegerType()), T.StructField("LAST_RUN_TIME", T.TimestampNTZType())])

PLAN_COLS = [
    "ID", "JOBNAME", "SEQUENCE", "table_name", "tag_column", "db_table", "keys", "op_type", "sink_kind",
    "is_file_conn", "database_name", "location1", "location2", "purge", "purge_days", "purge_column",
    "cast_column", "cast_type", "topics", "last_run", "health_purge_due", "position",
]


def build_plan(master: DataFrame, table_master: DataFrame, health: DataFrame, job: str | None = None, as_of=None,
               health_days: int = HEALTH_PURGE_DAYS) -> DataFrame:
    """Sync plan of one job (or all jobs), one row per master row; ``position`` numbers a job's rows by SEQUENCE, ID.

    A master row without table_master or health rows still yields a plan row (NULLs there);
    several table_master rows for one id resolve to the one with the greatest column name.
    """
    m = master if job is None else master.where(F.col("JOBNAME") == F.lit(job))
    tm = latest_by(table_master.where(F.col("ID_FK").isNotNull()), ["ID_FK"], ["COLUMNNAME", "DATATYPE"])
    hl = health.groupBy("ID_FK").agg(F.max("LAST_RUN_TIME").alias("last_run"))
    now = as_of_column(as_of, health.schema["LAST_RUN_TIME"].dataType)
    plan = (
        m.join(tm.withColumnRenamed("ID_FK", "ID"), "ID", "left")
        .join(hl.withColumnRenamed("ID_FK", "ID"), "ID", "left")
    )
    conn = F.col("CONNECTIONSTRING")
    return plan.select(
        "ID", "JOBNAME", "SEQUENCE",
        F.col("TABLENAME_IN_TABLE_TAG").alias("table_name"),
        F.col("TABLENAME_TAG_IN_TOPIC").alias("tag_column"),
        F.col("TABLENAME_IN_DB").alias("db_table"),
        trimmed_list(F.col("PRIMARYKEY")).alias("keys"),
        F.col("OTTYPE_TAG_IN_KAFKA").alias("op_type"),
        F.when(F.col("TABLENAME_IN_DB").isNotNull(), F.lit("db")).otherwise(F.lit("files")).alias("sink_kind"),
        is_file_connection(conn).alias("is_file_conn"),
        database_name(conn).alias("database_name"),
        F.col("HDFSLOCATION1").alias("location1"),
        F.col("HDFSLOCATION2").alias("location2"),
        (F.upper(F.trim(F.col("PURGING"))) == F.lit("Y")).alias("purge"),
        F.floor(F.col("PURGING_DAYS")).cast("int").alias("purge_days"),
        F.coalesce(F.col("PURGING_COLUMN"), F.lit("UPDATE_DATE")).alias("purge_column"),
        F.col("COLUMNNAME").alias("cast_column"),
        F.col("DATATYPE").alias("cast_type"),
        trimmed_list(F.col("INPUT_KAFKA_TOPIC")).alias("topics"),
        "last_run",
        F.coalesce(age_days(F.col("last_run"), now) >= F.lit(health_days), F.lit(False)).alias("health_purge_due"),
        F.row_number().over(Window.partitionBy("JOBNAME").orderBy("SEQUENCE", "ID")).alias("position"),
    )


def plan_rows(plan: DataFrame) -> list[dict]:
    """The plan of one job as driver dicts, in order (control rows only, a bounded set)."""
    return [r.asDict(recursive=True) for r in plan.orderBy("JOBNAME", "position").collect()]


def validate_topics(plan: DataFrame, configured: list[str]) -> None:
    """Every plan row must subscribe to exactly the configured topics (as a set)."""
    want = sorted({t.strip() for t in configured if t.strip()})
    seen = plan.select(F.array_sort(F.array_distinct("topics")).alias("t")).distinct().collect()
    for r in seen:
        if list(r["t"] or []) != want:
            raise ValueError(f"plan topics {r['t']} differ from the configured topics {want}")
