"""Control-plan query over control tables derived from ``supplier`` and ``lineitem``.

Each supplier stands for one replicated table with three master rows (I, U, D in SEQUENCE
order). Suppliers with a non-negative balance sync to files, the others to a database; a
balance over 5000 turns purging on. Delete rows have no table_master row; the health log has
the supplier's latest ship date as its last run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .control import build_plan
from . import fixtures as fx
from .registry import register

PLAN_AS_OF = "1999-01-01 00:00:00"


def control_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    s = fx.table(spark, sf_dir, "supplier")
    files = F.col("s_acctbal") >= 0
    name = F.concat(F.lit("SUPP.S"), F.col("s_suppkey").cast("string"))
    # Three master rows per supplier: a generator over a literal array, not a join.
    ops = F.array(*[F.struct(F.lit(o).alias("op"), F.lit(i).alias("seq")) for o, i in (("I", 1), ("U", 2), ("D", 3))])
    s = s.select("*", F.inline(ops))
    master = s.select(
        (F.col("s_suppkey") * 3 + F.col("seq")).cast("int").alias("ID"),
        F.concat(F.lit("JOB_N"), F.col("s_nationkey").cast("string")).alias("JOBNAME"),
        F.col("seq").alias("SEQUENCE"),
        F.when(files, F.lit("hdfs://namenode/warehouse"))
        .otherwise(F.concat(F.lit("jdbc:derby:memory:sync/db"), F.col("s_nationkey").cast("string"))).alias("CONNECTIONSTRING"),
        F.lit("table").alias("TABLENAME_TAG_IN_TOPIC"),
        name.alias("TABLENAME_IN_TABLE_TAG"),
        F.when(~files, name).alias("TABLENAME_IN_DB"),
        F.lit("l_orderkey, l_linenumber").alias("PRIMARYKEY"),
        F.lit("/sync/a").alias("HDFSLOCATION1"), F.lit("/sync/b").alias("HDFSLOCATION2"),
        F.col("op").alias("OTTYPE_TAG_IN_KAFKA"),
        F.when(F.col("s_acctbal") > 5000, F.lit("Y")).otherwise(F.lit("N")).alias("PURGING"),
        F.lit(30).cast("decimal(38,10)").alias("PURGING_DAYS"),
        F.when(F.col("s_acctbal") > 7500, F.lit("l_shipdate")).alias("PURGING_COLUMN"),
        F.lit("lineitem,orders").alias("INPUT_KAFKA_TOPIC"),
    )
    table_master = master.where(F.col("OTTYPE_TAG_IN_KAFKA") != "D").select(
        F.col("ID").alias("ID_FK"), F.lit("l_shipdate").alias("COLUMNNAME"), F.lit("Timestamp").alias("DATATYPE"),
        F.lit("yyyy-MM-dd").alias("INPUT_DATETIME_FORMAT"), F.lit("dd-MM-yyyy").alias("OUTPUT_DATETIME_FORMAT"),
    )
    last = fx.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.max("l_shipdate").alias("LAST_RUN_TIME"))
    health = master.select("ID", (F.col("ID") - F.col("SEQUENCE")).alias("_sk")).join(
        last.select((F.col("l_suppkey") * 3).alias("_sk"), "LAST_RUN_TIME"), "_sk"
    ).select(F.col("ID").alias("ID_FK"), "LAST_RUN_TIME")
    return master, table_master, health


_PLAN_SQL = """
with so as (select *, unnest([{'op': 'I', 'seq': 1}, {'op': 'U', 'seq': 2}, {'op': 'D', 'seq': 3}]) as o from supplier),
m as (select cast(s_suppkey * 3 + o.seq as integer) as ID, 'JOB_N' || s_nationkey as JOBNAME, o.seq as SEQUENCE,
             s_acctbal >= 0 as files, 'SUPP.S' || s_suppkey as name, o.op as op, s_acctbal, s_nationkey, s_suppkey,
             case when s_acctbal >= 0 then 'hdfs://namenode/warehouse' else 'jdbc:derby:memory:sync/db' || s_nationkey end as conn
      from so),
last as (select l_suppkey, max(l_shipdate) as last_run from lineitem group by l_suppkey)
select ID, JOBNAME, SEQUENCE, name as table_name, 'table' as tag_column,
       case when not files then name end as db_table, ['l_orderkey', 'l_linenumber'] as keys, op as op_type,
       case when not files then 'db' else 'files' end as sink_kind, files as is_file_conn,
       string_split(conn, '/')[2] as database_name,
       '/sync/a' as location1, '/sync/b' as location2, s_acctbal > 5000 as purge, 30 as purge_days,
       case when s_acctbal > 7500 then 'l_shipdate' else 'UPDATE_DATE' end as purge_column,
       case when op <> 'D' then 'l_shipdate' end as cast_column, case when op <> 'D' then 'Timestamp' end as cast_type,
       ['lineitem', 'orders'] as topics, l.last_run,
       coalesce((epoch_us(timestamp '1999-01-01 00:00:00') - epoch_us(l.last_run)) // 86400000000 >= 15, false) as health_purge_due,
       cast(row_number() over (partition by JOBNAME order by SEQUENCE, ID) as integer) as position
from m left join last l on l.l_suppkey = m.s_suppkey"""


@register("control_plan", _PLAN_SQL)
def control_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan of all jobs: master ⟕ table_master ⟕ latest health, with sink kind, database name,
    key list, topic list, purge settings and the health-purge test."""
    master, table_master, health = control_tables(spark, sf_dir)
    return build_plan(master, table_master, health, None, PLAN_AS_OF)


@register("control_plan_job", f"select * from ({_PLAN_SQL}) where JOBNAME = 'JOB_N7'")
def control_plan_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of one job."""
    master, table_master, health = control_tables(spark, sf_dir)
    return build_plan(master, table_master, health, "JOB_N7", PLAN_AS_OF)
