"""Queries over the nested-document operators (P-FLAT)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.nested import array_index, explode_column, flatten_long, pivot_points, unpivot_struct
from ..session import scratch_path
from ..sinks.files import write_csv, write_json_multiline
from ..sources.json_arrays import read_json_array
from ..sources.files import read_delimited, read_json
from . import documents as docs
from . import fixtures as fx
from .registry import register

LONG_COLS = ["storageid", "directorid", "group_no", "metricid", "value", "ts"]

# Within a document (a block of orders) the group number is the rank of the line number among those of its
# storage and director.
_PLACE = """floor(l_orderkey / 1024) as block, l_returnflag as storageid, l_linestatus as directorid,
       cast(dense_rank() over (partition by floor(l_orderkey / 1024), l_returnflag, l_linestatus order by l_linenumber) - 1 as integer) as group_no,
       cast(l_suppkey % 10 as varchar) as metricid"""
_POINT_NO = """row_number() over (partition by floor(l_orderkey / 1024), l_returnflag, l_linestatus, l_linenumber, l_suppkey % 10
                            order by l_shipdate, l_orderkey, l_suppkey, l_partkey, l_quantity) as rn"""
_LONG_SQL = f"select storageid, directorid, group_no, metricid, value, ts from (select {_PLACE}, l_quantity as value, l_shipdate as ts from lineitem)"


def _long(d: DataFrame) -> DataFrame:
    return flatten_long(d, ["ip"], docs.LONG_LEVELS).select(*LONG_COLS)


@register("nested_flatten_long", _LONG_SQL)
def nested_flatten_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated goal of the flatten: one row per data point, each paired only with its real parents."""
    return _long(docs.metric_documents(fx.table(spark, sf_dir, "lineitem")))


_WIDE_SQL = f"""
with m as (select {_PLACE}, l_quantity as value, l_shipdate as ts, {_POINT_NO} from lineitem)
select storageid, directorid, group_no, metricid,
       max(case when rn = 1 then value end) as value_1, max(case when rn = 2 then value end) as value_2,
       max(case when rn = 1 then ts end) as ts_1, max(case when rn = 2 then ts end) as ts_2
from m group by block, storageid, directorid, group_no, metricid"""


@register("nested_flatten_wide", _WIDE_SQL)
def nested_flatten_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide form: one row per metric, its first two points as columns (NULL when absent)."""
    d = docs.metric_documents(fx.table(spark, sf_dir, "lineitem"))
    m = flatten_long(d, ["ip"], docs.METRIC_LEVELS).drop("ip")
    return pivot_points(m, "data", 2, {"value": "value", "ts": "ts"})


_EXPLODE_ARRAY = "filter(split(p_name, ' '), w -> w like '%o%')"
_EXPLODE_DUCK = "list_filter(string_split(p_name, ' '), lambda w: w like '%o%')"


@register("explode_inner", f"select p_partkey, unnest({_EXPLODE_DUCK}) as word from part")
def explode_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``explode``: a row per element; rows with an empty array are dropped."""
    part = fx.table(spark, sf_dir, "part").select("p_partkey", F.expr(_EXPLODE_ARRAY).alias("words"))
    return explode_column(part, "words", "word")


@register("explode_outer", f"""
select p_partkey, w.word from part
left join lateral (select unnest({_EXPLODE_DUCK}) as word) w on true""")
def explode_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``explode_outer``: rows with an empty array are kept once, with a NULL element."""
    part = fx.table(spark, sf_dir, "part").select("p_partkey", F.expr(_EXPLODE_ARRAY).alias("words"))
    return explode_column(part, "words", "word", outer=True)


_INDEX_SQL = f"""
with m as (select {_PLACE}, l_quantity, {_POINT_NO} from lineitem),
d as (select block, arg_min(directorid, storageid || '|' || directorid) as first_director from m group by block)
select m.storageid, m.directorid, m.group_no, m.metricid, d.first_director, max(case when rn = 3 then l_quantity end) as value_3
from m join d using (block)
group by m.block, m.storageid, m.directorid, m.group_no, m.metricid, d.first_director"""


@register("array_index", _INDEX_SQL)
def array_index_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array indexing: a ``selectExpr`` path with indexes, and a third point that may not exist
    (NULL, where ``getItem`` would raise under ANSI)."""
    d = docs.metric_documents(fx.table(spark, sf_dir, "lineitem"))
    d = d.selectExpr("*", "get(get(storageidlist, 0).fedirectorList, 0).directorId as first_director")
    m = flatten_long(d, ["first_director"], docs.METRIC_LEVELS)
    return m.select("storageid", "directorid", "group_no", "metricid", "first_director",
                    array_index("data", 2)["value"].alias("value_3"))


@register("unpivot_struct", """
select p_partkey, 'p_brand' as field, p_brand as value from part
union all select p_partkey, 'p_type', p_type from part
union all select p_partkey, 'p_name', p_name from part""")
def unpivot_struct_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``explode(array(struct.*))``: one row per field of a struct."""
    part = fx.table(spark, sf_dir, "part").select("p_partkey", F.struct("p_brand", "p_type", "p_name").alias("s"))
    return unpivot_struct(part, ["p_partkey"], "s")


@register("flatten_to_csv", _LONG_SQL)
def flatten_to_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole flatten job: documents -> long rows -> CSV with header; the CSV is read back."""
    path = scratch_path(spark, "flatten_csv")
    write_csv(_long(docs.metric_documents(fx.table(spark, sf_dir, "lineitem"))), path)
    schema = "storageid string, directorid string, group_no int, metricid string, value double, ts timestamp_ntz"
    return read_delimited(spark, path, schema)


@register("json_multiline_scan", _LONG_SQL)
def json_multiline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as multi-line JSON (one array per file), scanned with the declared
    document schema, then flattened."""
    path = scratch_path(spark, "docs_json")
    write_json_multiline(docs.metric_documents(fx.table(spark, sf_dir, "lineitem")), path)
    return _long(read_json(spark, path, docs.DOCUMENT, multiline=True))


@register("json_array_scan", _LONG_SQL)
def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as one array in one file (more files of one array each, where there are more than
    ``FILE_DOCS`` documents), each read by a task per byte range."""
    path = scratch_path(spark, "docs_array")
    lineitem = fx.table(spark, sf_dir, "lineitem")
    write_json_multiline(docs.metric_documents(lineitem).coalesce(docs.array_files(lineitem)), path)
    return _long(read_json_array(spark, path, docs.DOCUMENT))
