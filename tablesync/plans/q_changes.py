"""Queries over the change-sync operators (envelopes, collapse, merge, phased apply)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import apply_changes, apply_phases, collapse_changes, dedupe, merge_changes, net_changes
from ..operators.joins import join_composite_key, rename_prefix
from ..schema import data_columns
from ..session import checkpoint_root
from ..sources.envelope import change_rows, log_shape, parse_envelope, route, split_bad, struct_expand, typed_image
from . import fixtures as fx
from .registry import register

_TGT_SQL = """
tgt as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               o_orderdate as INSERT_DATE, o_orderdate as UPDATE_DATE
        from orders where o_orderpriority <> '1-URGENT')"""

_MERGE_SELECT = """
select coalesce(t.o_orderkey, g.o_orderkey) as o_orderkey,
       case when g.op is null then t.o_custkey else g.o_custkey end as o_custkey,
       case when g.op is null then t.o_orderstatus else g.o_orderstatus end as o_orderstatus,
       case when g.op is null then t.o_totalprice else g.o_totalprice end as o_totalprice,
       case when g.op is null then t.o_orderdate else g.o_orderdate end as o_orderdate,
       case when g.op is null then t.o_orderpriority else g.o_orderpriority end as o_orderpriority,
       case when g.op is null then t.INSERT_DATE else coalesce(t.INSERT_DATE, timestamp '2024-01-01 00:00:00') end as INSERT_DATE,
       case when g.op is null then t.UPDATE_DATE else timestamp '2024-01-01 00:00:00' end as UPDATE_DATE
from tgt t full outer join chg g on t.o_orderkey = g.o_orderkey
where g.op is null or g.op <> 'D'"""


def _chg_sql(ops: str) -> str:
    return f"""
chg as (select o_orderkey,
               case o_orderpriority when '1-URGENT' then 'I' when '2-HIGH' then 'U' else 'D' end as op,
               o_custkey, 'X' as o_orderstatus, o_totalprice + 100 as o_totalprice, o_orderdate, o_orderpriority
        from orders where o_orderpriority in ({ops}))"""


_ALL = "'1-URGENT', '2-HIGH', '3-MEDIUM'"
MERGE_ORDERS_SQL = f"with {_TGT_SQL}, {_chg_sql(_ALL)} {_MERGE_SELECT}"


def net(target: DataFrame, changes: DataFrame, routed: DataFrame, spec) -> DataFrame:
    """Net changes; whether keys move or come back after a delete is looked up in the key fields only."""
    return net_changes(target, changes, spec.key_cols, **log_shape(routed, spec))


def held(changes: DataFrame) -> DataFrame:
    """The parsed changes, kept in the checkpoint folder: moves and rebirths take several looks, the log is parsed for the first."""
    checkpoint_root(changes.sparkSession)
    return changes.checkpoint()


def order_changes(spark: SparkSession, sf_dir: str, **kw):
    """(orders, spec, target, changes): envelopes parsed, checked, routed and shaped."""
    orders = fx.table(spark, sf_dir, "orders")
    spec = fx.orders_spec(orders)
    env = parse_envelope(fx.order_envelopes(orders, spec, **kw))
    good, _bad = split_bad(env)
    routed = route(good, fx.ORDERS_TABLE)
    changes, _bad_rows = change_rows(routed, spec)
    return orders, spec, fx.order_target(orders), changes, routed


@register("merge_orders", MERGE_ORDERS_SQL)
def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: what does ``orders`` hold after the change log? General (full outer) path."""
    _, spec, target, changes, routed = order_changes(spark, sf_dir)
    return merge_changes(target, net(target, changes, routed, spec), spec, fx.AS_OF, strategy="general")


@register("merge_orders_small", MERGE_ORDERS_SQL)
def merge_orders_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same merge by the bounded-batch path (size-checked broadcast; target not shuffled)."""
    _, spec, target, changes, routed = order_changes(spark, sf_dir)
    return merge_changes(target, net(target, changes, routed, spec), spec, fx.AS_OF, strategy="auto")


@register("apply_insert", f"with {_TGT_SQL}, {_chg_sql(chr(39) + '1-URGENT' + chr(39))} {_MERGE_SELECT}")
def apply_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, spec, target, changes, routed = order_changes(spark, sf_dir)
    return apply_changes(target, changes, spec, "I", fx.AS_OF, **log_shape(routed, spec))


@register("apply_update", f"with {_TGT_SQL}, {_chg_sql(chr(39) + '2-HIGH' + chr(39))} {_MERGE_SELECT}")
def apply_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, spec, target, changes, routed = order_changes(spark, sf_dir)
    return apply_changes(target, changes, spec, "U", fx.AS_OF, **log_shape(routed, spec))


@register("apply_delete", f"with {_TGT_SQL}, {_chg_sql(chr(39) + '3-MEDIUM' + chr(39))} {_MERGE_SELECT}")
def apply_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, spec, target, changes, routed = order_changes(spark, sf_dir)
    return apply_changes(target, changes, spec, "D", fx.AS_OF, **log_shape(routed, spec))


_UNMATCHED_SQL = f"""
with {_TGT_SQL},
chg as (select o_orderkey, 'U' as op, o_custkey, 'X' as o_orderstatus, o_totalprice + 100 as o_totalprice,
               o_orderdate, o_orderpriority
        from orders where o_orderpriority = '1-URGENT')
{_MERGE_SELECT}"""


@register("apply_update_unmatched", _UNMATCHED_SQL)
def apply_update_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates whose key is in no row are inserted (decided per row)."""
    _, spec, target, changes, routed = order_changes(
        spark, sf_dir, priorities=(fx.PRIO_INSERT,), update_prio=fx.PRIO_INSERT, insert_prio="none"
    )
    return apply_changes(target, changes, spec, "U", fx.AS_OF, **log_shape(routed, spec))


_KEYCHANGE_SQL = f"""
with {_TGT_SQL},
moved as (select o_orderkey as old_key, -o_orderkey * 8 - 1 as o_orderkey, o_custkey, 'X' as o_orderstatus,
                 o_totalprice + 100 as o_totalprice, o_orderdate, o_orderpriority
          from orders where o_orderpriority = '2-HIGH')
select t.* from tgt t where not exists (select 1 from moved m where m.old_key = t.o_orderkey)
union all
select m.o_orderkey, m.o_custkey, m.o_orderstatus, m.o_totalprice, m.o_orderdate, m.o_orderpriority,
       coalesce(t.INSERT_DATE, timestamp '2024-01-01 00:00:00') as INSERT_DATE,
       timestamp '2024-01-01 00:00:00' as UPDATE_DATE
from moved m left join tgt t on t.o_orderkey = m.old_key"""


@register("apply_update_keychange", _KEYCHANGE_SQL)
def apply_update_keychange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-changing updates: old key deleted, new key upserted, INSERT_DATE carried over."""
    _, spec, target, changes, _ = order_changes(spark, sf_dir, move_keys=True, priorities=(fx.PRIO_UPDATE,))
    return apply_changes(target, held(changes), spec, None, fx.AS_OF)


@register("apply_phases", MERGE_ORDERS_SQL)
def apply_phases_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I, then U, then D, one phase each (control-table order); same rows as the one-pass merge
    here because every key has one change."""
    _, spec, target, changes, routed = order_changes(spark, sf_dir)
    return apply_phases(target, changes, spec, ["I", "U", "D"], fx.AS_OF, strategy="general", **log_shape(routed, spec))


# ---- several events of a key in one batch ------------------------------------------------

def _steps_sql(key: str, status: str, insert_date: str) -> str:
    """The updated orders end at ``key``; all other rows of the target stay."""
    return f"""
with {_TGT_SQL}
select * from tgt where o_orderpriority <> '2-HIGH'
union all
select {key} as o_orderkey, o_custkey, '{status}' as o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       {insert_date} as INSERT_DATE, timestamp '2024-01-01 00:00:00' as UPDATE_DATE
from tgt where o_orderpriority = '2-HIGH'"""


def _stepped(spark: SparkSession, sf_dir: str, steps, insert_mode: str = "replace") -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    spec = fx.orders_spec(orders)
    routed = route(split_bad(parse_envelope(fx.order_steps(orders, spec, steps)))[0], fx.ORDERS_TABLE)
    changes, _ = change_rows(routed, spec)
    return apply_changes(fx.order_target(orders), held(changes), spec, None, fx.AS_OF, insert_mode)


CHAIN_SQL = _steps_sql("-o_orderkey * 8 - 3", "C", "INSERT_DATE")


def chain_steps() -> list:
    """k -> a -> b -> c."""
    k, (a, b, c) = F.col("o_orderkey"), (fx.moved_key(n) for n in (1, 2, 3))
    return [("U", k, a, "A"), ("U", a, b, "B"), ("U", b, c, "C")]


@register("apply_key_chain", CHAIN_SQL)
def apply_key_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three moves of each row in one batch: INSERT_DATE follows the chain."""
    return _stepped(spark, sf_dir, chain_steps())


@register("apply_move_then_update", _steps_sql("-o_orderkey * 8 - 1", "Y", "INSERT_DATE"))
def apply_move_then_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A move, then an update of the new key: the update does not hide where the row came from."""
    k, a = F.col("o_orderkey"), fx.moved_key()
    return _stepped(spark, sf_dir, [("U", k, a, "X"), ("U", a, a, "Y")])


@register("apply_delete_insert_keep", _steps_sql("o_orderkey", "N", "timestamp '2024-01-01 00:00:00'"))
def apply_delete_insert_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delete, then an insert of the same key, where inserts keep existing rows: a new row."""
    k = F.col("o_orderkey")
    return _stepped(spark, sf_dir, [("D", k, None, ""), ("I", None, k, "N")], insert_mode="keep")


# ---- events as a change log of user state (F4) --------------------------------------------

_LATEST_SQL = """
select user_id, event_type, value, ts as last_ts, event_id as last_event_id
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) e
where rn = 1 and event_type <> 'error'"""


def user_changes(spark: SparkSession, sf_dir: str, events=None):
    events = events if events is not None else fx.table(spark, sf_dir, "events")
    spec = fx.users_spec(events)
    good, _ = split_bad(parse_envelope(fx.event_envelopes(events, spec)))
    routed = route(good, fx.USERS_TABLE)
    changes, _ = change_rows(routed, spec)
    return events, spec, changes, routed


@register("latest_change", _LATEST_SQL)
def latest_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net change per key: latest event by (op_ts, pos); a delete as last event leaves nothing."""
    _, spec, changes, routed = user_changes(spark, sf_dir)
    c = collapse_changes(changes, spec.key_cols)
    return c.where(F.col("_op") != "D").select("user_id", *[F.col("_img")[k].alias(k) for k in spec.data_cols if k != "user_id"])


_MERGE_LATEST_SQL = """
with early as (select * from events where ts < timestamp '2024-01-15 00:00:00'),
late as (select * from events where ts >= timestamp '2024-01-15 00:00:00'),
t0 as (select * from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from early) where rn = 1),
tgt as (select user_id, event_type, value, ts as last_ts, event_id as last_event_id, ts as INSERT_DATE, ts as UPDATE_DATE
        from t0 where event_type <> 'error'),
g as (select * from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn from late) where rn = 1),
died as (select distinct user_id from late where event_type = 'error')
select coalesce(t.user_id, g.user_id) as user_id,
       case when g.user_id is null then t.event_type else g.event_type end as event_type,
       case when g.user_id is null then t.value else g.value end as value,
       case when g.user_id is null then t.last_ts else g.ts end as last_ts,
       case when g.user_id is null then t.last_event_id else g.event_id end as last_event_id,
       case when g.user_id is null then t.INSERT_DATE when g.user_id in (select user_id from died) then timestamp '2024-01-01 00:00:00'
            else coalesce(t.INSERT_DATE, timestamp '2024-01-01 00:00:00') end as INSERT_DATE,
       case when g.user_id is null then t.UPDATE_DATE else timestamp '2024-01-01 00:00:00' end as UPDATE_DATE
from tgt t full outer join g on t.user_id = g.user_id
where g.user_id is null or g.event_type <> 'error'"""


@register("merge_latest", _MERGE_LATEST_SQL)
def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State after the first half of the events, merged with the net change of the second half."""
    events = fx.table(spark, sf_dir, "events")
    _, spec, changes, _ = user_changes(spark, sf_dir, fx.late_events(events))
    target = fx.user_target(events)
    return merge_changes(target, net_changes(target, held(changes), spec.key_cols), spec, fx.AS_OF, strategy="general")


# ---- envelope inspection (P-ENV) ---------------------------------------------------------

_ENV_SQL = """
select 'TPCH.ORDERS' as "table",
       case o_orderpriority when '1-URGENT' then 'I' when '2-HIGH' then 'U' else 'D' end as op_type,
       '2024-01-01 00:00:00.000000' as op_ts, lpad(cast(o_orderkey as varchar), 20, '0') as pos
from orders"""


@register("envelope_parse", _ENV_SQL)
def envelope_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared-schema parse of envelope text (no inference pass)."""
    orders = fx.table(spark, sf_dir, "orders")
    env = parse_envelope(fx.order_envelopes(orders, fx.orders_spec(orders), priorities=None))
    return split_bad(env)[0].select("table", "op_type", "op_ts", "pos")


@register("struct_expand", """
select o_orderkey, o_custkey, 'X' as o_orderstatus, o_totalprice + 100 as o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderpriority in ('1-URGENT', '2-HIGH')""")
def struct_expand_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``after.*`` with the target schema."""
    orders = fx.table(spark, sf_dir, "orders")
    spec = fx.orders_spec(orders)
    env = parse_envelope(fx.order_envelopes(orders, spec, priorities=None))
    return struct_expand(env.where(F.col("after").isNotNull()), spec, "after")


@register("filter_nested", """
select o_orderkey, o_custkey, o_totalprice + 100 as o_totalprice from orders where o_orderpriority = '1-URGENT'""")
def filter_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter on a field inside the after image (equality on a nested field)."""
    orders = fx.table(spark, sf_dir, "orders")
    spec = fx.orders_spec(orders)
    env = parse_envelope(fx.order_envelopes(orders, spec, priorities=None))
    img = env.select(F.inline(F.array(F.struct(typed_image("after", spec.data_schema).alias("after")))))
    return img.where(F.col("after.o_orderpriority") == fx.PRIO_INSERT).select(
        F.col("after.o_orderkey").alias("o_orderkey"), F.col("after.o_custkey").alias("o_custkey"),
        F.col("after.o_totalprice").alias("o_totalprice"))


@register("route_by_table", """
select 'TPCH.ORDERS' as tbl, count(*) as n from orders
union all select 'TPCH.CUSTOMER' as tbl, count(*) as n from customer""")
def route_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixed topic (orders + customer envelopes) routed by the table tag, in one pass."""
    good, _ = split_bad(parse_envelope(mixed_topic(spark, sf_dir, priorities=None)))
    return good.where(F.col("table").isin(fx.ORDERS_TABLE, "TPCH.CUSTOMER")).groupBy(F.col("table").alias("tbl")).agg(F.count(F.lit(1)).alias("n"))


@register("route_by_tag", """
select o_orderkey, o_custkey, 'X' as o_orderstatus, o_totalprice + 100 as o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderpriority in ('1-URGENT', '2-HIGH')""")
def route_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control table names the tag that holds the table: here the topic calls it ``tbl``."""
    orders = fx.table(spark, sf_dir, "orders")
    spec = fx.orders_spec(orders)
    topic = mixed_topic(spark, sf_dir, priorities=None).select(F.regexp_replace("value", '^\\{"table":', '{"tbl":').alias("value"))
    routed = route(split_bad(parse_envelope(topic, tags=("tbl",)))[0], fx.ORDERS_TABLE, "tbl")
    return struct_expand(routed.where(F.col("after").isNotNull()), spec, "after")


def mixed_topic(spark: SparkSession, sf_dir: str, with_broken: bool = False, **kw) -> DataFrame:
    """order envelopes plus customer inserts. With ``with_broken``, the envelopes of
    customers with a negative balance are cut short (malformed JSON)."""
    from pyspark.sql import types as T

    from ..schema import TargetSpec
    from ..sources.envelope import envelope_columns

    orders = fx.table(spark, sf_dir, "orders")
    cust = fx.as_topic(fx.table(spark, sf_dir, "customer"))
    cspec = TargetSpec("TPCH.CUSTOMER", T.StructType(cust.schema.fields), ("c_custkey",))
    img = F.struct(*[F.col(c) for c in cust.columns])
    pos = F.lpad(F.col("c_custkey").cast("string"), 20, "0")
    env = envelope_columns(cust, cspec, F.lit("I"), F.lit(fx.CHANGE_TS), pos, "TPCH.CUSTOMER", None, img)
    if with_broken:
        text = F.col("value")
        env = envelope_columns(
            cust, cspec, F.lit("I"), F.lit(fx.CHANGE_TS), pos, "TPCH.CUSTOMER", None, img
        ).select(text, F.get_json_object(text, "$.after.c_acctbal").cast("double").alias("_bal"))
        env = env.select(F.when(F.col("_bal") < 0, F.substring(text, 1, 40)).otherwise(text).alias("value"))
    return fx.order_envelopes(orders, fx.orders_spec(orders), **kw).unionByName(env)


@register("route_by_op", """
select case o_orderpriority when '1-URGENT' then 'I' when '2-HIGH' then 'U' else 'D' end as op_type, count(*) as n
from orders group by 1""")
def route_by_op_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes by op type, in one pass."""
    orders = fx.table(spark, sf_dir, "orders")
    env = split_bad(parse_envelope(fx.order_envelopes(orders, fx.orders_spec(orders), priorities=None)))[0]
    return env.where(F.col("op_type").isin("I", "U", "D")).groupBy("op_type").agg(F.count(F.lit(1)).alias("n"))


# ---- projections, renames, unions, joins, dedupe on whole tables -------------------------

@register("project_drop", "select o_orderkey, o_orderstatus, o_totalprice from orders")
def project_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    return orders.drop("o_custkey", "o_orderdate", "o_orderpriority")


@register("project_data_columns", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderpriority <> '1-URGENT'""")
def project_data_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dynamic projection by the target's data columns (audit columns excluded by exact name)."""
    target = fx.order_target(fx.table(spark, sf_dir, "orders"))
    return target.select(*[F.col(c) for c in data_columns(target)])


@register("rename_prefix", """
select o_orderkey as renamed_o_orderkey, o_custkey as renamed_o_custkey, o_orderstatus as renamed_o_orderstatus,
       o_totalprice as renamed_o_totalprice, o_orderdate as renamed_o_orderdate, o_orderpriority as renamed_o_orderpriority
from orders""")
def rename_prefix_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_prefix(fx.table(spark, sf_dir, "orders"), "renamed_")


@register("union_by_name", """
select o_orderkey, o_orderdate as INSERT_DATE, o_orderdate as UPDATE_DATE from orders where o_orderstatus = 'F'
union all
select o_orderkey, o_orderdate as INSERT_DATE, timestamp '2024-01-01 00:00:00' as UPDATE_DATE from orders where o_orderstatus <> 'F'""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union by name: the two sides list the audit columns in opposite order."""
    orders = fx.table(spark, sf_dir, "orders")
    a = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", F.col("o_orderdate").alias("INSERT_DATE"), F.col("o_orderdate").alias("UPDATE_DATE"))
    b = orders.where(F.col("o_orderstatus") != "F").select(
        "o_orderkey", F.lit(fx.AS_OF).cast("timestamp_ntz").alias("UPDATE_DATE"), F.col("o_orderdate").alias("INSERT_DATE"))
    return a.unionByName(b)


@register("join_composite_key", """
select l.l_orderkey, l.l_linenumber, l.l_quantity, r.l_partkey
from lineitem l join (select distinct l_orderkey, l_linenumber, l_partkey from lineitem where l_returnflag = 'R') r
  using (l_orderkey, l_linenumber)""")
def join_composite_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner join USING a composite key (existence test against a set of keys)."""
    li = fx.table(spark, sf_dir, "lineitem")
    r = li.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    return join_composite_key(li.select("l_orderkey", "l_linenumber", "l_quantity"), r, ["l_orderkey", "l_linenumber"])


@register("dedupe_composite", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate
from (select *, row_number() over (partition by l_orderkey, l_linenumber
                                   order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc) rn
      from lineitem) where rn = 1""")
def dedupe_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic dedupe on a non-unique composite key: partial + final aggregation."""
    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return dedupe(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"])
