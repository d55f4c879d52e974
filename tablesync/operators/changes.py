"""Collapse change events to one net change per key, and merge them into a target table.


* the latest event per key wins, ordered by (op_ts, pos, source position);
* an update whose key matches a row replaces it (INSERT_DATE kept, UPDATE_DATE = as_of);
  an update whose key matches nothing is inserted; the decision is made per row;
* an insert on an existing key replaces the row (``insert_mode="replace"``, INSERT_DATE kept)
  or leaves it (``"keep"``);
* a delete removes the key; a delete of an absent key does nothing;
* with a sequence column in the target, a change older than the stored row is ignored;
* a key-changing update deletes the old key and upserts the new one; where the new key holds no
  row, INSERT_DATE comes over from the old row, through any chain of moves of the batch;
* a delete ends a life of its key: what comes after starts a new one with a new INSERT_DATE;
* one batch gives the same rows as its events applied one after the other.

A change may carry its own audit time ``_at`` (events of several batches merged at once); without it, all have the merge's.

All of it is set-based: there is no driver-side branch on data except cheap emptiness checks.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import INSERT_DATE, OP_DELETE, OP_INSERT, OP_UPDATE, UPDATE_DATE, TargetSpec
from ..session import checkpoint_root
from .joins import DEFAULT_BROADCAST_ROWS, fits_broadcast, sized

HOT_KEY_EVENTS = 1_000_000  # of one key, that one task still sorts

CHANGE_COLS = ("_op", "_seq", "_img", "_prev")
NET_COLS = ("_op", "_seq", "_img", "_first", "_upd", "_fresh", "_del_seq", "_carry", "_last_at", "_born")


def as_of_column(as_of, dtype) -> Column:
    """The audit timestamp of a merge, as a column of the target's audit type."""
    if as_of is None:
        return F.current_timestamp().cast(dtype)
    if isinstance(as_of, Column):
        return as_of.cast(dtype)
    return F.lit(str(as_of)).cast(dtype)


def utc_column(epoch_seconds: float, dtype) -> Column:
    """An instant as the audit type: a timestamp holds the instant, other types its UTC wall clock."""
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_seconds(F.lit(epoch_seconds))
    return F.lit(time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(epoch_seconds))).cast(dtype)


def collapse_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the change with the greatest ``_seq``.

    ``max_by`` is an ordinary aggregate, so Spark combines map-side before the shuffle: a key
    that holds a third of the batch is reduced to one row per task, not sorted in one task.
    Payload and order are wrapped in structs so NULLs inside them survive.
    """
    payload = [c for c in changes.columns if c not in keys]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.col("_seq")).alias("_c")).select(*keys, "_c.*")


def _keys_as(keys: list[str], name: str, prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{k}").alias(k) for k in keys]).alias(name)


def has_rebirths(changes: DataFrame, keys: list[str]) -> bool:
    """Whether a key has a change after a delete of it (reads keys, ops and positions only)."""
    last = changes.groupBy(*keys).agg(F.max(F.when(F.col("_op") == OP_DELETE, F.col("_seq"))).alias("d"), F.max("_seq").alias("s"))
    return not last.where(F.col("d") < F.col("s")).isEmpty()


def _lives(events: DataFrame) -> DataFrame:
    """Adds ``_life``, how many deletes of the key came before the event.

    A window per key, unless some key has more than ``HOT_KEY_EVENTS`` events (a key used as a swap slot, say): then the
    events are dealt out by ranges of key and position, and a range adds the deletes of the ranges before it.
    """
    gone = (F.col("_op") == OP_DELETE).cast("long")
    before = Window.partitionBy("_k").orderBy("_seq", "_moved").rowsBetween(Window.unboundedPreceding, -1)
    if events.groupBy("_k").count().where(F.col("count") > HOT_KEY_EVENTS).isEmpty():
        return events.withColumn("_life", F.coalesce(F.sum(gone).over(before), F.lit(0).cast("long")))
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = events.repartitionByRange(n, "_k", "_seq", "_moved").withColumn("_range", F.spark_partition_id()).checkpoint()
    inside = Window.partitionBy("_k", "_range").orderBy("_seq", "_moved").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy("_k", "_range").agg(F.sum(gone).alias("_gone"))
    earlier = F.sum("_gone").over(Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # a row per range
    ranges = ranges.select("_k", "_range", F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    own = dealt.withColumn("_own", F.coalesce(F.sum(gone).over(inside), F.lit(0)))
    return own.join(ranges, ["_k", "_range"]).withColumn("_life", F.col("_own") + F.col("_earlier")).drop("_own", "_earlier", "_range")


def _lineage(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """(_from, _at, _carry): INSERT_DATE of the row that a move at position ``_at`` took from key ``_from``.

    A key's deletes cut its events into lives. Every life is one node; a life whose first event is a move points at the
    life that the move ended, found by an equi-join on (old key, position). A first life ends the
    search where the target has the key. Pointers are doubled until all are resolved, so a chain of n moves takes
    log2(n) rounds of joins over the moved keys only. The joins are sort-merge ones where their sides are not known to be small.
    """
    checkpoint_root(target.sparkSession)
    moves = changes.where((F.col("_op") != OP_DELETE) & F.col("_prev").isNotNull())
    involved = sized(moves.select(F.explode(F.array(_keys_as(keys, "_k"), F.col("_prev"))).alias("_k")).distinct().checkpoint())
    audit = target.schema[INSERT_DATE].dataType
    when = F.col("_at") if "_at" in changes.columns else F.lit(None).cast(audit)
    events = changes.select(_keys_as(keys, "_k"), "_op", "_seq", "_prev", "_moved", when.alias("_time")).distinct().join(involved, "_k")
    events = _lives(events.checkpoint()).checkpoint()
    births = events.where(F.col("_op") != OP_DELETE).groupBy("_k", "_life").agg(F.min_by(F.struct("_prev", "_seq", "_time"), "_seq").alias("_b"))
    left = events.where("_moved").select(F.col("_k").alias("_from"), F.col("_seq").alias("_at"), F.col("_life").alias("_left"))
    nodes = births.select("_k", "_life", F.col("_b._prev").alias("_from"), F.col("_b._seq").alias("_at"), F.col("_b._time").alias("_born"))
    nodes = nodes.join(left.hint("merge"), ["_from", "_at"], "left").select("_k", "_life", "_born", F.when(F.col("_from").isNotNull(), F.struct(F.col("_from").alias("k"), F.col("_left").alias("life"))).alias("_up"))
    # lives that a move ended without an event of their own are nodes too
    nodes = nodes.join(left.select(F.col("_from").alias("_k"), F.col("_left").alias("_life")).distinct().hint("merge"), ["_k", "_life"], "full_outer")
    dates = target.select(_keys_as(keys, "_k"), F.col(INSERT_DATE).alias("_date"), F.lit(True).alias("_there")).join(involved, "_k").withColumn("_life", F.lit(0).cast("long"))
    nodes = nodes.join(dates.hint("merge"), ["_k", "_life"], "left")
    # ``_born`` is the time of the first event of the topmost life known so far: the date where no row was there before
    nodes = nodes.select("_k", "_life", F.when(F.col("_there").isNull(), F.col("_up")).alias("_up"), "_date", "_born").checkpoint()
    while not nodes.where(F.col("_up").isNotNull()).isEmpty():
        above = nodes.select(F.struct(F.col("_k").alias("k"), F.col("_life").alias("life")).alias("_up"), F.col("_up").alias("_next"), F.col("_date").alias("_above"), F.col("_born").alias("_before"))
        nodes = nodes.join(above.hint("merge"), "_up", "left").select("_k", "_life", F.col("_next").alias("_up"), F.coalesce("_date", "_above").alias("_date"), F.coalesce("_before", "_born").alias("_born")).checkpoint()
    found = nodes.select(F.col("_k").alias("_from"), F.col("_life").alias("_left"), F.coalesce("_date", "_born").alias("_carry"))
    return left.join(found.hint("merge"), ["_from", "_left"]).select("_from", "_at", "_carry")


def net_changes(target: DataFrame, changes: DataFrame, keys: list[str], key_changes: bool | None = None, rebirths: bool | None = None) -> DataFrame:
    """One row per key with what its events amount to.

    Besides the last event (``_op``, ``_seq``, ``_img``): ``_first`` and ``_upd``, the images of the first event and the last update of the
    key's last life; ``_fresh``, whether a delete (at ``_del_seq``) came before that life; ``_carry``, the INSERT_DATE
    that its first event brought along. Aggregations combine before the shuffle; keys with changes after a
    delete, and moved keys, take a second look, which is skipped when the batch has none (``key_changes`` and
    ``rebirths``; None: checked). The looks join images with hints: by its estimate of their size, which goes by the files
    read, Spark would broadcast all of a large batch.
    """
    if key_changes is None:
        key_changes = not changes.where(F.col("_prev").isNotNull()).isEmpty()
    if rebirths is None:
        rebirths = has_rebirths(changes, keys)
    audit = target.schema[INSERT_DATE].dataType
    changes = changes if "_at" in changes.columns else changes.withColumn("_at", F.lit(None).cast(audit))
    event = F.struct("_img", "_prev", "_seq", "_at")
    is_del = F.col("_op") == OP_DELETE
    birth = F.min_by(event, F.when(~is_del, F.col("_seq"))).alias("_birth")
    update = F.max_by(F.struct("_img"), F.when(F.col("_op") == "U", F.col("_seq"))).alias("_u")
    last = F.max_by(F.struct("_op", "_seq", "_img", "_at"), "_seq").alias("_l")
    net = changes.groupBy(*keys).agg(last, birth, update, F.max(F.when(is_del, F.col("_seq"))).alias("_del_seq"))
    reborn = F.col("_del_seq").isNotNull() & (F.col("_l._op") != OP_DELETE)
    if rebirths:
        since = net.where(reborn).select(*keys, F.col("_del_seq").alias("_since"))
        alive = changes.join(since.hint("merge"), keys).where(F.col("_seq") > F.col("_since")).groupBy(*keys).agg(birth.alias("_birth2"), update.alias("_u2"))
        net = net.join(alive.hint("merge"), keys, "left").withColumn("_birth", F.coalesce("_birth2", "_birth")).withColumn("_u", F.when(F.col("_birth2").isNotNull(), F.col("_u2")).otherwise(F.col("_u")))
    net = net.select(*keys, "_l._op", "_l._seq", "_l._img", F.col("_l._at").alias("_last_at"), F.col("_birth._at").alias("_born"), F.col("_birth._img").alias("_first"), F.col("_u._img").alias("_upd"), F.coalesce(reborn, F.lit(False)).alias("_fresh"), "_del_seq",
                     F.col("_birth._prev").alias("_from"), F.col("_birth._seq").alias("_at"))
    if key_changes:
        net = net.join(_lineage(target, changes, keys).hint("merge"), ["_from", "_at"], "left")
    else:
        net = net.withColumn("_carry", F.lit(None).cast(audit))
    return net.select(*keys, *NET_COLS)


def latest_by(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Latest row per key by ``order_cols`` (later columns break ties), all columns kept."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def dedupe(df: DataFrame, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """Drop duplicate keys deterministically: the survivor has the greatest ``order_cols``
    (all non-key columns when not given)."""
    order_cols = order_cols or [c for c in df.columns if c not in keys]
    return latest_by(df, keys, order_cols).select(*df.columns)


# Fixed value: text form of a change position, ordered like (op_ts, pos) for zero-padded pos.
SEQ_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def seq_text(seq: str = "_seq") -> Column:
    """The change position as comparable text: 'op_ts|pos'."""
    ts = F.coalesce(F.date_format(F.col(f"{seq}.ts"), SEQ_TEXT_FORMAT), F.lit(""))
    return F.concat(ts, F.lit("|"), F.coalesce(F.col(f"{seq}.pos"), F.lit("")))


def _stale(spec: TargetSpec, seq: str = "_seq") -> Column:
    """The stored row (or tombstone) is newer than the change (only with a sequence column)."""
    if not spec.seq_column:
        return F.lit(False)
    stored = F.col(spec.seq_column)
    return F.coalesce(F.col("_t").isNotNull() & (stored > seq_text(seq)), F.lit(False))


def _present(spec: TargetSpec) -> Column:
    """The target holds a row of the key, not only its tombstone."""
    here = F.col("_t").isNotNull()
    return here & ~F.coalesce(F.col(spec.tombstone), F.lit(False)) if spec.tombstone else here


def _new_image(insert_mode: str) -> Column:
    return F.coalesce("_upd", "_first", "_img") if insert_mode == "keep" else F.col("_img")


def _merged(spec: TargetSpec, as_of: Column, insert_mode: str) -> list[Column]:
    """Projection of a (target ⟗ net changes) row to the target schema."""
    op, present = F.col("_op"), _present(spec)
    fresh = F.col("_fresh") & ~_stale(spec, "_del_seq")  # a delete before the change that the row has not outlived
    keep_old = op.isNull() | _stale(spec)
    if insert_mode == "keep":
        keep_old = keep_old | ((op == OP_INSERT) & present & ~fresh & F.col("_upd").isNull())
    image, gone = _new_image(insert_mode), op == OP_DELETE
    out = []
    for c in spec.data_cols:
        if c in spec.keys:
            out.append(F.col(c))
        else:
            out.append(F.when(keep_old, F.col(c)).otherwise(image[c]).alias(c))
    kept_date = F.when(present & ~fresh, F.col(INSERT_DATE))
    out.append(F.when(keep_old, F.col(INSERT_DATE)).otherwise(F.coalesce(kept_date, F.col("_carry"), F.col("_born"), as_of)).alias(INSERT_DATE))
    out.append(F.when(keep_old, F.col(UPDATE_DATE)).otherwise(F.coalesce(F.col("_last_at"), as_of)).alias(UPDATE_DATE))
    if spec.seq_column:
        out.append(F.when(keep_old, F.col(spec.seq_column)).otherwise(seq_text()).alias(spec.seq_column))
    if spec.tombstone:
        out.append(F.when(keep_old, F.coalesce(F.col(spec.tombstone), F.lit(False))).otherwise(gone).alias(spec.tombstone))
    return out


def _survives(spec: TargetSpec) -> Column:
    """No change, not a delete, or a delete older than the stored row; with tombstones all rows stay."""
    if spec.tombstone:
        return F.lit(True)
    return F.col("_op").isNull() | (F.col("_op") != OP_DELETE) | _stale(spec)


def live_rows(df: DataFrame, spec: TargetSpec) -> DataFrame:
    """The rows of a target without tombstones and bookkeeping columns."""
    if spec.tombstone:
        df = df.where(~F.col(spec.tombstone))
    return df.select(*spec.data_cols, INSERT_DATE, UPDATE_DATE)


def merge_changes(
    target: DataFrame,
    net: DataFrame,
    spec: TargetSpec,
    as_of=None,
    insert_mode: str = "replace",
    strategy: str = "auto",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Merge net changes (``net_changes``: one row per key) into ``target``; returns the new table.

    strategy:
      * ``"general"``: target FULL OUTER JOIN changes; both sides hash-partitioned on the key
        (the changes side already is, by the aggregation), so only the target is shuffled.
      * ``"broadcast"``: for a change batch of bounded size. The target is never shuffled:
        kept and updated rows come from target LEFT JOIN broadcast(changes); new keys are the
        changes minus target keys found by a key-only semi join against the broadcast keys.
      * ``"auto"``: broadcast when the net changes are within ``max_broadcast_rows`` rows and
        ``joins.DEFAULT_BROADCAST_BYTES`` bytes, else general.
    """
    if insert_mode not in ("replace", "keep"):
        raise ValueError(f"insert_mode must be 'replace' or 'keep', not {insert_mode!r}")
    keys = spec.key_cols
    as_of_c = as_of_column(as_of, spec.audit_type)
    tgt = target.select(*spec.table_schema.fieldNames()).withColumn("_t", F.lit(True))
    chg = net.select(*keys, *NET_COLS)
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(chg, max_broadcast_rows) else "general"
    if strategy == "general":
        return tgt.join(chg, keys, "full_outer").where(_survives(spec)).select(*_merged(spec, as_of_c, insert_mode))
    if strategy != "broadcast":
        raise ValueError(f"unknown merge strategy {strategy!r}")
    kept = tgt.join(F.broadcast(chg), keys, "left").where(_survives(spec)).select(*_merged(spec, as_of_c, insert_mode))
    # The same broadcast as above (one exchange, reused), probed with the target's key column only.
    hits = tgt.select(*keys).join(F.broadcast(chg), keys, "left_semi")
    new = chg.join(F.broadcast(hits), keys, "left_anti")
    if not spec.tombstone:
        new = new.where(F.col("_op") != OP_DELETE)
    image = _new_image(insert_mode)
    inserted = new.select(
        *[F.col(c) if c in spec.keys else image[c].alias(c) for c in spec.data_cols],
        F.coalesce(F.col("_carry"), F.col("_born"), as_of_c).alias(INSERT_DATE),
        F.coalesce(F.col("_last_at"), as_of_c).alias(UPDATE_DATE),
        *([seq_text().alias(spec.seq_column)] if spec.seq_column else []),
        *([(F.col("_op") == OP_DELETE).alias(spec.tombstone)] if spec.tombstone else []),
    )
    return kept.unionByName(inserted)


def of_ops(changes: DataFrame, ops: list[str]) -> DataFrame:
    """The changes of some op types. The delete of a moved row's old key belongs to the update that moved it."""
    own = F.col("_op").isin(*ops) & ~F.col("_moved")
    return changes.where(own | (F.col("_moved") & F.lit(OP_UPDATE in ops)))


def apply_changes(target: DataFrame, changes: DataFrame, spec: TargetSpec, op_type: str | list[str] | None = None,
                  as_of=None, insert_mode: str = "replace", strategy: str = "auto",
                  key_changes: bool | None = None, rebirths: bool | None = None) -> DataFrame:
    """Apply the changes of one op type (or some, or all) to ``target`` in log order: net change per key, then one merge."""
    if op_type is not None:
        changes = of_ops(changes, [op_type] if isinstance(op_type, str) else list(op_type))
    net = net_changes(target, changes, spec.key_cols, key_changes, rebirths)
    return merge_changes(target, net, spec, as_of, insert_mode, strategy)


def apply_phases(target: DataFrame, changes: DataFrame, spec: TargetSpec, op_order: list[str],
                 as_of=None, insert_mode: str = "replace", strategy: str = "auto",
                 key_changes: bool | None = None, rebirths: bool | None = None) -> DataFrame:
    """Phased application: one op type per phase in plan order, each phase on the previous result.

    The phases, not the log, order changes of different type; a plan-driven sync uses ``apply_changes`` with the
    plan's op types instead, which keeps log order and merges once.
    """
    out = target
    for op in op_order:
        moves = key_changes and op == OP_UPDATE if key_changes is not None else None
        out = apply_changes(out, changes, spec, op, as_of, insert_mode, strategy, moves, rebirths)
    return out
