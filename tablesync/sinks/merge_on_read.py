"""Merge-on-read target store: a batch writes its changes only; readers fold them over the base, compaction rewrites.

The base is split by key into ``buckets`` folders. A batch of n changed keys appends a folder of n rows, sorted by bucket, in as many files
as their size asks for; no base file is read unless rows move between keys. ``compact`` rewrites the buckets that
changes have touched, every ``compact_after`` batches.

``order="arrival"``: a batch writes its net changes (one row per key); a reader applies a key's rows, at most one per
batch since the compaction, in the order of the batches. The result is that of merging batch by batch.

``order="log"``: a batch writes its change events; a reader applies all of them by their position in the log, so the rows,
INSERT_DATEs of moved rows included, do not depend on how the events fall into batches or in which order batches come.
Events stay until they are ``lateness`` seconds older than the newest one; compaction then folds them into the base. An
event that comes after its time was folded cannot be put in its place any more: it goes to ``late``.

For each bucket the log keeps the least purge date; a scheduled purge rewrites only the buckets that can hold an expired
row, and the log keeps its time. Files keep the schema they were written with: a column whose declared type has changed is
cast when read (NULL where a value does not convert) and rewritten with its bucket. Key columns keep their type.

See ``versions`` for the log, its checkpoints, group commits (``commit``) and reader leases (``pinned``).
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import micros
from ..operators.changes import OP_DELETE, OP_INSERT, apply_changes, as_of_column, net_changes, seq_text
from ..operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS
from ..operators.retention import Purge
from ..schema import INSERT_DATE, UPDATE_DATE, TargetSpec
from .versions import VersionLog

BUCKET = "_bucket"
PART = "_part"
VERSION = "_version"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``: by name, missing ones NULL, other types cast where they convert."""
    return df.select(*[_as_type(F.col(f.name), df.schema[f.name].dataType if f.name in df.columns else None, f.dataType).alias(f.name) for f in schema.fields])


def _as_type(c: Column, given: T.DataType | None, wanted: T.DataType) -> Column:
    if given is None:
        return F.lit(None).cast(wanted)
    if given == wanted:
        return c
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        fields = [_as_type(c[f.name], given[f.name].dataType if f.name in given.fieldNames() else None, f.dataType).alias(f.name) for f in wanted.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c.try_cast(wanted)


class MergeOnReadStore:
    def __init__(self, spark: SparkSession, root: str, spec: TargetSpec, buckets: int = 64, fmt: str = "orc", files_per_bucket: int = 1,
                 order: str = "arrival", lateness: float = 3600.0, date_column: str = UPDATE_DATE, compact_after: int = 16, checkpoint_every: int = 64):
        if order not in ("arrival", "log"):
            raise ValueError(f"order must be 'arrival' or 'log', not {order!r}")
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self.schema = spec.table_schema
        self.buckets, self.fmt, self.files_per_bucket = buckets, fmt, files_per_bucket
        self.order, self.lateness, self.date_column, self.compact_after = order, lateness, date_column, compact_after
        self.log = VersionLog(spark, self.root, checkpoint_every)
        self._now: dict | None = None
        self._prepared: tuple | None = None

    # -- state -----------------------------------------------------------------------
    def _empty(self) -> dict:
        return {"version": 0, "buckets": self.buckets, "base": {}, "deltas": [], "schemas": [], "batches": {}, "purged_at": None, "newest": None, "folded": None}

    def state(self, visible: set[str] | None = None) -> dict:
        """What the log says now; read once, since the store object that writes is the table's only writer."""
        if self._now is None:
            self._open(self.log.load(self._empty(), self._fold, visible))
        return self._now

    def _open(self, state: dict) -> None:
        if state["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {state['buckets']} buckets, not {self.buckets}")
        for old in map(T.StructType.fromJson, state["schemas"]):
            if any(old[k].dataType != self.schema[k].dataType for k in self.spec.keys):
                raise ValueError(f"the key columns of {self.root} were written with other types")
        self._now = state

    def refresh(self, visible: set[str] | None = None) -> MergeOnReadStore:
        """Read the log anew, as a reader does; ``visible``: see ``versions.CommitLog.tokens``."""
        self._now = None
        self.state(visible)
        return self

    @staticmethod
    def _fold(state: dict, entry: dict) -> dict:
        state = {**state, "version": entry["version"]}
        state["base"] = state["base"] | {b: x for b, x in entry.get("base", {}).items()}
        state["schemas"] = state["schemas"] + entry.get("schemas", [])
        state["deltas"] = state["deltas"] + ([entry["delta"]] if entry.get("delta") else [])
        for key in ("purged_at", "folded"):
            state[key] = entry.get(key) or state[key]
        state["newest"] = max(filter(None, (state["newest"], (entry.get("delta") or {}).get("newest"))), default=None)
        if entry.get("batch"):
            stream, batch_id = entry["batch"]
            state["batches"] = state["batches"] | {stream: max(batch_id, state["batches"].get(stream, batch_id))}
        through = lambda b: state["base"].get(b, {}).get("through", 0)
        state["deltas"] = [d for d in state["deltas"] if (d["newest"] > state["folded"] if state["folded"] and d["newest"] else any(through(b) < d["version"] for b in d["least"]))]
        return state

    def _append(self, entry: dict, commit: str | None = None, then: Callable[[], None] | None = None) -> None:
        if commit:
            self.log.append(entry | {"commit": commit})
            self._prepared = (entry, then)
            return
        self.log.append(entry)
        self._advance(entry, then)

    def _advance(self, entry: dict, then: Callable[[], None] | None) -> None:
        self._now = self._fold(self.state(), entry)
        self.log.keep(self._now)
        if then:
            then()

    def finish(self) -> None:
        """After the job's commit: the prepared version is current; do the upkeep that waited for it."""
        if self._prepared:
            prepared, self._prepared = self._prepared, None
            self._advance(*prepared)

    def has_batch(self, batch_id: int, stream: str = "") -> bool:
        return batch_id <= self.state()["batches"].get(stream, batch_id - 1)

    def last_purge(self) -> float:
        return self.state()["purged_at"] or float("-inf")

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.spec.key_cols]), F.lit(self.buckets)).cast("int")

    def _schema_id(self, state: dict) -> tuple[int, list]:
        """(number of the declared schema, what the log must add for it)."""
        own = self.schema.jsonValue()
        if own in state["schemas"]:
            return state["schemas"].index(own), []
        return len(state["schemas"]), [own]

    # -- reading ---------------------------------------------------------------------
    def _base(self, buckets: list[int] | None) -> DataFrame:
        state = self.state()
        groups: dict[int, list[str]] = {}
        for b, x in state["base"].items():
            if x["path"] and (buckets is None or int(b) in buckets):
                groups.setdefault(x["schema"], []).append(x["path"])
        parts = [conform(self.spark.read.schema(T.StructType.fromJson(state["schemas"][n])).format(self.fmt).load(sorted(paths)), self.schema) for n, paths in sorted(groups.items())]
        return functools.reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def _changes(self, buckets: list[int] | None, folded: bool = False) -> tuple[DataFrame | None, list[dict]]:
        """The rows of the live deltas; in log order, those after the folded time (``folded``: those up to it)."""
        state = self.state()
        wanted = None if buckets is None else set(buckets)
        live = [d for d in state["deltas"] if wanted is None or any(int(b) in wanted for b in d["least"])]
        if not live:
            return None, []
        parts = [conform(self.spark.read.schema(T.StructType.fromJson(d["schema"])).parquet(d["path"]), self._delta_schema(d)) for d in live]
        rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if wanted is not None:
            rows = rows.where(F.col(BUCKET).isin(*sorted(wanted)))
        if self.order == "log":
            if state["folded"] is not None:
                rows = rows.where(F.coalesce(micros(F.col("_seq.ts"), T.TimestampNTZType()) > state["folded"], F.lit(False)))
        elif any(x["through"] >= d["version"] for d in live for b, x in state["base"].items() if b in d["least"]):
            done = [(int(b), x["through"]) for b, x in state["base"].items()]  # at most one row per bucket
            rows = rows.join(F.broadcast(self.spark.createDataFrame(done, f"{BUCKET} int, _through long")), BUCKET, "left")
            rows = rows.where(F.col(VERSION) > F.coalesce("_through", F.lit(0))).drop("_through")
        return rows, live

    def _delta_schema(self, delta: dict) -> T.StructType:
        """The columns of a delta's file, with the image (and audit dates) as declared now."""
        kinds = {"_image": self.spec.data_schema, "_img": self.spec.data_schema}
        return T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in T.StructType.fromJson(delta["schema"]).fields])

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The table, or only the given buckets of it."""
        base = self._base(buckets)
        rows, live = self._changes(buckets)
        if rows is None:
            return base
        small = sum(d["rows"] for d in live) <= DEFAULT_BROADCAST_ROWS and sum(d["bytes"] or 0 for d in live) <= DEFAULT_BROADCAST_BYTES
        if self.order == "log":
            return self._in_log_order(base, rows, live, small)
        return self._in_order_of_arrival(base, rows, small)

    def _in_log_order(self, base: DataFrame, events: DataFrame, live: list[dict], small: bool) -> DataFrame:
        modes = {d["mode"] for d in live}
        return apply_changes(base, events.drop(BUCKET, VERSION), self.spec, insert_mode=modes.pop() if len(modes) == 1 else "replace",
                             strategy="broadcast" if small else "general", key_changes=any(d["moves"] for d in live))

    def _in_order_of_arrival(self, base: DataFrame, rows: DataFrame, small: bool) -> DataFrame:
        keys, names = self.spec.key_cols, self.schema.fieldNames()
        folded = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*[c for c in rows.columns if c not in (*keys, BUCKET)])), _by_version).alias("_d"))
        own = F.struct(*[F.col(c).alias(c) for c in names], F.col("_here"))
        start = F.struct(*[(F.col(c) if c in self.spec.keys else F.when(F.col("_here"), F.col(c))).alias(c) for c in names], F.coalesce("_here", F.lit(False)).alias("_here"))
        after = F.filter(F.array(F.aggregate("_d", start, self._step)), lambda x: x["_here"])
        out = F.inline(F.when(F.col("_d").isNull(), F.array(own)).otherwise(after))
        base = base.withColumn("_here", F.lit(True))
        if not small:
            return base.join(folded, keys, "full_outer").select(out).select(*names)
        # A small set of changes: the base is not shuffled, and read once more for its keys only.
        kept = base.join(F.broadcast(folded), keys, "left").select(out)
        hits = base.select(*keys).join(F.broadcast(folded), keys, "left_semi")
        new = folded.join(F.broadcast(hits), keys, "left_anti")
        new = new.select(*keys, *[F.lit(None).cast(self.schema[c].dataType).alias(c) for c in names if c not in keys], F.lit(None).cast("boolean").alias("_here"), "_d")
        return kept.unionByName(new.select(out)).select(*names)

    def _step(self, s: Column, d: Column) -> Column:
        """A row after one more net change; ``_here`` tells whether it is there (as a row or a tombstone)."""
        spec = self.spec
        expired = F.coalesce(micros(s[self.date_column], self.schema[self.date_column].dataType) <= d["_cutoff"], F.lit(False))
        here = s["_here"] & ~expired
        present = here & ~F.coalesce(s[spec.tombstone], F.lit(False)) if spec.tombstone else here
        stale = (lambda pos: F.coalesce(here & (s[spec.seq_column] > pos), F.lit(False))) if spec.seq_column else (lambda pos: F.lit(False))
        fresh = d["_fresh"] & ~stale(d["_del_pos"])
        keep = stale(d["_pos"]) | (d["_only_new"] & present & ~fresh)
        gone = d["_op"] == OP_DELETE
        out = [(s[c] if c in spec.keys else F.when(keep, s[c]).otherwise(d["_image"][c])).alias(c) for c in spec.data_cols]
        out.append(F.when(keep, s[INSERT_DATE]).otherwise(F.coalesce(F.when(present & ~fresh, s[INSERT_DATE]), d["_carry"], d["_at"])).alias(INSERT_DATE))
        out.append(F.when(keep, s[UPDATE_DATE]).otherwise(d["_at"]).alias(UPDATE_DATE))
        if spec.seq_column:
            out.append(F.when(keep, s[spec.seq_column]).otherwise(d["_pos"]).alias(spec.seq_column))
        if spec.tombstone:
            out.append(F.when(keep, F.coalesce(s[spec.tombstone], F.lit(False))).otherwise(gone).alias(spec.tombstone))
        return F.struct(*out, F.when(keep, here).otherwise(~gone | F.lit(bool(spec.tombstone))).alias("_here"))

    @contextmanager
    def pinned(self, hours: float = 24.0) -> Iterator[DataFrame]:
        """The table as it is now, for a slow reader: its files stay for ``hours``, whatever is compacted and vacuumed meanwhile."""
        with self.log.lease(self._paths(), hours):
            yield self.read()

    def _paths(self) -> list[str]:
        state = self.state()
        return sorted([x["path"] for x in state["base"].values() if x["path"]] + [d["path"] for d in state["deltas"]])

    # -- writing ---------------------------------------------------------------------
    def _write_base(self, df: DataFrame, buckets: list[int], version: int, schema_id: int) -> dict:
        path = f"{self.root}/base/v={version}"
        out = df.select(*self.schema.fieldNames()).withColumn(BUCKET, self.bucket_of())
        part = F.pmod(F.xxhash64(*[F.col(k) for k in self.spec.key_cols], F.lit(1)), F.lit(self.files_per_bucket))
        out = out.withColumn(PART, part).hint("rebalance", F.col(BUCKET), F.col(PART)).drop(PART)
        out.write.mode("overwrite").partitionBy(BUCKET).format(self.fmt).save(path)
        # Reads one column of what was written; at most one row per bucket reaches the driver.
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).format(self.fmt).load(path)
        least = F.min(micros(F.col(self.date_column), self.schema[self.date_column].dataType))
        found = {r[BUCKET]: r for r in written.groupBy(BUCKET).agg(least.alias("least"), F.count(F.lit(1)).alias("rows")).collect()}
        entry = lambda b: {"path": f"{path}/{BUCKET}={b}" if b in found else None, "least": found[b]["least"] if b in found else None, "rows": found[b]["rows"] if b in found else 0}
        return {str(b): entry(b) | {"through": version, "schema": schema_id} for b in sorted(buckets)}

    def publish(self, df: DataFrame, batch_id: int, stream: str = "") -> dict:
        """Replace the whole table."""
        state = self.state()
        number, added = self._schema_id(state)
        version = state["version"] + 1
        entry = {"version": version, "batch": [stream, batch_id], "schemas": added, "folded": state["newest"]}
        self._append(entry | {"base": self._write_base(df, list(range(self.buckets)), version, number)})
        return {"version": version, "buckets": self.buckets, "batch_id": batch_id}

    def apply(self, changes: DataFrame, spec: TargetSpec, as_of, batch_id: int, pre: Callable[[DataFrame], DataFrame] | None = None, full_pre: bool = False,
              stream: str = "", commit: str | None = None, insert_mode: str = "replace", strategy: str = "auto", key_changes: bool | None = None,
              rebirths: bool | None = None, at: float | None = None) -> dict:
        """Add a batch of changes. ``pre`` (a purge) takes expired rows away before their key's change, and
        with ``full_pre`` all expired rows; ``at`` is the time to remember for it. With ``commit`` the version is prepared only, see ``finish``."""
        state = self.state()
        version = state["version"] + 1
        if key_changes is None:
            key_changes = not changes.where(F.col("_prev").isNotNull()).isEmpty()
        time = as_of_column(as_of, self.spec.audit_type)
        if self.order == "log":
            rows = self._without_late(changes, version).withColumn("_at", time)
        else:
            rows = self._net_rows(changes, time, pre, insert_mode, key_changes, rebirths)
        delta = self._write_delta(rows, version, insert_mode, key_changes)

        def upkeep() -> None:
            if full_pre and pre is not None:
                self.purge(pre, at)
            elif len(self.state()["deltas"]) >= self.compact_after:
                self.compact()

        if delta:
            _, added = self._schema_id(state)
            self._append({"version": version, "batch": [stream, batch_id], "schemas": added, "delta": delta}, commit, upkeep)
        elif full_pre and pre is not None:
            self._append({"version": version, "batch": [stream, batch_id]}, commit, upkeep)
        return {"version": version, "rows": delta["rows"] if delta else 0, "batch_id": batch_id}

    def _net_rows(self, changes: DataFrame, time: Column, pre, insert_mode: str, key_changes: bool, rebirths: bool | None) -> DataFrame:
        # Only moves look at stored rows, of the buckets that the batch touches.
        target = self.read(self._touched(changes)) if key_changes else self.spark.createDataFrame([], self.schema)
        net = net_changes(target, changes, self.spec.key_cols, key_changes, rebirths)
        image = F.coalesce("_upd", "_first", "_img") if insert_mode == "keep" else F.col("_img")
        only_new = (F.col("_op") == OP_INSERT) & F.col("_upd").isNull() if insert_mode == "keep" else F.lit(False)
        cutoff = F.lit(self._cutoff(pre)).cast("long")
        return net.select(*self.spec.key_cols, "_op", F.when(F.col("_op") != OP_DELETE, image).alias("_image"), only_new.alias("_only_new"), "_fresh", "_carry",
                          seq_text().alias("_pos"), F.when(F.col("_del_seq").isNotNull(), seq_text("_del_seq")).alias("_del_pos"), time.alias("_at"), cutoff.alias("_cutoff"))

    def _cutoff(self, purge) -> int | None:
        """The cutoff of a purge by the date that the log knows, of single rows; None for any other."""
        if not isinstance(purge, Purge) or (purge.column or UPDATE_DATE) != self.date_column or (purge.keys and set(purge.keys) != set(self.spec.keys)):
            return None
        return purge.cutoff(self.spark, self.schema[self.date_column].dataType)

    def _touched(self, changes: DataFrame) -> list[int]:
        return sorted(r["b"] for r in changes.select(self.bucket_of().alias("b")).distinct().collect())  # at most ``buckets``

    def _without_late(self, changes: DataFrame, version: int) -> DataFrame:
        folded = self.state()["folded"]
        if folded is None:
            return changes
        late = F.coalesce(micros(F.col("_seq.ts"), T.TimestampNTZType()) <= folded, F.lit(True))
        gone = changes.where(late)
        if not gone.isEmpty():
            gone.write.mode("overwrite").parquet(f"{self.root}/late/v={version}")
        return changes.where(~late)

    def late(self) -> DataFrame | None:
        """The events that came too late to be put in their place (None: there are none)."""
        paths = [p for p, _ in self.log.files.folders("../late/v=*")]
        return self.spark.read.parquet(*paths) if paths else None

    def _write_delta(self, rows: DataFrame, version: int, insert_mode: str, moves: bool) -> dict | None:
        path = f"{self.root}/delta/v={version}"
        out = rows.withColumn(BUCKET, self.bucket_of()).withColumn(VERSION, F.lit(version).cast("long"))
        out.repartitionByRange(BUCKET, *self.spec.key_cols).sortWithinPartitions(BUCKET).write.mode("overwrite").parquet(path)
        written = self.spark.read.schema(out.schema).parquet(path)
        image = "_img" if self.order == "log" else "_image"
        held = self.date_column not in (INSERT_DATE, UPDATE_DATE)
        date = F.when(F.col("_op") != OP_DELETE, F.col(image)[self.date_column] if held else F.col("_at"))
        kind = self.schema[self.date_column].dataType
        newest = F.max(micros(F.col("_seq.ts"), T.TimestampNTZType())) if self.order == "log" else F.lit(None).cast("long")
        found = written.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.min(micros(date, kind)).alias("least"), newest.alias("newest")).collect()
        if not found:
            return None
        rows = sum(r["rows"] for r in found)
        # Only a delta with few rows can be broadcast, so only its bytes matter.
        size = written.agg(F.sum(F.length(F.to_json(F.struct(*out.columns))))).first()[0] if rows <= DEFAULT_BROADCAST_ROWS else None
        return {"version": version, "path": path, "schema": out.schema.jsonValue(), "mode": insert_mode, "moves": bool(moves), "rows": rows,
                "bytes": size, "least": {str(r[BUCKET]): r["least"] for r in found}, "newest": max((r["newest"] for r in found if r["newest"] is not None), default=None)}

    def compact(self, buckets: list[int] | None = None) -> dict:
        """Fold the changes into the base: of all buckets they touch (or those of them in ``buckets``).

        In log order, only events older than the newest one less ``lateness`` are folded, of all buckets, since moves
        tie buckets together.
        """
        state = self.state()
        touched = sorted({int(b) for d in state["deltas"] for b in d["least"]} & set(range(self.buckets) if buckets is None or self.order == "log" else buckets))
        if not touched:
            return {"buckets": 0, "version": state["version"]}
        if self.order == "log":
            return self._fold_old_events(touched)
        return self._rewrite(touched, self.read(touched))

    def _fold_old_events(self, touched: list[int], pre=None, more: list[int] | None = None) -> dict:
        state = self.state()
        limit = (state["newest"] or 0) - int(self.lateness * 1_000_000)
        if state["folded"] is not None and limit <= state["folded"]:
            limit = state["folded"]
        events, live = self._changes(None)
        old = events.where(F.coalesce(micros(F.col("_seq.ts"), T.TimestampNTZType()) <= limit, F.lit(True))) if events is not None else None
        if old is not None and not old.isEmpty():
            buckets = sorted({r[BUCKET] for r in old.select(BUCKET).distinct().collect()} | set(more or []))
            out = self._in_log_order(self._base(buckets), old, live, False)
        elif more:
            buckets, out = more, self._base(more)
        else:
            return {"buckets": 0, "version": state["version"]}
        return self._rewrite(buckets, pre(out) if pre else out, {"folded": max(limit, state["folded"] or limit)})

    def _rewrite(self, buckets: list[int], df: DataFrame, more: dict | None = None) -> dict:
        state = self.state()
        number, added = self._schema_id(state)
        version = state["version"] + 1
        self._append({"version": version, "schemas": added, "base": self._write_base(df, buckets, version, number)} | (more or {}))
        return {"buckets": len(buckets), "version": version}

    def expirable(self, purge: Callable) -> list[int]:
        """The buckets that can hold a row that ``purge`` removes, by the least dates in the log."""
        state = self.state()
        cutoff = self._cutoff(purge)
        if cutoff is None:
            return list(range(self.buckets))
        held = [x for x in state["base"].items()] + [(b, {"path": d["path"], "least": least}) for d in state["deltas"] for b, least in d["least"].items()]
        return sorted({int(b) for b, x in held if x["path"] and x["least"] is not None and x["least"] <= cutoff})

    def purge(self, purge: Callable[[DataFrame], DataFrame], at: float | None = None) -> dict:
        """Remove all expired rows; rewrites the buckets that can hold one. In log order, rows whose events are still kept stay."""
        buckets = self.expirable(purge)
        stamp = {"purged_at": at}
        if not buckets:
            self._append({"version": self.state()["version"] + 1} | stamp)
            return {"buckets": 0, "version": self.state()["version"]}
        if self.order == "log":
            done = self._fold_old_events(buckets, purge, buckets)
            self._append({"version": self.state()["version"] + 1} | stamp)
            return done
        return self._rewrite(buckets, purge(self.read(buckets)), stamp)

    def vacuum(self, older_than_hours: float = 24.0) -> int:
        """Remove data folders that are neither current nor leased and were written more than ``older_than_hours`` ago."""
        import time

        files = self.log.files
        kept = {files.qualified(p) for p in (*self._paths(), *self.log.leased())}
        if self._prepared:
            kept |= {files.qualified(d["path"]) for d in [self._prepared[0].get("delta")] if d}
        gone = 0
        for path, changed in files.folders(f"../base/v=*/{BUCKET}=*") + files.folders("../delta/v=*"):
            if files.qualified(path) not in kept and changed <= time.time() - older_than_hours * 3600:
                gone += files.delete_path(path)
        return gone


def _by_version(a: Column, b: Column) -> Column:
    return F.when(a[VERSION] < b[VERSION], -1).when(a[VERSION] > b[VERSION], 1).otherwise(0)
