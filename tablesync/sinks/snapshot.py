"""Slot snapshot store for file targets, with a version log that is also the batch ledger.

Layout under ``root``: ``slot=a/``, ``slot=b/`` (more with ``slots``) hold whole snapshots (ORC); ``_log/`` is
an append-only Parquet table with one row per publish (version, slot, stream, batch id, rows, time).
A publish writes the oldest slot in full, then appends its log row; readers take the slot of
the highest version. A crash between the two leaves the log pointing at the current, intact
slot, and the next publish simply rewrites the slot. The snapshot being read is never
the one being overwritten, so a merge can read the current table and publish the next one
in a single plan. A reader keeps its files for ``slots`` - 1 further publishes, or as long as it pins them.
The log is kept in folders of ``PER_FOLDER`` versions, with a file of the state at each full one: opening reads that and the rows since.

The ledger is per stream: batch ids of one stream only grow, a new stream (a new checkpoint) starts at 0 again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import Files, VersionLog

ALL_SLOTS = "abcdefghijklmnopqrstuvwxyz"
PER_FOLDER = 64  # log rows (versions) in a folder of the log
STATE = "_state.json"  # head and ledger as of the last full folder

LOG_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("slot", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("stream", T.StringType()),
])


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, fmt: str = "orc", slots: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.fmt = fmt
        self.slots = ALL_SLOTS[: max(2, slots)]
        self._files, self._pins = Files(spark, self.root), VersionLog(spark, self.root)
        # The log is read once per process; this store object is the table's only writer,
        # so later heads are known without re-reading it. A stream's batch ids only grow, and a
        # replay re-delivers ids at or below the last published one, so the ledger is one
        # number per stream: its highest published batch id.
        self._head: dict | None = None
        self._max_batch: dict[str, int] = {}
        self._loaded = False

    # -- log ---------------------------------------------------------------------------
    def _log(self, since: int = 0) -> DataFrame | None:
        """The log rows, of the folders from version ``since`` on (``PER_FOLDER`` versions each)."""
        names = [n for n in self._files.names("_log") if n.startswith("p=") and int(n[2:]) >= since // PER_FOLDER]
        return self.spark.read.schema(LOG_SCHEMA).parquet(*[f"{self.root}/_log/{n}" for n in names]) if names else None

    def _load(self) -> None:
        if self._loaded:
            return
        self._loaded = True
        if self._files.exists(STATE):
            state = json.loads(self._files.read(STATE))
            self._head, self._max_batch = state["head"], state["batches"]
        log = self._log(self._head["version"] if self._head else 0)
        if log is None:
            return
        row = log.agg(F.max_by(F.struct(*LOG_SCHEMA.fieldNames()), "version").alias("h")).first()
        if row is not None and row["h"] is not None:
            self._head = row["h"].asDict()
        for r in log.groupBy(F.coalesce("stream", F.lit("")).alias("s")).agg(F.max("batch_id").alias("b")).collect():  # a row per stream
            self._max_batch[r["s"]] = max(r["b"], self._max_batch.get(r["s"], r["b"]))

    def head(self) -> dict | None:
        """Latest log row (version, slot, batch_id, rows) or None before the first publish."""
        self._load()
        return self._head

    def has_batch(self, batch_id: int, stream: str = "") -> bool:
        """Ledger test: was this batch of the stream already published here (a replay after a failure)?"""
        self._load()
        return batch_id <= self._max_batch.get(stream, batch_id - 1)

    def history(self) -> DataFrame:
        log = self._log()
        return log if log is not None else self.spark.createDataFrame([], LOG_SCHEMA)

    # -- data --------------------------------------------------------------------------
    def slot_path(self, slot: str) -> str:
        return f"{self.root}/slot={slot}"

    def read(self) -> DataFrame:
        """Current snapshot; an empty frame of the declared schema before the first publish."""
        h = self.head()
        if h is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).format(self.fmt).load(self.slot_path(h["slot"]))

    def _next_slot(self, current: str | None) -> str:
        """The slot after the current one; pinned ones are left out, and more slots are used if all are."""
        at = self.slots.index(current) + 1 if current and current in self.slots else 0
        pinned = self._pins.leased()
        for slot in self.slots[at:] + self.slots[:at] + ALL_SLOTS[len(self.slots):]:
            if slot != current and self.slot_path(slot) not in pinned:
                return slot
        raise RuntimeError(f"readers pin all slots of {self.root}")

    @contextmanager
    def pinned(self, hours: float = 24.0) -> Iterator[DataFrame]:
        """The current snapshot for a slow reader: its slot is not overwritten meanwhile, for ``hours`` at most."""
        h = self.head()
        with self._pins.lease([self.slot_path(h["slot"])] if h else [], hours):
            yield self.read()

    def publish(self, df: DataFrame, batch_id: int, rows: int | None = None, stream: str = "") -> dict:
        """Write ``df`` to the oldest slot that no reader has pinned, then append the log row that makes it current.

        ``rows`` is recorded as given (no extra scan of the snapshot to count it)."""
        h = self.head()
        slot = self._next_slot(h["slot"] if h else None)
        version = 1 if h is None else h["version"] + 1
        path = self.slot_path(slot)
        df.select(*self.schema.fieldNames()).write.mode("overwrite").format(self.fmt).save(path)
        entry = self.spark.createDataFrame([(version, slot, batch_id, rows, stream)], "version long, slot string, batch_id long, rows long, stream string")
        entry.withColumn("published_at", F.current_timestamp()).select(*LOG_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(f"{self.root}/_log/p={version // PER_FOLDER}")
        self._head = {"version": version, "slot": slot, "batch_id": batch_id, "rows": rows}
        self._max_batch[stream] = max(batch_id, self._max_batch.get(stream, batch_id))
        if version % PER_FOLDER == 0:  # opening then reads this and the folders after it
            self._files.put(STATE, json.dumps({"head": self._head, "batches": self._max_batch}))
        return dict(self._head)

    def apply(self, changes: DataFrame, spec, as_of, batch_id: int, pre=None, full_pre: bool = False, stream: str = "", **merge_kw) -> dict:
        """Merge a batch of changes into the current snapshot (after ``pre``, e.g. a purge) and
        publish the result to the next slot. ``full_pre`` makes no difference here: all rows are rewritten."""
        from ..operators.changes import apply_changes

        current = self.read()
        if pre is not None:
            current = pre(current)
        return self.publish(apply_changes(current, changes, spec, as_of=as_of, **merge_kw), batch_id, stream=stream)
