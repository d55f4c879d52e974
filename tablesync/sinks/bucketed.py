"""Bucketed target store: a merge rewrites only the key buckets its batch touches.

Rows are assigned to one of ``buckets`` buckets by ``pmod(xxhash64(keys), buckets)``. Each
publish writes the new contents of the touched buckets into a fresh version folder
(``v=<version>/_bucket=<b>/``, ``files_per_bucket`` files each), then appends one log row per touched
bucket: (version, stream, batch id, bucket, folder or NULL when the bucket became empty, number of buckets). The current
table is, per bucket, the folder of its latest log row. Nothing is overwritten in place, so
readers always see a whole version and a crash before the log append leaves the previous
version current (the orphan folder is ignored; a replay writes a new version).

The log holds at most ``buckets`` rows per publish; only the per-bucket latest folder (at most
``buckets`` paths) is brought to the driver, with the least date in it, so that a scheduled purge rewrites only
buckets that can hold an expired row; the log also keeps the time of the last one. The number of buckets is part of the log: opening a table
with another one raises. ``vacuum`` removes folders that no bucket points at any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import micros
from ..operators.changes import apply_changes
from ..operators.retention import Purge
from ..schema import UPDATE_DATE, TargetSpec

BUCKET = "_bucket"
PART = "_part"
LOG_DDL = "version long, batch_id long, bucket int, path string, stream string, buckets int, least long, purged_at double"


class BucketedStore:
    def __init__(self, spark: SparkSession, root: str, spec: TargetSpec, buckets: int = 64, fmt: str = "orc", files_per_bucket: int = 1, date_column: str = UPDATE_DATE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.schema = spec.table_schema
        self.buckets = buckets
        self.fmt = fmt
        self.files_per_bucket = files_per_bucket
        self.date_column = date_column  # whose least value per bucket the log keeps, for purges
        self._paths: dict[int, str | None] | None = None
        self._least: dict[int, int | None] = {}  # None: unknown, or no date in the bucket
        self._purged_at: float | None = None
        self._version = 0
        self._max_batch: dict[str, int] = {}  # the ledger: highest published batch id of each stream

    def bucket_of(self, cols: list[str] | None = None) -> Column:
        keys = cols or self.spec.key_cols
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(self.buckets)).cast("int")

    # -- log -------------------------------------------------------------------------
    def _load(self) -> None:
        if self._paths is not None:
            return
        self._paths = {}
        try:
            log = self.spark.read.schema(LOG_DDL).parquet(f"{self.root}/_log")
        except AnalysisException:
            return
        latest = log.groupBy("bucket").agg(F.max_by(F.struct("path", "least"), "version").alias("at"), F.max("version").alias("v"), F.max("buckets").alias("n"), F.max("purged_at").alias("purged"))
        for r in latest.collect():  # at most one row per bucket
            if r["n"] is not None and r["n"] != self.buckets:
                self._paths = None
                raise ValueError(f"{self.root} has {r['n']} buckets, not {self.buckets}")
            self._version = max(self._version, r["v"])
            self._purged_at = max(filter(None, (self._purged_at, r["purged"])), default=None)
            if r["bucket"] is None:  # a purge that had nothing to rewrite
                continue
            self._paths[r["bucket"]] = r["at"]["path"]
            self._least[r["bucket"]] = r["at"]["least"]
        for r in log.groupBy(F.coalesce("stream", F.lit("")).alias("s")).agg(F.max("batch_id").alias("b")).collect():
            self._max_batch[r["s"]] = r["b"]

    def has_batch(self, batch_id: int, stream: str = "") -> bool:
        self._load()
        return batch_id <= self._max_batch.get(stream, batch_id - 1)

    def current_paths(self, buckets: list[int] | None = None) -> list[str]:
        self._load()
        chosen = self._paths if buckets is None else {b: self._paths.get(b) for b in buckets}
        return sorted(p for p in chosen.values() if p)

    # -- data ------------------------------------------------------------------------
    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The table, or only the given buckets of it."""
        paths = self.current_paths(buckets)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).format(self.fmt).load(paths)

    def _publish(self, df: DataFrame, buckets: list[int], batch_id: int, stream: str = "", purged_at: float | None = None) -> dict:
        self._load()
        version = self._version + 1
        path = f"{self.root}/v={version}"
        out = df.select(*self.schema.fieldNames()).withColumn(BUCKET, self.bucket_of())
        # Without this every task would write a file of every bucket. Adaptive execution splits a bucket that is too large for one task.
        part = F.pmod(F.xxhash64(*[F.col(k) for k in self.spec.key_cols], F.lit(1)), F.lit(self.files_per_bucket))
        out = out.withColumn(PART, part).hint("rebalance", F.col(BUCKET), F.col(PART)).drop(PART)
        out.write.mode("overwrite").partitionBy(BUCKET).format(self.fmt).save(path)
        # Reads one column of what was written; at most one row per bucket reaches the driver.
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).format(self.fmt).load(path)
        least = F.min(micros(F.col(self.date_column), self.schema[self.date_column].dataType)).alias("least")
        found = {r[BUCKET]: r["least"] for r in written.groupBy(BUCKET).agg(least).collect()}
        rows = [(version, batch_id, b, f"{path}/{BUCKET}={b}" if b in found else None, stream, self.buckets, found.get(b), purged_at) for b in sorted(buckets)]
        self._log(rows)
        for row in rows:
            self._paths[row[2]], self._least[row[2]] = row[3], row[6]
        self._version = version
        self._max_batch[stream] = max(batch_id, self._max_batch.get(stream, batch_id))
        return {"version": version, "buckets": len(buckets), "batch_id": batch_id}

    def _log(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, LOG_DDL).coalesce(1).write.mode("append").parquet(f"{self.root}/_log")

    def last_purge(self) -> float:
        """When all expired rows were last removed (as ``apply`` was told), over restarts."""
        self._load()
        return self._purged_at if self._purged_at is not None else float("-inf")

    def expirable(self, purge: Callable) -> list[int]:
        """The buckets that can hold a row that ``purge`` removes: by the least dates in the log, or all where those do not tell."""
        self._load()
        by_row = isinstance(purge, Purge) and (purge.column or UPDATE_DATE) == self.date_column and (not purge.keys or set(purge.keys) == set(self.spec.keys))
        cutoff = purge.cutoff(self.spark, self.schema[self.date_column].dataType) if by_row else None
        return sorted(b for b, p in self._paths.items() if p and (cutoff is None or self._least.get(b) is None or self._least[b] <= cutoff))

    def publish(self, df: DataFrame, batch_id: int, stream: str = "") -> dict:
        """Replace the whole table (every bucket)."""
        return self._publish(df, list(range(self.buckets)), batch_id, stream)

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets a change batch touches (old keys of moved rows are change rows
        too, so they count). At most ``buckets`` values reach the driver."""
        b = changes.select(self.bucket_of().alias("b")).distinct()
        return sorted(r["b"] for r in b.collect())

    def apply(self, changes: DataFrame, spec: TargetSpec, as_of, batch_id: int,
              pre: Callable[[DataFrame], DataFrame] | None = None, full_pre: bool = False, stream: str = "", at: float | None = None, **merge_kw) -> dict:
        """Merge a batch of changes: read the touched buckets, merge, publish them.

        ``pre`` (e.g. a purge by row) transforms the rows read first: those of the touched buckets, and with
        ``full_pre`` (a scheduled purge, at the time ``at``) of all that can hold a row it removes.
        """
        full = pre is not None and full_pre
        buckets = sorted({*self.touched(changes), *self.expirable(pre)}) if full else self.touched(changes)
        if not buckets:
            if full:
                self._version += 1
                self._log([(self._version, batch_id, None, None, stream, self.buckets, None, at)])
                self._purged_at = at or self._purged_at
            return {"version": self._version, "buckets": 0, "batch_id": batch_id}
        current = self.read(buckets)
        if pre is not None:
            current = pre(current)
        done = self._publish(apply_changes(current, changes, spec, as_of=as_of, **merge_kw), buckets, batch_id, stream, at if full else None)
        self._purged_at = (at if full else None) or self._purged_at
        return done

    def vacuum(self, older_than_hours: float = 24.0) -> int:
        """Remove bucket folders that are not current and were written more than ``older_than_hours`` ago, which
        must be longer than any reader runs. Returns their number."""
        import time

        self._load()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        current = {str(fs.makeQualified(hadoop.Path(p)).toString()) for p in self._paths.values() if p}
        found = fs.globStatus(hadoop.Path(f"{self.root}/v=*/{BUCKET}=*")) or []
        limit, gone = (time.time() - older_than_hours * 3600) * 1000, 0
        for status in found:
            if str(status.getPath().toString()) not in current and status.getModificationTime() <= limit:
                gone += bool(fs.delete(status.getPath(), True))
        return gone
