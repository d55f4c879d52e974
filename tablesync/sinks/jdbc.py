"""JDBC targets: partitioned reads and a staged overwrite that never reads and truncates the
same table in one plan.

Not exercised by the test suite: it needs a database, and the build starts none (see README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict[str, str], partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """JDBC scan; with a numeric partition column the read is split into ``num_partitions``
    parallel range queries instead of one connection reading the whole table."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_jdbc_staged(df: DataFrame, url: str, table: str, props: dict[str, str], stage_suffix: str = "_stg") -> int:
    """Overwrite ``table`` with ``df`` through a staging table; returns the number of rows.

    1. ``df`` (which may read ``table``) is written to ``<table>_stg``; its rows are counted as they are written;
    2. that count must equal a count of the staging table, else nothing more happens;
    3. ``table`` is truncated and filled from the staging table, keeping its definition, and counted too.
    Step 3 reads only the staging table, so the target is never read while truncated. After a crash within step 3 the staging
    table is whole: ``refill_from_stage`` repeats the step.
    """
    stage = f"{table}{stage_suffix}"
    seen = Observation("staged")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").jdbc(url, stage, properties=props)
    staged = df.sparkSession.read.jdbc(url, stage, properties=props).count()
    if staged != seen.get["n"]:
        raise RuntimeError(f"{stage} holds {staged} of {seen.get['n']} rows; {table} is unchanged")
    return refill_from_stage(df.sparkSession, url, table, props, stage_suffix, staged)


def refill_from_stage(spark: SparkSession, url: str, table: str, props: dict[str, str], stage_suffix: str = "_stg", rows: int | None = None) -> int:
    """Step 3 of the staged overwrite: fill ``table`` from its staging table and compare the counts."""
    staged = spark.read.jdbc(url, f"{table}{stage_suffix}", properties=props)
    rows = staged.count() if rows is None else rows
    staged.write.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=props)
    filled = spark.read.jdbc(url, table, properties=props).count()
    if filled != rows:
        raise RuntimeError(f"{table} holds {filled} of {rows} rows; {table}{stage_suffix} is whole")
    return filled


class JdbcStore:
    """A database table as the store of a ``SyncTarget``, with the interface of the file stores.

    The ledger is a table beside it, ``<table>_batches`` (stream, batch id). It is written after the staged overwrite, so a
    crash between the two repeats a batch, which the merge by key makes harmless.
    """

    LEDGER_DDL = "stream string, batch_id long"

    def __init__(self, spark: SparkSession, url: str, table: str, schema: T.StructType, props: dict[str, str], **read_options):
        self.spark, self.url, self.table, self.schema, self.props = spark, url, table, schema, props
        self.read_options = read_options  # partition_column, lower, upper, num_partitions of read_jdbc
        self._max_batch: dict[str, int] | None = None

    def read(self) -> DataFrame:
        return read_jdbc(self.spark, self.url, self.table, self.props, **self.read_options).select(*self.schema.fieldNames())

    def has_batch(self, batch_id: int, stream: str = "") -> bool:
        if self._max_batch is None:
            try:
                log = self.spark.read.jdbc(self.url, f"{self.table}_batches", properties=self.props)
                self._max_batch = {r["stream"]: r["b"] for r in log.groupBy("stream").agg(F.max("batch_id").alias("b")).collect()}
            except Exception:  # noqa: BLE001  no ledger yet: each driver has its own error for a missing table
                self._max_batch = {}
        return batch_id <= self._max_batch.get(stream, batch_id - 1)

    def publish(self, df: DataFrame, batch_id: int, stream: str = "") -> dict:
        rows = write_jdbc_staged(df.select(*self.schema.fieldNames()), self.url, self.table, self.props)
        entry = self.spark.createDataFrame([(stream, batch_id)], self.LEDGER_DDL)
        entry.write.mode("append").jdbc(self.url, f"{self.table}_batches", properties=self.props)
        self.has_batch(batch_id, stream)
        self._max_batch[stream] = max(batch_id, self._max_batch.get(stream, batch_id))
        return {"batch_id": batch_id, "rows": rows}

    def apply(self, changes: DataFrame, spec, as_of, batch_id: int, pre=None, full_pre: bool = False, stream: str = "", **merge_kw) -> dict:
        """Merge a batch into the table (after ``pre``, e.g. a purge) and publish it whole."""
        from ..operators.changes import apply_changes

        current = self.read()
        if pre is not None:
            current = pre(current)
        return self.publish(apply_changes(current, changes, spec, as_of=as_of, **merge_kw), batch_id, stream)
