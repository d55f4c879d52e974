"""Shared helpers: cutting lineage, deterministic row keys, reading the input tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str, batch_rows: int = ARROW_ROWS, **options: object) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back; ``options`` are the writer's.

    Cuts the lineage: a lost executor costs a reread, not a recomputation of all stages before. While it runs, Arrow
    batches hold at most ``batch_rows`` rows: they carry whole texts, and Spark's 10,000 rows would be tens of MB
    in the executor and again in each Python worker.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    if not 0 < int(before) <= batch_rows:
        conf.set(key, str(batch_rows))
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_mod(name: str, mod: int) -> Column:
    """``crc32(<id as text>) mod m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % mod


def parts_for(rows: int, per_part: int) -> int:
    """Number of groups so that a group holds about ``per_part`` rows."""
    return max(1, math.ceil(rows / per_part))
