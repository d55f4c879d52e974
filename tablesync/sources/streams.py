"""Change streams: Kafka (the production source) or a folder of text files (tests, replays).

Both give the same contract: a string column ``value`` with one envelope per row, plus the
source position (``_src_partition``, ``_src_offset``) when the source has one, used to break
ties between events with equal (op_ts, pos).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SPLIT_BYTES = 16 << 20  # of the text that one task of a batch reads (parsed and kept, it takes about twice that)
SPLIT_CONF = "spark.sql.files.maxPartitionBytes"


def _bytes(text: str) -> int:
    """A size setting such as 134217728b, 64m or 1gb."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)(?:i?b)?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def small_splits(spark: SparkSession) -> SparkSession:
    """A session like this one that reads files in splits of ``SPLIT_BYTES`` at most: the splits of a stream's files go by the
    settings of the session that made it, and those of the caller's session stay as they are."""
    reader = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            reader.conf.set(name, value)
    reader.conf.set(SPLIT_CONF, f"{min(SPLIT_BYTES, _bytes(spark.conf.get(SPLIT_CONF)))}b")
    return reader


def stream_changes(spark: SparkSession, kind: str, *, topics: list[str] | None = None, bootstrap: str | None = None,
                   path: str | None = None, max_per_trigger: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Streaming DataFrame of raw envelopes.

    kind="kafka": subscribe to ``topics`` (offsets are tracked by the query checkpoint; no
    consumer-group commits). Needs the Kafka connector on the classpath.
    kind="files": new text files under ``path``, one envelope per line, oldest first, by a session of its own (``small_splits``).
    """
    options = dict(options or {})
    if kind == "kafka":
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
             .option("subscribe", ",".join(topics or [])).option("startingOffsets", options.pop("startingOffsets", "earliest")))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        df = r.options(**options).load()
        return df.select(F.col("value").cast("string").alias("value"),
                         F.col("partition").alias("_src_partition"), F.col("offset").alias("_src_offset"))
    if kind == "files":
        r = small_splits(spark).readStream.format("text")
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_per_trigger))
        return r.options(**options).load(path)
    raise ValueError(f"unknown stream kind {kind!r}")
