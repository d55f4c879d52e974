"""File sinks: CSV with header, ORC, JSON lines, and multi-line JSON (one array per file)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.envelope import JSON_OPTIONS


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    df.write.mode(mode).option("header", header).options(**JSON_OPTIONS).csv(path)


def write_orc(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.orc(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**JSON_OPTIONS).json(path)


def _array_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per partition: '[' + first doc, ',' + each next doc, and a last line ']'; one frame per Arrow batch."""
    first = True
    for pdf in batches:
        if len(pdf):
            lines = "," + pdf["value"]
            if first:
                lines.iloc[0] = "[" + pdf["value"].iloc[0]
                first = False
            yield pd.DataFrame({"value": lines})
    if not first:
        yield pd.DataFrame({"value": ["]"]})


def write_json_multiline(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Each output file holds one JSON array of the partition's rows, one row per line.

    Spark writes one file per task, so the array brackets are added per partition: a
    streaming pass over the partition's serialized rows (Arrow batches, no row buffering)."""
    text = df.select(F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("value"))
    text.mapInPandas(_array_lines, "value string").write.mode(mode).text(path)
