"""File scans with declared schemas: JSON (lines and multi-line), text lines, delimited, ORC.

Schemas are always declared: inference costs an extra pass over the data and gives a schema
that changes with the content of each batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .envelope import JSON_OPTIONS


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False,
              corrupt_column: str | None = None) -> DataFrame:
    """JSON scan. ``multiline``: each file holds one JSON value (an object, or an array of
    objects giving one row each); otherwise one object per line, and files split freely.
    ``corrupt_column``: keep unparsable records' text in this column (PERMISSIVE mode)."""
    r = spark.read.options(**JSON_OPTIONS).option("multiLine", multiline)
    if corrupt_column:
        if isinstance(schema, str):
            schema = f"{schema}, {corrupt_column} string"
        else:
            schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    return r.schema(schema).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in column ``value`` (one row per line; files split)."""
    return spark.read.text(path)


def strip_header(lines: DataFrame, header: str | None = None, col: str = "value") -> DataFrame:
    """Drop every line equal to the header line (the first line unless given).

    Taking the first line costs one small job reading one split; the filter is narrow.
    """
    if header is None:
        first = lines.first()
        if first is None:
            return lines
        header = first[col]
    return lines.where(F.col(col) != F.lit(header))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
                   sep: str = ",", null_value: str | None = None, date_format: str | None = None) -> DataFrame:
    """Delimited text with a declared schema (``null_value`` text read as NULL)."""
    r = spark.read.option("header", header).option("sep", sep)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if date_format:
        r = r.option("dateFormat", date_format)
    return r.schema(schema).csv(path)


def read_orc(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.orc(path)
