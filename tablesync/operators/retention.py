"""Retention: purge expired rows, purge all rows of an id, and the health-log purge.

A row is expired when ``date + days <= as_of``; a NULL date never expires. The date column
defaults to UPDATE_DATE. With ``keys`` given, removal is by key (every row sharing a key with
an expired row goes, the reference's rule for tables whose key may repeat); without keys it is
a plain row filter, which needs no join and is the same thing when the key is unique.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import HEALTH_PURGE_DAYS, age_days, micros, plus_days
from ..operators.changes import as_of_column
from ..operators.joins import broadcast_if_bounded
from ..schema import UPDATE_DATE


def expired(df: DataFrame, days: int, as_of=None, column: str | None = None) -> Column:
    column = column or UPDATE_DATE
    dtype = df.schema[column].dataType
    ts_type = dtype if dtype.typeName() in ("timestamp", "timestamp_ntz") else "timestamp_ntz"
    # the column stands alone, so that the comparison reaches the scan
    date = F.col(column) if dtype.typeName() == ts_type else F.col(column).cast(ts_type)
    return date <= plus_days(as_of_column(as_of, ts_type), -days)


def purge_expired(df: DataFrame, days: int, as_of=None, column: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Rows left after removing expired ones (by row, or by key when ``keys`` is given)."""
    gone = expired(df, days, as_of, column)
    if not keys:
        return df.where(F.col(column or UPDATE_DATE).isNull() | ~gone)
    expired_keys = df.where(gone).select(*keys).distinct()
    return df.join(expired_keys, list(keys), "left_anti")


@dataclass(frozen=True)
class Purge:
    """A purge as a value: calling it removes expired rows; stores also compare its cutoff with the dates in their logs."""

    days: int
    as_of: object = None
    column: str | None = None
    keys: tuple[str, ...] | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        return purge_expired(df, self.days, self.as_of, self.column, list(self.keys) if self.keys else None)

    def cutoff(self, spark: SparkSession, dtype: T.DataType) -> int:
        """The latest expired date, as ``functions.convert.micros`` of a column of type ``dtype``."""
        kind = dtype if isinstance(dtype, T.TimestampType) else T.TimestampNTZType()
        last = plus_days(as_of_column(self.as_of, kind), -self.days).cast(kind)
        return spark.range(1).select(micros(last, kind)).first()[0]


def purge_by_id(df: DataFrame, id_col: str, id_value) -> DataFrame:
    """All rows except those of one id (rows with a NULL id go too, as with ``!=``)."""
    return df.where(F.col(id_col) != F.lit(id_value))


def health_due(health: DataFrame, id_col: str, time_col: str, as_of=None, days: int = HEALTH_PURGE_DAYS) -> DataFrame:
    """Ids whose latest run is at least ``days`` whole days before ``as_of``."""
    last = health.groupBy(id_col).agg(F.max(time_col).alias("_last"))
    now = as_of_column(as_of, health.schema[time_col].dataType)
    return last.where(age_days(F.col("_last"), now) >= F.lit(days)).select(id_col)


def purge_health(health: DataFrame, id_col: str, time_col: str, as_of=None, days: int = HEALTH_PURGE_DAYS) -> DataFrame:
    """Health log without the rows of ids that are due (set-based over all ids at once).

    The due-id set has one row per id; it is broadcast only when a row-count check bounds it.
    """
    due, _ = broadcast_if_bounded(health_due(health, id_col, time_col, as_of, days))
    return health.join(due, id_col, "left_anti")
