"""Column conversions: typed casts by name, clock text formats, elapsed days and intervals.

All are built-in column expressions (JVM-side, inside whole-stage codegen); nothing here
runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The control-table type names and the clock text pattern of the job log.
CONTROL_TYPES = {
    "Timestamp": T.TimestampNTZType(),
    "Integer": T.IntegerType(),
    "Boolean": T.BooleanType(),
    "String": T.StringType(),
    "Date": T.DateType(),
}
CLOCK_FORMAT = "dd-MMM-yyyy hh:mm.ss a"
TIME_OF_DAY_FORMAT = "HH:mm:ss"
HEALTH_PURGE_DAYS = 15


def control_type(name: str, timestamp_type: T.DataType | None = None) -> T.DataType:
    """Control-table type name -> Spark type; an unknown name raises."""
    if name not in CONTROL_TYPES:
        raise ValueError(f"unknown column type {name!r}; expected one of {sorted(CONTROL_TYPES)}")
    if name == "Timestamp" and timestamp_type is not None:
        return timestamp_type
    return CONTROL_TYPES[name]


def cast_columns(df: DataFrame, types: dict[str, str | T.DataType], timestamp_type: T.DataType | None = None) -> DataFrame:
    """Cast many columns in one projection. Text that does not convert becomes NULL
    (``try_cast``), so one bad value does not fail the batch; strings cast plainly."""
    casts = {}
    for name, t in types.items():
        if name not in df.columns:
            raise ValueError(f"column {name!r} not in {df.columns}")
        dtype = control_type(t, timestamp_type) if isinstance(t, str) else t
        c = F.col(name)
        casts[name] = c.cast(dtype) if isinstance(dtype, T.StringType) else c.try_cast(dtype)
    return df.withColumns(casts)


def format_clock(ts: Column, fmt: str = CLOCK_FORMAT) -> Column:
    return F.date_format(ts, fmt)


def parse_clock(text: Column, fmt: str = CLOCK_FORMAT) -> Column:
    """Clock text -> timestamp_ntz (wall clock, no time-zone round trip); NULL when it does
    not parse. The strict parse runs only where the lenient one succeeded, so ANSI mode
    never raises on bad text."""
    parses = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
    return F.when(parses, F.to_timestamp_ntz(text, F.lit(fmt)))


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, TIME_OF_DAY_FORMAT)


def age_days(last: Column, now: Column) -> Column:
    """Whole days elapsed from ``last`` to ``now`` (no wrap-around at a year)."""
    return F.floor(F.timestamp_diff("MICROSECOND", last, now) / F.lit(86_400_000_000))


def purge_due(last: Column, now: Column, days: int = HEALTH_PURGE_DAYS) -> Column:
    return age_days(last, now) >= F.lit(days)


def refresh_due(start: Column, now: Column, hours: int) -> Column:
    """True once ``hours`` have passed since ``start``."""
    return now >= start + F.make_dt_interval(F.lit(0), F.lit(hours))


def plus_days(ts: Column, days: int | Column) -> Column:
    """Timestamp + whole days (an integer day count; decimals are rounded down first)."""
    d = days if isinstance(days, Column) else F.lit(days)
    return ts + F.make_dt_interval(F.floor(d).cast("int"))


def micros(c: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970: of a timestamp the instant, of any other date or time its wall clock, in no time zone."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    clock = c if isinstance(dtype, T.TimestampNTZType) else c.try_cast("timestamp_ntz")
    minutes = F.unix_date(clock.cast("date")).cast("long") * 1440 + F.hour(clock) * 60 + F.minute(clock)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("long")
