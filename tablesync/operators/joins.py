"""Join helpers: key conditions, and broadcast only behind a checked size bound."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default bounds on a side that may be broadcast.
DEFAULT_BROADCAST_ROWS = 500_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether all of ``df`` is within both bounds. Rows are measured by their JSON text, in the tasks that make them; only the two
    sums are gathered."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))).alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """(df or broadcast(df), was_broadcast), by a check of its rows and bytes. ``df`` is computed for the check:
    for a result of a heavy plan, let adaptive execution choose instead."""
    if fits_broadcast(df, max_rows):
        return F.broadcast(df), True
    return df, False


def sized(df: DataFrame) -> DataFrame:
    """A side of a join with its strategy: broadcast where a check of all of it finds it within both bounds, else sort-merge.

    Spark's own choice goes by the size of the source's files, which is far below that of the texts and images made from them.
    """
    return F.broadcast(df) if fits_broadcast(df) else df.hint("merge")


def key_condition(left: DataFrame | str, right: DataFrame | str, left_keys: list[str], right_keys: list[str] | None = None) -> Column:
    """AND of equalities between two aliased sides, built from key lists."""
    right_keys = right_keys or left_keys
    la = left if isinstance(left, str) else None
    ra = right if isinstance(right, str) else None

    def side(alias, df, name):
        return F.col(f"{alias}.{name}") if alias else df[name]

    return functools.reduce(
        operator.and_, [side(la, left, a) == side(ra, right, b) for a, b in zip(left_keys, right_keys)]
    )


def join_composite_key(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join USING a composite key list (NULL key parts never match)."""
    return left.join(right, on=list(keys), how=how)


def rename_prefix(df: DataFrame, prefix: str, cols: list[str] | None = None) -> DataFrame:
    """Rename all (or the given) columns with a prefix in one projection."""
    cols = cols if cols is not None else df.columns
    return df.withColumnsRenamed({c: prefix + c for c in cols})
