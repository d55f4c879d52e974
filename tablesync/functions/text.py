"""Text helpers as column expressions: parts of strings, key/topic lists, bounded error text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: error text stored in the error table is kept below 2000 characters.
ERROR_TEXT_MAX = 1990


def take_right(c: Column, n: int) -> Column:
    return F.right(c, F.lit(n))


def list_item(c: Column, sep: str, i: int) -> Column:
    """Item ``i`` (1-based) of a separated list; NULL when missing."""
    return F.try_element_at(F.split(c, sep), F.lit(i))


def trimmed_list(c: Column, sep: str = ",") -> Column:
    """Separated list -> array of trimmed, non-empty items."""
    return F.filter(F.transform(F.split(c, sep), lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def error_text(c: Column) -> Column:
    """Error text bounded for the error table (at most ERROR_TEXT_MAX characters)."""
    return F.substring(c, 1, ERROR_TEXT_MAX)


def is_file_connection(c: Column) -> Column:
    return c.startswith("hdfs://") | c.startswith("file:")


def database_name(c: Column) -> Column:
    """Second '/'-separated part of a connection string (the service name)."""
    return list_item(c, "/", 2)
