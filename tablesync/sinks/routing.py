"""Which store a plan row goes to: ``sink_kind`` of the control plan says database or files.

The plan names the table in the database (``db_table``) and the connection, or the file locations; how they are
reached (driver properties, number of buckets) is the caller's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from ..schema import TargetSpec
from .bucketed import BucketedStore
from .jdbc import JdbcStore
from .merge_on_read import MergeOnReadStore
from .snapshot import SnapshotStore

FILE_STORES = ("merge_on_read", "bucketed", "slots")


def store_router(spark: SparkSession, files: str | Callable = "merge_on_read", db: Callable | None = None, root: str | None = None,
                 jdbc_url: str | None = None, jdbc_props: dict[str, str] | None = None, **options) -> Callable[[dict, TargetSpec], object]:
    """The ``store_for`` of ``targets_from_plan``: picks a store by a plan row's ``sink_kind``.

    ``files``: one of ``FILE_STORES``, below ``location1`` of the row (or ``root`` and the table's name), with ``options``; ``db``: makes the
    store of a database table, by default a ``JdbcStore`` at ``jdbc_url``. Either may be a function of (row, spec).
    """
    if isinstance(files, str) and files not in FILE_STORES:
        raise ValueError(f"files must be one of {FILE_STORES}, not {files!r}")

    def file_store(row: dict, spec: TargetSpec):
        place = f"{root.rstrip('/')}/{spec.name}" if root else row["location1"]
        if not place:
            raise ValueError(f"the plan names no location for {spec.name}")
        if files == "slots":
            return SnapshotStore(spark, place, spec.table_schema, **options)
        return (BucketedStore if files == "bucketed" else MergeOnReadStore)(spark, place, spec, **options)

    def db_store(row: dict, spec: TargetSpec):
        if not jdbc_url:
            raise ValueError(f"{spec.name} goes to the database table {row['db_table']}; give a jdbc_url or db")
        return JdbcStore(spark, jdbc_url, row["db_table"], spec.table_schema, jdbc_props or {})

    def store_for(row: dict, spec: TargetSpec):
        if row["sink_kind"] == "db":
            return (db or db_store)(row, spec)
        if row["sink_kind"] != "files":
            raise ValueError(f"unknown sink kind {row['sink_kind']!r} of {spec.name}")
        return files(row, spec) if callable(files) else file_store(row, spec)

    return store_for
