"""Declared schemas, key lists and audit-column names.

A target table is its data columns (in target order) followed by the two audit columns.
Change envelopes carry their before/after images as raw JSON text; each target parses them
with its own schema, so one batch may hold changes for many tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Audit column names and the op codes of the change envelope.
INSERT_DATE = "INSERT_DATE"
UPDATE_DATE = "UPDATE_DATE"
AUDIT_COLUMNS = (INSERT_DATE, UPDATE_DATE)
OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"
OP_TYPES = (OP_INSERT, OP_UPDATE, OP_DELETE)

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("op_type", T.StringType()),
        T.StructField("op_ts", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("before", T.StringType()),
        T.StructField("after", T.StringType()),
    ]
)


def key_list(spec: str | list[str] | tuple[str, ...]) -> list[str]:
    """Comma-separated key spec (or a list) to a clean list of column names."""
    parts = spec.split(",") if isinstance(spec, str) else list(spec)
    keys = [p.strip() for p in parts if p and p.strip()]
    if not keys:
        raise ValueError(f"empty key specification: {spec!r}")
    return keys


def data_columns(cols: list[str] | DataFrame | T.StructType) -> list[str]:
    """Column names minus the audit columns, matched by exact name."""
    if isinstance(cols, DataFrame):
        cols = cols.columns
    elif isinstance(cols, T.StructType):
        cols = cols.fieldNames()
    return [c for c in cols if c not in AUDIT_COLUMNS]


@dataclass(frozen=True)
class TargetSpec:
    """What a sync target looks like: name, data schema, key and audit-date type.

    ``seq_column`` (optional): a string column, after the audit columns, holding the log
    position of the last change applied to the row. With it, a change older than the stored
    position is ignored, so a late event cannot overwrite or delete newer state.
    ``tombstone`` (optional, with ``seq_column``): a boolean column, last. A deleted row then stays as a
    tombstone, so that a late event cannot revive it; ``operators.changes.live_rows`` leaves tombstones out.
    """

    name: str
    data_schema: T.StructType
    keys: tuple[str, ...]
    audit_type: T.DataType = field(default_factory=T.TimestampNTZType)
    seq_column: str | None = None
    tombstone: str | None = None

    def __post_init__(self):
        if self.tombstone and not self.seq_column:
            raise ValueError("tombstones need a sequence column")
        names = set(self.data_schema.fieldNames())
        missing = [k for k in self.keys if k not in names]
        if missing:
            raise ValueError(f"key columns {missing} not in the schema of {self.name}")

    @property
    def data_cols(self) -> list[str]:
        return self.data_schema.fieldNames()

    @property
    def key_cols(self) -> list[str]:
        return list(self.keys)

    @property
    def table_schema(self) -> T.StructType:
        seq = [T.StructField(self.seq_column, T.StringType())] if self.seq_column else []
        dead = [T.StructField(self.tombstone, T.BooleanType())] if self.tombstone else []
        return T.StructType(
            list(self.data_schema.fields)
            + [T.StructField(INSERT_DATE, self.audit_type), T.StructField(UPDATE_DATE, self.audit_type)]
            + seq
            + dead
        )

    @property
    def key_schema(self) -> T.StructType:
        return T.StructType([self.data_schema[k] for k in self.keys])

    def with_type(self, column: str, dtype: T.DataType) -> "TargetSpec":
        """The same spec with one data column declared as ``dtype`` (images parse to it)."""
        if column not in self.data_cols:
            raise ValueError(f"column {column!r} not in {self.name}: {self.data_cols}")
        fields = [T.StructField(f.name, dtype, f.nullable) if f.name == column else f for f in self.data_schema.fields]
        return TargetSpec(self.name, T.StructType(fields), self.keys, self.audit_type, self.seq_column, self.tombstone)

    @classmethod
    def of(cls, name: str, table_schema: T.StructType, keys, audit_type: T.DataType | None = None,
           seq_column: str | None = None) -> "TargetSpec":
        """Spec from a full table schema (audit and sequence columns, if present, are split off)."""
        data = T.StructType([f for f in table_schema.fields if f.name not in AUDIT_COLUMNS and f.name != seq_column])
        if audit_type is None:
            audit_type = (
                table_schema[INSERT_DATE].dataType if INSERT_DATE in table_schema.fieldNames() else T.TimestampNTZType()
            )
        return cls(name, data, tuple(key_list(keys)), audit_type, seq_column)
