"""Change envelopes: parse raw JSON text, set bad rows aside, route by table, extract images.

The text is parsed once, into a variant; fields are looked up in it with their declared types (no inference pass).
``before`` and ``after`` stay variants until the target's own schema is applied, so a batch that mixes
tables, or lacks a ``before`` field altogether, parses the same way. A text that is no JSON, or has a key twice, is malformed.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ENVELOPE_SCHEMA, OP_DELETE, OP_INSERT, OP_TYPES, OP_UPDATE, TargetSpec

RAW = "_raw"
REASON = "_reason"

# Quarantine reason codes.
REASON_MALFORMED = "malformed"
REASON_UNKNOWN_OP = "unknown_op"
REASON_NO_IMAGE = "missing_image"
REASON_BAD_IMAGE = "bad_image"
REASON_NULL_KEY = "null_key"
REASON_BAD_TIME = "bad_op_ts"
REASON_NO_TARGET = "no_target"

# JSON time formats of images, with microseconds (the default drops them).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Source position columns that break ties between events with equal (op_ts, pos).
ORDER_EXTRAS = ("_src_partition", "_src_offset")


DOC = "_doc"  # the whole envelope as a variant
IMAGES = ("before", "after")


def _path(name: str) -> str:
    return "$['" + name.replace("'", "\\'") + "']" if not name.isidentifier() else f"$.{name}"


def _image(name: str) -> Column:
    """An image of the envelope as a variant; a JSON null is none."""
    image = F.try_variant_get(DOC, _path(name), "variant")
    return F.when(~F.is_variant_null(image), image)


def typed_image(image: Column | str, schema: T.StructType) -> Column:
    """A variant image as a struct of the declared schema; missing fields, and those that do not convert, are NULL."""
    ddl = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema.fields)
    return F.try_variant_get(image, "$", f"struct<{ddl}>")


def _does_not_convert(image: str, typed: str, schema: T.StructType) -> Column:
    """Whether the image is no object, or has a field whose value is there and does not convert to its type."""
    image_c, out = F.col(image), [F.col(image).isNotNull() & F.col(typed).isNull()]
    for f in schema.fields:
        given = F.try_variant_get(image_c, _path(f.name), "variant")
        out.append(F.col(typed)[f.name].isNull() & given.isNotNull() & ~F.is_variant_null(given))
    return F.coalesce(functools.reduce(operator.or_, out), F.lit(False))


def parse_envelope(raw: DataFrame, value_col: str = "value", schema=ENVELOPE_SCHEMA, tags: tuple[str, ...] = ("table",)) -> DataFrame:
    """Raw text column -> envelope columns, keeping the text in ``_raw`` and a ``_reason``.

    Extra columns of ``raw`` (for example a source partition/offset) are carried along.
    ``tags``: the fields that may name the table; those that the schema lacks are parsed as text.
    ``_reason`` is NULL for a well-formed envelope and a reason code otherwise: one without any tag or
    op type, an unknown op type, a missing image, or an op_ts that is no time (it would sort as the oldest).
    """
    text = F.col(value_col).cast("string")
    extras = [c for c in raw.columns if c != value_col]
    more = [t for t in tags if t not in schema.fieldNames()]
    schema = T.StructType([*schema.fields, *[T.StructField(t, T.StringType()) for t in more]])
    fields = schema.fieldNames()
    # One JSON parse per row, inside a one-row generator: filters on the fields (bad-row split, routing) stay above it
    # instead of being pushed down with a copy of the parse each. Fields and images are then looked up in the variant.
    out = raw.select(*extras, text.alias(RAW), F.inline(F.array(F.struct(F.try_parse_json(text).alias(DOC)))))
    found = [_image(f.name) if f.name in IMAGES else F.try_variant_get(DOC, _path(f.name), f.dataType.simpleString()) for f in schema.fields]
    out = out.select(*extras, RAW, DOC, *[c.alias(n) for c, n in zip(found, fields)])
    op = F.col("op_type")
    reason = (
        F.when(F.coalesce(*[F.col(t) for t in tags]).isNull() | op.isNull(), F.lit(REASON_MALFORMED))
        .when(~op.isin(*OP_TYPES), F.lit(REASON_UNKNOWN_OP))
        .when((op == OP_DELETE) & F.col("before").isNull(), F.lit(REASON_NO_IMAGE))
        .when((op != OP_DELETE) & F.col("after").isNull(), F.lit(REASON_NO_IMAGE))
        .when(F.col("op_ts").isNotNull() & F.col("op_ts").try_cast("timestamp_ntz").isNull(), F.lit(REASON_BAD_TIME))
    )
    return out.withColumn(REASON, reason)


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) by ``_reason``; callers persist ``parsed`` first, both sides read it."""
    return parsed.where(F.col(REASON).isNull()), parsed.where(F.col(REASON).isNotNull())


def route(parsed: DataFrame, table: str, tag_col: str = "table") -> DataFrame:
    """Envelopes whose routing tag equals ``table``."""
    return parsed.where(F.col(tag_col) == F.lit(table))


def unrouted(parsed: DataFrame, wanted: list[tuple[str, str]]) -> DataFrame:
    """Envelopes that no (tag column, table) of ``wanted`` takes, with their reason."""
    hit = functools.reduce(operator.or_, [F.coalesce(F.col(tag) == F.lit(table), F.lit(False)) for tag, table in wanted], F.lit(False))
    return parsed.where(~hit).select(RAW, F.lit(REASON_NO_TARGET).alias(REASON))


def route_by_op(parsed: DataFrame, op_type: str) -> DataFrame:
    return parsed.where(F.col("op_type") == F.lit(op_type))


def struct_expand(parsed: DataFrame, spec: TargetSpec, image: str = "after") -> DataFrame:
    """``select(image.*)`` with the target's declared schema: a missing field is NULL."""
    return parsed.select(F.inline(F.array(typed_image(image, spec.data_schema))))


def probe_fields(parsed: DataFrame, probes: dict[str, tuple[str, str]]) -> DataFrame:
    """Field-present probes as boolean columns, looked up in the parsed envelope.

    ``probes`` maps an output name to (json path into the envelope, Spark type). A probe
    is true when the path exists and its value converts to the type, like a typed getter that
    succeeds.
    """
    cols = []
    for name, (path, dtype) in probes.items():
        got = F.try_variant_get(DOC, path, "variant")
        there = got.isNotNull() & ~F.is_variant_null(got)
        ok = there if dtype in ("string", "struct") else there & F.try_variant_get(DOC, path, "string").try_cast(dtype).isNotNull()
        ok = F.coalesce(ok, F.lit(False))
        cols.append(ok.alias(name))
    return parsed.select(*cols)


def _moves(new: list[Column], old: list[Column]) -> Column:
    """Whether an update moves its row: the before image holds a whole key, and another one. Logs often send only
    the changed columns; without the old key the update is in place."""
    whole = functools.reduce(operator.and_, [y.isNotNull() for y in old])
    return whole & functools.reduce(operator.or_, [~x.eqNullSafe(y) for x, y in zip(new, old)])


def seq_column(parsed: DataFrame) -> Column:
    """Event order: (op_ts as time, pos, source partition/offset if known)."""
    parts = [F.col("op_ts").try_cast("timestamp_ntz").alias("ts"), F.col("pos").alias("pos")]
    parts += [F.col(c).alias(c) for c in ORDER_EXTRAS if c in parsed.columns]
    # Last tie-break keeps the choice deterministic when two events share every field above.
    parts.append(F.xxhash64(F.col(RAW)).alias("h"))
    return F.struct(*parts)


def change_rows(parsed: DataFrame, spec: TargetSpec) -> tuple[DataFrame, DataFrame]:
    """Routed, well-formed envelopes -> (changes, bad).

    ``changes`` has the key columns, ``_op``, ``_seq`` (order struct), ``_img`` (typed after
    image, NULL for deletes), ``_prev`` (old key struct of a key-changing update, else NULL)
    and ``_moved`` (true on the delete of the old key that a key-changing update yields, at
    the same position).
    ``bad`` holds rows whose image does not parse or whose key has a NULL part.
    """
    keys = spec.key_cols
    # The images are typed inside a one-row generator so that the filters below (bad rows,
    # NULL keys) are not pushed under it with a copy of the conversion per referenced field.
    images = F.array(F.struct(typed_image("after", spec.data_schema).alias("_a"), typed_image("before", spec.data_schema).alias("_b")))
    base = parsed.select(
        F.col("op_type").alias("_op"),
        seq_column(parsed).alias("_seq"),
        F.col(RAW),
        F.col("after").alias("_va"),
        F.col("before").alias("_vb"),
        F.inline(images),
    )
    op = F.col("_op")
    key_cols = [F.when(op == OP_DELETE, F.col(f"_b.{k}")).otherwise(F.col(f"_a.{k}")).alias(k) for k in keys]
    a_keys = [F.col(f"_a.{k}") for k in keys]
    b_keys = [F.col(f"_b.{k}") for k in keys]
    moved = (op == OP_UPDATE) & F.col("_b").isNotNull() & _moves(a_keys, b_keys)
    prev = F.when(moved, F.struct(*[F.col(f"_b.{k}").alias(k) for k in keys]))
    img = F.when(op != OP_DELETE, F.col("_a"))
    bad_img = _does_not_convert("_va", "_a", spec.data_schema) | _does_not_convert("_vb", "_b", spec.data_schema)
    shaped = base.select(*key_cols, "_op", "_seq", img.alias("_img"), prev.alias("_prev"), bad_img.alias("_bad_img"), RAW)
    null_key = functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])
    reason = F.when(F.col("_bad_img"), F.lit(REASON_BAD_IMAGE)).when(null_key, F.lit(REASON_NULL_KEY))
    shaped = shaped.withColumn(REASON, reason)
    good = shaped.where(F.col(REASON).isNull())
    bad = shaped.where(F.col(REASON).isNotNull()).select(RAW, REASON)
    # A key change also deletes its old key at the same position in the log: each row yields
    # itself, plus that delete when it moved (a generator, so the batch is read once).
    this = F.struct(*[F.col(k).alias(k) for k in keys], F.col("_op"), F.col("_img"), F.col("_prev"), F.lit(False).alias("_moved"))
    old_key_delete = F.struct(
        *[F.col(f"_prev.{k}").alias(k) for k in keys], F.lit(OP_DELETE).alias("_op"),
        F.lit(None).cast(spec.data_schema).alias("_img"), F.lit(None).cast(spec.key_schema).alias("_prev"),
        F.lit(True).alias("_moved"),
    )
    rows = F.when(F.col("_prev").isNull(), F.array(this)).otherwise(F.array(this, old_key_delete))
    out = good.select("_seq", F.inline(rows)).select(*keys, "_op", "_seq", "_img", "_prev", "_moved")
    return out, bad


def log_shape(parsed: DataFrame, spec: TargetSpec) -> dict[str, bool]:
    """``key_changes``: whether an update moves a key; ``rebirths``: whether a key changes again after a
    delete. One job that parses only the key fields and combines per key before its shuffle."""
    ks = spec.key_schema
    image = lambda name, alias: typed_image(name, ks).alias(alias)
    rows = parsed.select("op_type", seq_column(parsed).alias("s"), F.inline(F.array(F.struct(image("after", "a"), image("before", "b")))))
    moved = (F.col("op_type") == OP_UPDATE) & F.col("b").isNotNull() & _moves([F.col(f"a.{c}") for c in spec.keys], [F.col(f"b.{c}") for c in spec.keys])
    gone = F.col("op_type") == OP_DELETE
    this = F.struct(F.when(gone, F.col("b")).otherwise(F.col("a")).alias("k"), gone.alias("d"), moved.alias("m"))
    old = F.struct(F.col("b").alias("k"), F.lit(True).alias("d"), F.lit(True).alias("m"))
    rows = rows.select("s", F.inline(F.when(moved, F.array(this, old)).otherwise(F.array(this))))
    keys = rows.groupBy("k").agg(F.max(F.when(F.col("d"), F.col("s"))).alias("last_d"), F.max("s").alias("last"), F.max("m").alias("m"))
    found = keys.agg(F.max("m").alias("m"), F.max(F.col("last_d") < F.col("last")).alias("r")).first()
    return {"key_changes": bool(found["m"]), "rebirths": bool(found["r"])}


def envelope_columns(df: DataFrame, spec: TargetSpec, op_col: Column, op_ts: Column, pos: Column,
                     table: str | Column, before: Column | None, after: Column | None) -> DataFrame:
    """Build change envelopes (JSON text in ``value``) from rows: the producer side, for fixtures."""
    tbl = F.lit(table) if isinstance(table, str) else table
    env = F.struct(
        tbl.alias("table"), op_col.alias("op_type"), op_ts.alias("op_ts"), pos.alias("pos"),
        (before if before is not None else F.lit(None).cast(spec.data_schema)).alias("before"),
        (after if after is not None else F.lit(None).cast(spec.data_schema)).alias("after"),
    )
    return df.select(F.to_json(env, JSON_OPTIONS).alias("value"))


__all__ = [
    "parse_envelope", "split_bad", "route", "route_by_op", "struct_expand", "probe_fields",
    "typed_image", "change_rows", "seq_column", "envelope_columns", "OP_INSERT", "OP_UPDATE", "OP_DELETE",
]
