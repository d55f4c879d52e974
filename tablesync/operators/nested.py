"""Flatten nested documents: correlated explode chains (long form), first-n pivots (wide form),
struct unpivot and array indexing.

Every operator here is narrow (Generate + Project): no shuffle, each document is flattened in
the task that read it, so the work scales with the number of input splits.

The long form follows each element into its own children (``explode`` of the element just
produced), so a child is only paired with its real parent. Exploding sibling paths of the
document separately would pair every child with every parent (a cross product per document);
that form is deliberately not offered.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Level:
    """One level of a flatten chain.

    ``array``: path of the array to explode, relative to the element of the previous level
    (or to the document for the first level). ``keep``: output name -> path inside the new
    element (``""`` keeps the element itself). ``position``: output name of the element's
    index, if wanted. ``outer``: keep parents whose array is NULL or empty (one row of NULLs).
    """

    array: str
    keep: dict[str, str] = field(default_factory=dict)
    position: str | None = None
    outer: bool = False


def _path(base: str | None, path: str) -> Column:
    if not path:
        return F.col(base)
    return F.col(f"{base}.{path}") if base else F.col(path)


def flatten_long(df: DataFrame, keep: list[str] | dict[str, str], levels: list[Level]) -> DataFrame:
    """Correlated chain of explodes; one output row per leaf element.

    ``keep``: document-level columns to carry (list, or output name -> path).
    Output columns: the kept document columns, then each level's position and kept fields.
    """
    carried = dict(keep) if isinstance(keep, dict) else {c: c for c in keep}
    cur = df.select(*[_path(None, p).alias(n) for n, p in carried.items()], *[F.col(c) for c in _roots(levels[0].array, df)])
    out_cols = list(carried)
    elem = None
    for i, lv in enumerate(levels):
        alias = f"_e{i}"
        arr = _path(elem, lv.array)
        if lv.position:
            gen = (F.posexplode_outer if lv.outer else F.posexplode)(arr).alias(lv.position, alias)
        else:
            gen = (F.explode_outer if lv.outer else F.explode)(arr).alias(alias)
        cur = cur.select(*out_cols, gen)
        if lv.position:
            out_cols.append(lv.position)
        kept = [_path(alias, p).alias(n) for n, p in lv.keep.items()]
        last = i == len(levels) - 1
        cur = cur.select(*out_cols, *kept, *([] if last else [F.col(alias)]))
        out_cols += list(lv.keep)
        elem = alias
    return cur


def _roots(path: str, df: DataFrame) -> list[str]:
    root = path.split(".")[0]
    return [root] if root in df.columns else []


def explode_column(df: DataFrame, array_col: str, alias: str, outer: bool = False, position: str | None = None) -> DataFrame:
    """All columns plus one row per element of ``array_col`` (``outer`` keeps NULL/empty)."""
    others = [c for c in df.columns if c != array_col]
    if position:
        gen = (F.posexplode_outer if outer else F.posexplode)(F.col(array_col)).alias(position, alias)
    else:
        gen = (F.explode_outer if outer else F.explode)(F.col(array_col)).alias(alias)
    return df.select(*others, gen)


def pivot_points(df: DataFrame, data_col: str, n: int, fields: dict[str, str], sep: str = "_") -> DataFrame:
    """First ``n`` elements of an array of structs as columns: ``{name}{sep}{i}`` for each
    (output name -> struct field) in ``fields``; out-of-range positions are NULL."""
    cols = [c for c in df.columns if c != data_col]
    wide = []
    for name, fld in fields.items():
        for i in range(n):
            wide.append(F.get(F.col(data_col), i)[fld].alias(f"{name}{sep}{i + 1}"))
    return df.select(*cols, *wide)


def array_index(col: str | Column, i: int) -> Column:
    """Element ``i`` (0-based) of an array, NULL when out of range (``getItem`` raises under ANSI)."""
    return F.get(F.col(col) if isinstance(col, str) else col, i)


def unpivot_struct(df: DataFrame, id_cols: list[str], struct_col: str, name_col: str = "field", value_col: str = "value") -> DataFrame:
    """One row per field of a struct column: (ids..., field name, value). Fields are cast to a
    common type by ``array``; use ``cast`` on the struct first when they differ."""
    fields = df.schema[struct_col].dataType.fieldNames()
    pairs = F.array(*[F.struct(F.lit(f).alias(name_col), F.col(f"{struct_col}.{f}").alias(value_col)) for f in fields])
    return df.select(*id_cols, F.explode(pairs).alias("_kv")).select(*id_cols, f"_kv.{name_col}", f"_kv.{value_col}")
