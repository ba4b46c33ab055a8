"""Projections, filters and column rewrites: one lazy expression each, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def project(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def cast(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast columns; a value that cannot be cast becomes NULL unless ``strict``."""
    made = {c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in types.items()}
    return df.withColumns(made)


def cast_all(df: DataFrame, to: str, strict: bool = False) -> DataFrame:
    return cast(df, {c: to for c in df.columns}, strict)


def drop(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def select_by_type(
    df: DataFrame, types: Iterable[type], keep: Iterable[str] = (), exclude: Iterable[str] = ()
) -> DataFrame:
    """Columns whose type is one of ``types`` plus ``keep``, without ``exclude``, in table order."""
    types, keep, exclude = tuple(types), set(keep), set(exclude)
    chosen = [
        f.name
        for f in df.schema.fields
        if f.name not in exclude and (f.name in keep or isinstance(f.dataType, types))
    ]
    return df.select(*chosen)


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the non-numeric columns."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in skip and not isinstance(f.dataType, T.NumericType)
    ]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in skip and isinstance(f.dataType, T.NumericType)
    ]


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def null_rows(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def where_like(df: DataFrame, col: Column | str, pattern: str) -> DataFrame:
    col = F.expr(col) if isinstance(col, str) else col
    return df.filter(col.like(pattern))


def recode(df: DataFrame, col: str, values: Iterable, to) -> DataFrame:
    """Replace the listed values of a column by one value; others, NULL included, stay."""
    return df.withColumn(col, F.when(F.col(col).isin(list(values)), F.lit(to)).otherwise(F.col(col)))


def with_constant(df: DataFrame, col: str, value, type_: str) -> DataFrame:
    """A constant column; ``None`` gives a typed NULL."""
    return df.withColumn(col, F.lit(value).cast(type_))


def with_event_time(df: DataFrame, col: str, epoch_seconds: float) -> DataFrame:
    return df.withColumn(col, F.timestamp_seconds(F.lit(epoch_seconds)))


def sanitize_names(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores; two names may not become one."""
    names = [c.replace(" ", "_") for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after clean-up: {twice}")
    return df.toDF(*names)


def with_key(df: DataFrame, name: str, cols: Iterable[str] | None = None) -> DataFrame:
    """Key column.  With ``cols`` it is a digest of their values and safe to recompute and join on;
    without, it is a random UUID that must be written before it is used twice."""
    if cols is None:
        return df.withColumn(name, F.expr("uuid()"))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols]
    return df.withColumn(name, F.md5(F.concat_ws("|", *parts)))


def with_unique_id(df: DataFrame, name: str) -> DataFrame:
    """Unique, increasing, not dense."""
    return df.withColumn(name, F.monotonically_increasing_id())


def map_get(col: Column | str, key: str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.try_element_at(col, F.lit(key))


def fill_template(df: DataFrame, template: str, slots: Mapping[str, str], out: str) -> DataFrame:
    """Fill ``{slot}`` marks of a template from columns.

    The text around the marks is cut once on the driver, so a filled-in value that itself contains a
    mark is never expanded again.
    """
    pieces, rest = [], template
    while rest:
        hits = [(rest.find("{%s}" % s), s) for s in slots if "{%s}" % s in rest]
        if not hits:
            pieces.append(F.lit(rest))
            break
        at, slot = min(hits)
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(F.coalesce(F.col(slots[slot]).cast("string"), F.lit("")))
        rest = rest[at + len(slot) + 2 :]
    return df.withColumn(out, F.concat(*pieces) if pieces else F.lit(""))
