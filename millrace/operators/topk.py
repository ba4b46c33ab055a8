"""Sorted limits and best rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Column | Iterable[Column], n: int, tie: Iterable[str] = ()) -> DataFrame:
    """First ``n`` rows.  Sort + limit is planned as one bounded top-k per task and a final merge, not
    a total sort; ``tie`` columns make the choice among equal rows repeatable."""
    order = [order] if isinstance(order, Column) else list(order)
    return df.orderBy(*order, *[F.col(c).asc_nulls_last() for c in tie]).limit(n)


def latest(df: DataFrame, ts: str, n: int, tie: Iterable[str] = ()) -> DataFrame:
    return top_n(df, F.col(ts).desc_nulls_last(), n, tie)


def best_per(df: DataFrame, key: str, metric: str, ascending: bool = True, tie: str | None = None) -> DataFrame:
    """One row per key with the lowest (highest) metric; rows without a metric cannot win.

    An ordered aggregate keeps one candidate per key in every task before the shuffle, so a key that
    holds most of the rows costs no more than any other.
    """
    ranked = df.filter(F.col(metric).isNotNull())
    keyed = F.struct(F.col(metric) if ascending else -F.col(metric), *([F.col(tie)] if tie else []))
    rows = ranked.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), keyed).alias("_row"))
    return rows.select("_row.*")


def latest_version(df: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """The row of the highest version of every name."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(name).agg(F.max_by(row, F.col(version)).alias("_row")).select("_row.*")


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)
