"""Counts, group statistics and ordered assembly of texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def group_stats(df: DataFrame, key: str, cols: Iterable[str] = ()) -> DataFrame:
    """Rows used per group, and mean, minimum and maximum of ``cols``."""
    aggs = [F.count(F.lit(1)).alias("n_used")]
    for c in cols:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(key).agg(*aggs)


def concat_text(
    df: DataFrame, key: str, order: str, text: str, start: int = 0, *, per_part: int, sep: str = ""
) -> DataFrame:
    """Texts of each key joined in order, from position ``start`` on, as ``(key, part_no, text, n_chars)``.

    A part covers ``per_part`` positions, so one key with a third of all rows becomes many parts in many
    tasks instead of one row in one; the parts in order are the whole text, none is cut.
    """
    return (
        df.filter(F.col(order) >= start)
        .withColumn("part_no", F.floor((F.col(order) - start) / per_part).cast("bigint"))
        .groupBy(key, "part_no")
        .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("_l"))
        .select(key, "part_no", F.concat_ws(sep, F.transform("_l", lambda x: x["t"])).alias("text"))
        .withColumn("n_chars", F.length("text"))
    )


def text_length(df: DataFrame, key: str, order: str, text: str, start: int = 0) -> DataFrame:
    """Total length of the texts of each key from ``start`` on, without assembling them."""
    return df.filter(F.col(order) >= start).groupBy(key).agg(F.sum(F.length(text)).alias("n_chars"))


def to_messages(
    df: DataFrame, key: str, turn: str, role: str, text: str, per_segment: int
) -> DataFrame:
    """Chats as ``(key, segment, messages array<struct<role,content>>)`` in turn order.

    A storage form: a segment holds the turns of ``per_segment`` turn numbers, so a chat of any length is
    many rows in many tasks, none of them cut.  A segment is no chat of its own; whoever answers has to
    take all segments of a key, or aggregate over its turns.
    """
    item = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    return (
        df.withColumn("segment", F.floor(F.col(turn) / per_segment).cast("bigint"))
        .groupBy(key, "segment")
        .agg(F.array_sort(F.collect_list(item)).alias("_l"))
        .select(
            key,
            "segment",
            F.transform("_l", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"),
        )
    )
