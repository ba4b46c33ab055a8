"""Positions and running sums over a total order, without pulling the order into one task.

Rows are range-partitioned on the order, sorted inside each partition and stored with their position
(a reliable checkpoint, so partition boundaries cannot move between the two passes).  What crosses
partitions is one row of totals per partition.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage

_POS_BITS = 33  # monotonically_increasing_id() = partition number << 33 | row in partition


def _ranged(df: DataFrame, cols: list[str]) -> DataFrame:
    placed = (
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return cut_lineage(placed).withColumn("_pid", F.shiftright("_at", _POS_BITS))


def with_dense_index(df: DataFrame, name: str, order_by: Iterable[str]) -> DataFrame:
    """Add 0 .. n-1 in the order of ``order_by``."""
    ranged = _ranged(df, list(order_by))
    sizes = sorted((r["_pid"], r["count"]) for r in ranged.groupBy("_pid").count().collect())  # one row per partition
    starts = [0, *accumulate(n for _, n in sizes)]
    offsets = df.sparkSession.createDataFrame(
        [(pid, start) for (pid, _), start in zip(sizes, starts)], "_pid bigint, _start bigint"
    )
    local = F.col("_at").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    return (
        ranged.join(F.broadcast(offsets), "_pid")  # at most one row per partition
        .withColumn(name, F.col("_start") + local)
        .drop("_pid", "_at", "_start")
    )


def running_sums(df: DataFrame, by: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """Add ``cum_<c>``: the sum of ``c`` over the rows of the same ``by`` group up to this one.

    ``by`` columns must not be NULL.  A large group is spread over many range partitions.
    """
    ranged = _ranged(df, [*by, *order])
    inside = Window.partitionBy("_pid", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_pid", *by).agg(*[F.sum(c).alias(c) for c in sums])
    offsets = totals.select("_pid", *by, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sums])
    return (
        ranged.withColumns({f"_in_{c}": F.sum(c).over(inside) for c in sums})
        .join(offsets, ["_pid", *by])
        .withColumns({f"cum_{c}": F.col(f"_in_{c}") + F.col(f"_off_{c}") for c in sums})
        .drop("_pid", "_at", *[f"_in_{c}" for c in sums], *[f"_off_{c}" for c in sums])
    )
