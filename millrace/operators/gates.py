"""Acceptance gates and champion choice."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.metrics import classification_aggs, regression_aggs
from millrace.operators.models import HIGHER_IS_BETTER


class ModelRejected(RuntimeError):
    def __init__(self, failed: list[str]):
        self.failed = failed
        super().__init__("candidate fails the gate on: " + ", ".join(failed))


@dataclass(frozen=True)
class Threshold:
    """Limits for one metric.  ``min_abs`` and ``min_rel`` ask for that much improvement over the
    baseline; ``greater_is_better`` is a second spelling of the direction flag."""

    value: float | None = None
    min_abs: float | None = None
    min_rel: float | None = None
    higher_is_better: bool | None = None
    greater_is_better: bool | None = None

    def higher(self) -> bool:
        flags = [f for f in (self.higher_is_better, self.greater_is_better) if f is not None]
        if not flags or len(set(flags)) > 1:
            raise ValueError("give the metric direction once")
        return flags[0]


def gate(candidate: DataFrame, baseline: DataFrame, thresholds: Mapping[str, Threshold]) -> DataFrame:
    """One row per metric: candidate and baseline value, the three checks, and ``accepted``.

    Inputs are one-row metric frames as the metric functions return them."""
    both = (
        candidate.select(F.lit("c").alias("side"), *[F.col(m).cast("double").alias(m) for m in thresholds])
        .unionByName(baseline.select(F.lit("b").alias("side"), *[F.col(m).cast("double").alias(m) for m in thresholds]))
        .agg(
            *[F.max(F.when(F.col("side") == "c", F.col(m))).alias(f"c_{m}") for m in thresholds],
            *[F.max(F.when(F.col("side") == "b", F.col(m))).alias(f"b_{m}") for m in thresholds],
        )
    )
    rows = []
    for m, t in thresholds.items():
        c, b = F.col(f"c_{m}"), F.col(f"b_{m}")
        gain = (c - b) if t.higher() else (b - c)
        reach = F.lit(True) if t.value is None else (c >= t.value if t.higher() else c <= t.value)
        enough = F.lit(True) if t.min_abs is None else gain >= t.min_abs
        # a zero baseline has no relative scale: any gain counts
        share = F.lit(True) if t.min_rel is None else F.when(b == 0, gain > 0).otherwise(gain / F.nullif(F.abs(b), F.lit(0.0)) >= t.min_rel)
        ok = [F.coalesce(x, F.lit(False)) for x in (reach, enough, share)]
        rows.append(
            F.struct(
                F.lit(m).alias("metric"), c.alias("candidate"), b.alias("baseline"),
                ok[0].alias("meets_threshold"), ok[1].alias("meets_absolute"), ok[2].alias("meets_relative"),
                (ok[0] & ok[1] & ok[2]).alias("accepted"),
            )
        )
    return both.select(F.inline(F.array(*rows)))


def gate_or_fail(candidate: DataFrame, baseline: DataFrame, thresholds: Mapping[str, Threshold]) -> DataFrame:
    """The gate rows (at most one per threshold) if every metric is accepted, else ModelRejected."""
    result = gate(candidate, baseline, thresholds)
    failed = [r["metric"] for r in result.filter(~F.col("accepted")).select("metric").collect()]
    if failed:
        raise ModelRejected(failed)
    return result


def champion(df: DataFrame, y: str, models: Mapping[str, str], metric: str) -> DataFrame:
    """Score of each model's prediction column and the winner, all from one aggregation.

    ``models`` maps names to prediction columns; the first is the baseline and keeps its place on a tie."""
    aggs = regression_aggs if metric in ("mse", "rmse", "mae", "r2") else classification_aggs
    row = df.agg(*[aggs(y, p)[metric].alias(f"m_{i}") for i, p in enumerate(models.values())])
    higher = HIGHER_IS_BETTER[metric]
    best = F.lit(0)
    best_score = F.col("m_0")
    for i in range(1, len(models)):
        better = F.col(f"m_{i}") > best_score if higher else F.col(f"m_{i}") < best_score
        better = F.coalesce(better, best_score.isNull())
        best = F.when(better, F.lit(i)).otherwise(best)
        best_score = F.when(better, F.col(f"m_{i}")).otherwise(best_score)
    rows = [
        F.struct(F.lit(n).alias("model"), F.col(f"m_{i}").alias("score"), (best == i).alias("champion"))
        for i, n in enumerate(models)
    ]
    return row.select(F.inline(F.array(*rows)))
