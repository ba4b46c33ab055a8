"""One model per group, for any number and any size of groups.

Elastic nets are fitted from per-group moments: one aggregation with partial sums reduces each group to
a row of d² numbers, whatever its size, and only those rows go through Python.  Forests per group are in
``forests``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.udfs import apply_groups
from millrace.operators.models import centred, moments
from millrace.session import sized_broadcast

L1_RATIOS = tuple(round(0.1 * i, 1) for i in range(11))


def elastic_net(cov: np.ndarray, alpha: float, l1_ratio: float, max_iter: int = 10_000, tol: float = 1e-12) -> np.ndarray:
    """Coordinate descent for ``1/(2n)·|y-Xw|² + alpha·l1·|w|₁ + alpha·(1-l1)/2·|w|²`` on centred second
    moments (features first, label last)."""
    q, c = cov[:-1, :-1], cov[:-1, -1]
    w = np.zeros(len(c))
    for _ in range(max_iter):
        step = 0.0
        for j in range(len(w)):
            rest = c[j] - q[j] @ w + q[j, j] * w[j]
            denom = q[j, j] + alpha * (1 - l1_ratio)
            new = np.sign(rest) * max(abs(rest) - alpha * l1_ratio, 0.0) / denom if denom > 0 else 0.0
            step = max(step, abs(new - w[j]))
            w[j] = new
        if step <= tol:
            break
    return w


def _mse(cov: np.ndarray, w: np.ndarray) -> float:
    full = np.append(-w, 1.0)
    return float(max(full @ cov @ full, 0.0))


def fit_groups(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    alpha: float = 1.0,
    l1_ratios: Sequence[float] = L1_RATIOS,
) -> DataFrame:
    """``(key, n_used, l1_ratio, coefficients, intercept, mse, trials)`` with one row per group.

    Every ratio is tried and the one with the lowest training error kept, the first on ties.  The sums
    are shifted by the overall means so that centring them per group loses no precision.
    """
    features = list(features)
    cols = [*features, label]
    overall = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = {c: overall[f"m{i}"] or 0.0 for i, c in enumerate(cols)}
    level = np.array([shift[c] for c in cols])
    ratios = list(l1_ratios)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]  # the one moment row of the group
        n, mean, cov = centred(row, len(cols))
        tried = []
        for ratio in ratios:
            w = elastic_net(cov, alpha, ratio)
            tried.append((_mse(cov, w), ratio, w))
        mse, ratio, w = min(tried, key=lambda t: t[0])
        at = mean + level
        return pd.DataFrame(
            {
                key: [row[key]],
                "n_used": [n],
                "l1_ratio": [ratio],
                "coefficients": [list(map(float, w))],
                "intercept": [float(at[-1] - w @ at[:-1])],
                "mse": [mse],
                "trials": [[{"l1_ratio": r, "mse": m} for m, r, _ in tried]],
            }
        )

    type_ = df.schema[key].dataType.simpleString()
    schema = (
        f"{key} {type_}, n_used bigint, l1_ratio double, coefficients array<double>, intercept double, "
        "mse double, trials array<struct<l1_ratio:double,mse:double>>"
    )
    return apply_groups(moments(df, features, label, by=[key], shift=shift), key, solve, schema)


def fit_groups_ols(df: DataFrame, key: str, feature: str, label: str) -> DataFrame:
    """One-feature least squares per group by the built-in regression aggregates."""
    x, y = F.col(feature).cast("double"), F.col(label).cast("double")
    n, slope = F.regr_count(y, x), F.regr_slope(y, x)
    residual = F.regr_syy(y, x) - slope * F.regr_sxy(y, x)
    return df.groupBy(key).agg(
        n.alias("n_used"), slope.alias("slope"), F.regr_intercept(y, x).alias("intercept"), (residual / n).alias("mse")
    )


def group_run_rows(fitted: DataFrame, key: str, experiment: str, parent: str) -> DataFrame:
    """Run-log rows of fitted groups: one run per group, its trials as nested runs below it."""
    run_id = F.concat(F.lit(f"{experiment}-"), F.col(key).cast("string"))
    now = F.current_timestamp()
    tags = F.create_map(F.lit("group"), F.col(key).cast("string"))
    group = fitted.select(
        run_id.alias("run_id"),
        F.lit(parent).alias("parent_run_id"),
        F.lit(experiment).alias("experiment"),
        F.create_map(F.lit("l1_ratio"), F.col("l1_ratio").cast("string")).alias("params"),
        F.create_map(F.lit("mse"), F.col("mse")).alias("metrics"),
        tags.alias("tags"),
        now.alias("end_time"),
    )
    trial = fitted.select(key, run_id.alias("parent_run_id"), F.posexplode("trials").alias("i", "t")).select(
        F.concat("parent_run_id", F.lit("-trial-"), F.col("i").cast("string")).alias("run_id"),
        "parent_run_id",
        F.lit(experiment).alias("experiment"),
        F.create_map(F.lit("l1_ratio"), F.col("t.l1_ratio").cast("string")).alias("params"),
        F.create_map(F.lit("mse"), F.col("t.mse")).alias("metrics"),
        tags.alias("tags"),
        now.alias("end_time"),
    )
    return group.unionByName(trial)


def predict_groups(df: DataFrame, models: DataFrame, key: str, features: Sequence[str], out: str = "prediction") -> DataFrame:
    """Prediction of the row's own group model; NULL for a group without one.

    Coefficients are joined to the rows (sent to them when proven few), the dot product is an expression."""
    small = sized_broadcast(models.select(key, F.col("coefficients").alias("_w"), F.col("intercept").alias("_b")))
    dot = F.col("_b")
    for i, f in enumerate(features):
        dot = dot + F.col(f).cast("double") * F.col("_w")[i]
    return df.join(small, key, "left").withColumn(out, dot).drop("_w", "_b")
