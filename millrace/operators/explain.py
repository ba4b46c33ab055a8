"""Permutation Shapley values of any model that scores a DataFrame.

A row is expanded into the masked inputs its explanation needs (features before a point in a permutation
from the row, the others from a background row), scored in bulk by the model's own ``transform``, and
folded back by one weighted sum per row.  Each permutation is used in both directions, so the values add
up to prediction minus base value exactly and are exact for additive models.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import spread


def explain(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    transform: Callable[[DataFrame], DataFrame],
    background: DataFrame,
    permutations: int = 5,
    seed: int = 42,
    prediction: str = "prediction",
    max_background: int = 200,
) -> DataFrame:
    """``(key, feature, shap, base_value)`` with one row per input row and feature.

    ``key`` must be unique.  ``background`` is a small table of reference rows (an error above
    ``max_background``).  Work grows with rows x permutations x (features + 1) x background rows.
    """
    features, d = list(features), len(features)
    rows = background.select(*[F.col(c).cast("double") for c in features]).dropna().limit(max_background + 1).collect()
    if not 0 < len(rows) <= max_background:
        raise ValueError(f"background needs 1 to {max_background} complete rows")
    rng = np.random.default_rng(seed)
    orders = []
    for _ in range(permutations):
        p = rng.permutation(d)
        orders += [p, p[::-1]]
    # place[p][i]: position of feature i in permutation p
    place = np.array([np.argsort(p) for p in orders])
    nb = len(rows)

    expanded = spread(df).select(
        F.col(key).alias("_key"),
        *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)],
        F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("_p"),
    )
    expanded = expanded.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(d))))
    expanded = expanded.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))

    def at(values, index):
        return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)

    masked = expanded.select(
        "_key", "_p", "_s",
        *[
            F.when(at([int(v) for v in place[:, i]], F.col("_p")) < F.col("_s"), F.col(f"_x{i}"))
            .otherwise(at([float(r[i]) for r in rows], F.col("_b")))
            .alias(c)
            for i, c in enumerate(features)
        ],
    )
    scored = transform(masked).select("_key", "_p", "_s", F.col(prediction).cast("double").alias("_f"))
    share = 1.0 / (len(orders) * nb)
    sums = []
    for i in range(d):
        pos = at([int(v) for v in place[:, i]], F.col("_p"))
        # the step after the feature's position has it switched on, the one at its position does not
        sign = F.when(F.col("_s") == pos + 1, F.col("_f")).when(F.col("_s") == pos, -F.col("_f")).otherwise(F.lit(0.0))
        sums.append((F.sum(sign) * share).alias(f"_v{i}"))
    base = (F.sum(F.when(F.col("_s") == 0, F.col("_f")).otherwise(0.0)) * share).alias("base_value")
    folded = scored.groupBy("_key").agg(base, *sums)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_v{i}").alias("shap")) for i, c in enumerate(features)])
    return folded.select(F.col("_key").alias(key), "base_value", F.inline(cells))


def summary(values: DataFrame) -> DataFrame:
    """Mean absolute value per feature."""
    return values.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
