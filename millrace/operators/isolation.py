"""Extended isolation forest (Liu, Ting, Zhou 2008; Hariri, Kind, Brunner 2018).

A tree sees a sample of a few hundred rows, so building is small; drawing the samples and scoring are the
passes over the data.  Sampling is one scan that sends each drawn row to its tree; trees are built in
parallel from bounded groups; the forest, whose size is set by its parameters and not by the data, is
sent to the scoring tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import uniform
from millrace.functions.udfs import apply_groups

_EULER = 0.5772156649015329
_SPARE = 1.3  # rows drawn per row needed, so that a tree's sample is complete with near certainty
_REMEMBERED = 1 << 17  # rows whose scores a task remembers
_FOREST_LIMIT = 64_000_000  # numbers in a forest that is still sent to every task


def mean_path(n: float) -> float:
    """Average path length of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + _EULER) - 2.0 * (n - 1) / n


@dataclass
class IsolationForest:
    features: tuple[str, ...]
    sample: int
    depth: int
    trees: list[dict]  # by node: normals (nodes x d), offsets, left, right, path

    def predict(self, pdf: pd.DataFrame) -> np.ndarray:
        x = pdf[list(self.features)].to_numpy(dtype=float)
        total = np.zeros(len(x))
        for t in self.trees:
            at = np.zeros(len(x), dtype=np.int32)
            for _ in range(self.depth):  # a leaf leads to itself
                if x.shape[1] <= 16:
                    cut = t["offsets"][at]
                    for j, column in enumerate(t["columns"]):
                        cut = cut - x[:, j] * column[at]
                    goes = cut >= 0
                else:
                    goes = np.einsum("ij,ij->i", x, t["normals"][at]) <= t["offsets"][at]
                at = np.where(goes, t["left"][at], t["right"][at])
            total += t["path"][at]
        return 2.0 ** (-(total / max(len(self.trees), 1)) / max(mean_path(self.sample), 1e-12))


def build_tree(x: np.ndarray, ext: int, limit: int, rng: np.random.Generator) -> dict:
    """Random oblique splits down to ``limit``; a cut's normal has ``ext + 1`` non-zero components and
    its intercept lies within the node's range."""
    d = x.shape[1]
    normals, offsets, left, right, path = [], [], [], [], []

    def grow(rows: np.ndarray, depth: int) -> int:
        me = len(left)
        left.append(me)
        right.append(me)
        normals.append(np.zeros(d))
        offsets.append(0.0)
        path.append(depth + mean_path(len(rows)))
        if depth >= limit or len(rows) <= 1:
            return me
        low, high = rows.min(axis=0), rows.max(axis=0)
        if (low == high).all():
            return me
        normal = rng.standard_normal(d)
        if ext + 1 < d:
            normal[rng.choice(d, d - ext - 1, replace=False)] = 0.0
        normals[me], offsets[me] = normal, float(rng.uniform(low, high) @ normal)
        goes = rows @ normal <= offsets[me]
        left[me] = grow(rows[goes], depth + 1)
        right[me] = grow(rows[~goes], depth + 1)
        return me

    grow(x, 0)
    return {"normals": np.array(normals), "offsets": np.array(offsets), "left": np.array(left), "right": np.array(right), "path": np.array(path)}


def fit_isolation_forest(
    df: DataFrame, key: str, features: Sequence[str], sample: int = 256, trees: int = 100, ext: int | None = None, seed: int = 123
) -> IsolationForest:
    """``ext`` is the extension level: 0 gives axis-parallel cuts, ``len(features) - 1`` (the default) fully
    oblique ones."""
    features = list(features)
    d = len(features)
    ext = d - 1 if ext is None else ext
    if not 0 <= ext < d:
        raise ValueError(f"extension level must lie in 0..{d - 1}")
    if trees * sample * d > _FOREST_LIMIT:
        raise ValueError("forest too large to send to the tasks: fewer trees, a smaller sample or fewer columns")
    ready = df.select(F.col(key).cast("string").alias("_key"), *[F.col(c).cast("double").alias(c) for c in features]).dropna()
    n = ready.count()
    if n == 0:
        raise ValueError("no complete row to fit on")
    # per row: in how many trees it is, then which, in the order of digests of row and tree
    rate = min(float(trees), trees * sample * _SPARE / n)
    whole = int(rate)
    times = F.lit(whole) + (uniform("_key", seed) < rate - whole).cast("int")
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(F.xxhash64(F.lit(seed), "_key", t).alias("_u"), t.alias("tree"))))
    drawn = ready.withColumn("_n", times).filter("_n > 0").select("_key", *features, F.inline(F.slice(ranked, 1, F.col("_n"))))
    limit = math.ceil(math.log2(max(min(sample, n), 2)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["_u", "_key"]).head(sample)  # the sample; the rest was drawn as spare
        tree = int(pdf["tree"].iloc[0])
        made = build_tree(rows[features].to_numpy(dtype=float), ext, limit, np.random.default_rng([seed, tree]))
        return pd.DataFrame({"tree": [tree], **{k: [v.ravel().tolist()] for k, v in made.items()}})

    schema = (
        "tree int, normals array<double>, offsets array<double>, left array<int>, right array<int>, path array<double>"
    )
    rows = apply_groups(drawn, "tree", build, schema).orderBy("tree").collect()  # one row per tree
    forest = []
    for r in rows:
        normals = np.array(r["normals"]).reshape(-1, d)
        forest.append(
            {
                "normals": normals,
                "columns": [np.ascontiguousarray(normals[:, j]) for j in range(d)] if d <= 16 else [],
                "offsets": np.array(r["offsets"]),
                "path": np.array(r["path"]),
                "left": np.array(r["left"], dtype=np.int32),
                "right": np.array(r["right"], dtype=np.int32),
            }
        )
    return IsolationForest(tuple(features), min(sample, n), limit, forest)


def _remembered(forest: IsolationForest, x: np.ndarray, memory: dict[bytes, float]) -> np.ndarray:
    """Scores of the rows of ``x``; equal rows pass through the trees once while ``memory`` has room for them."""
    wide, data = x.shape[1] * 8, np.ascontiguousarray(x).tobytes()
    keys = [data[a : a + wide] for a in range(0, len(data), wide)]
    new = {k: i for i, k in enumerate(keys) if k not in memory}
    found = forest.predict(pd.DataFrame(x[list(new.values())], columns=list(forest.features))) if new else np.zeros(0)
    here = dict(zip(new, found.tolist()))
    made = np.array([here[k] if k in here else memory[k] for k in keys])
    if len(memory) + len(here) <= _REMEMBERED:
        memory.update(here)
    return made


def score_isolation_forest(df: DataFrame, forest: IsolationForest, out: str = "score") -> DataFrame:
    """Anomaly score in (0, 1); rows with a missing feature get NULL."""
    features = list(forest.features)
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        memory: dict[bytes, float] = {}
        for x in batches:
            ready = x.notna().all(axis=1)
            made = pd.Series(np.nan, index=x.index)
            if ready.any():
                made[ready] = _remembered(shared.value, x.loc[ready, features].to_numpy(dtype=float), memory)
            yield made.astype(object).where(ready, None)

    return df.withColumn(out, score(F.struct(*[F.col(c).cast("double").alias(c) for c in features])))
