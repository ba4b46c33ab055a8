"""Fitting, searching, combining and scoring models on Spark."""

from __future__ import annotations

import math
import re
import time
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.metrics import classification_metrics, corr_matrix, regression_metrics
from millrace.operators.splits import split
from millrace.session import spread


@dataclass(frozen=True)
class LinearModel:
    """A linear predictor that is an expression on Spark and a ``predict`` in pandas."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        out = F.lit(float(self.intercept))
        for name, w in zip(self.features, self.coefficients):
            out = out + F.col(name).cast("double") * F.lit(float(w))
        return out

    def predict(self, pdf):
        return pdf[list(self.features)].to_numpy(dtype=float) @ np.asarray(self.coefficients) + self.intercept

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.column())


@dataclass(frozen=True)
class MeanModel:
    """Predicts the training mean of the label for every row."""

    mean: float

    def predict(self, pdf):
        return np.full(len(pdf), self.mean)

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, F.lit(self.mean))


def fit_mean(df: DataFrame, label: str) -> MeanModel:
    mean = df.agg(F.avg(label)).first()[0]
    if mean is None:
        raise ValueError(f"no label value in {label!r}")
    return MeanModel(float(mean))


def moments(df: DataFrame, features: Sequence[str], label: str, by: Iterable[str] = (), shift: Mapping[str, float] | None = None) -> DataFrame:
    """Sufficient statistics of a least-squares fit: n, sums, and the upper triangle of the cross
    products, per group.  One partial aggregation whatever the group sizes; the result is one row of
    d² numbers per group.  ``shift`` is subtracted first to keep the sums well conditioned."""
    cols = [*features, label]
    complete = df.dropna(subset=cols)
    at = {c: F.col(c).cast("double") - F.lit(float((shift or {}).get(c, 0.0))) for c in cols}
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(at[c]).alias(f"s_{i}") for i, c in enumerate(cols)]
    aggs += [F.sum(at[a] * at[b]).alias(f"p_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    return complete.groupBy(*by).agg(*aggs)


def centred(row, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """n, means and centred second moments (divided by n) from one moment row of d columns."""
    n = int(row["n"])
    mean = np.array([row[f"s_{i}"] for i in range(d)], dtype=float) / n
    cov = np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            cov[i, j] = cov[j, i] = row[f"p_{i}_{j}"] / n - mean[i] * mean[j]
    return n, mean, cov


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> LinearModel:
    """Ordinary least squares from one pass for the means and one for the centred moments."""
    features = list(features)
    cols = [*features, label]
    first = df.dropna(subset=cols).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    if first["m0"] is None:
        raise ValueError("no complete row to fit on")
    shift = {c: first[f"m{i}"] for i, c in enumerate(cols)}
    _, mean, cov = centred(moments(df, features, label, shift=shift).first(), len(cols))
    w = np.linalg.lstsq(cov[:-1, :-1], cov[:-1, -1], rcond=None)[0]
    level = mean + np.array([shift[c] for c in cols])
    return LinearModel(tuple(features), tuple(float(x) for x in w), float(level[-1] - w @ level[:-1]))


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    max_depth: int = 3,
    num_trees: int = 20,
    min_leaf_fraction: float = 0.0,
    feature_fraction: float | None = None,
    seed: int = 42,
) -> PipelineModel:
    """Random-forest regressor.

    ``min_leaf_fraction`` is the least share of the rows in a leaf.  A minimum share of rows for a node to
    be split has no counterpart in Spark's trees and is implied only by the leaf rule.

    If many rows are equal in features and label, the forest is fitted on lots of equal rows, which weigh as many: its time and
    memory then follow the different rows.  Every row counts; a tree's bootstrap draws the rows of a lot together.
    """
    rows, n = _in_lots(df, [*features, label])
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=label,
        maxDepth=max_depth,
        numTrees=num_trees,
        featureSubsetStrategy=str(feature_fraction) if feature_fraction else "auto",
        seed=seed,
    )
    if rows is not None and min_leaf_fraction < 0.5:  # Spark's limit for shares of weights
        forest.setWeightCol("_rows").setMinWeightFractionPerNode(float(min_leaf_fraction or 0.0))
    else:
        rows = df
        forest.setMinInstancesPerNode(max(1, math.ceil((min_leaf_fraction or 0.0) * n)))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, forest]).fit(spread(rows))


def _in_lots(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame | None, int]:
    """``columns`` and ``_rows``, and the number of rows: n equal rows become ``_PARTS`` lots of nearly the same number (fewer if
    n is less, more if a lot would get more than ``_MOST``).  None in place of the lots unless they are at most half the rows.

    Equal rows cannot be told apart, so no key decides which of them share a lot."""
    wide = df.select(*columns)
    stat = wide.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*columns), 0.02).alias("d")).first()
    if 2 * _PARTS * stat["d"] > stat["n"]:
        return None, stat["n"]
    lots = F.least(F.col("_all"), F.greatest(F.lit(_PARTS), F.ceil(F.col("_all") / _MOST)))
    merged = wide.groupBy(*columns).agg(F.count(F.lit(1)).alias("_all")).withColumn("_lots", lots)
    cut = merged.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_lots") - 1)))
    share = F.floor((F.col("_all") - 1 - F.col("_at")) / F.col("_lots")) + 1
    return cut.select(*columns, share.cast("double").alias("_rows")), stat["n"]


def _candidates(task: str, label: str, width: int, seed: int) -> list[tuple[str, dict, object]]:
    """Trials in the order they are tried: every family once before a second setting of any."""
    common = {"featuresCol": "features", "labelCol": label}
    if task == "regressor":
        return [
            ("LinearRegression", {"regParam": 0.0}, LinearRegression(**common, regParam=0.0)),
            ("RandomForestRegressor", {"maxDepth": 5}, RandomForestRegressor(**common, maxDepth=5, seed=seed)),
            ("GBTRegressor", {"maxIter": 10}, GBTRegressor(**common, maxIter=10, seed=seed)),
            ("LinearRegression", {"regParam": 0.1, "elasticNetParam": 0.5},
             LinearRegression(**common, regParam=0.1, elasticNetParam=0.5)),
            ("RandomForestRegressor", {"maxDepth": 8}, RandomForestRegressor(**common, maxDepth=8, seed=seed)),
            ("GBTRegressor", {"maxIter": 20}, GBTRegressor(**common, maxIter=20, seed=seed)),
        ]
    if task == "classifier":
        return [
            ("LogisticRegression", {"regParam": 0.0}, LogisticRegression(**common, regParam=0.0)),
            ("RandomForestClassifier", {"maxDepth": 5}, RandomForestClassifier(**common, maxDepth=5, seed=seed)),
            ("GBTClassifier", {"maxIter": 10}, GBTClassifier(**common, maxIter=10, seed=seed)),
            ("MultilayerPerceptronClassifier", {"layers": f"{width},16,2"},
             MultilayerPerceptronClassifier(**common, layers=[width, 16, 2], maxIter=30, seed=seed)),
            ("LogisticRegression", {"regParam": 0.1}, LogisticRegression(**common, regParam=0.1)),
            ("RandomForestClassifier", {"maxDepth": 8}, RandomForestClassifier(**common, maxDepth=8, seed=seed)),
        ]
    raise ValueError(f"unknown task {task!r}")


_PARTS = 64  # of the rows, by their key: equal rows of a part are drawn together by a forest's bootstrap
_MOST = 4096  # equal rows in one merged row


def _merged(rows: DataFrame, columns: Sequence[str], key: str, parts: int, seed: int) -> DataFrame:
    """``rows`` with ``_rows``, how many equal rows of ``columns`` each stands for, ``_MOST`` at most; without their key.  Rows
    stay as they are, ``_rows`` 1, unless merging makes them at most half as many."""
    part = F.pmod(F.xxhash64(F.col(key), F.lit(f"part-{seed}")), F.lit(parts)).cast("int")
    wide = rows.select(*columns, part.alias("_part"))
    stat = wide.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*wide.columns), 0.02).alias("d")).first()
    if 2 * stat["d"] > stat["n"]:
        return spread(wide.drop("_part")).withColumn("_rows", F.lit(1.0))
    merged = wide.groupBy(*wide.columns).agg(F.count(F.lit(1)).alias("_all"))
    cut = merged.select(*columns, "_all", F.explode(F.sequence(F.lit(0), F.floor((F.col("_all") - 1) / _MOST))).alias("_at"))
    return spread(cut.select(*columns, F.least(F.lit(_MOST), F.col("_all") - F.col("_at") * _MOST).cast("double").alias("_rows")))


def _each(merged: DataFrame) -> DataFrame:
    """Every row that merged ones stand for."""
    return merged.withColumn("_rows", F.explode(F.array_repeat(F.lit(1.0), F.col("_rows").cast("int"))))


# Direction of every metric a search can be steered by.
HIGHER_IS_BETTER = {"mse": False, "rmse": False, "mae": False, "r2": True,
                    "accuracy": True, "f1": True, "precision": True, "recall": True}


@dataclass
class SearchResult:
    best: PipelineModel
    best_run: str
    metric: str
    trials: list[dict]
    models: dict[str, PipelineModel]

    def leaderboard(self, spark) -> DataFrame:
        """One row per trial, best first."""
        rows = sorted(
            ((t["run_id"], t["family"], t["params"], t["metrics"][self.metric]) for t in self.trials),
            key=lambda t: -t[3] if HIGHER_IS_BETTER[self.metric] else t[3],
        )
        rows = [(i + 1, *r) for i, r in enumerate(rows)]
        return spark.createDataFrame(rows, "rank int, run_id string, family string, params map<string,string>, score double")


def auto_fit(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    target: str,
    task: str,
    metric: str | None = None,
    exclude: Iterable[str] = (),
    max_trials: int = 6,
    validation: float = 0.25,
    seed: int = 42,
) -> SearchResult:
    """Try model families on a train/validation split by key digest and keep the best.

    A missing feature is filled with its mean over the labelled rows, in training and in the returned
    models alike, so a searched model scores every row it is given.

    The budget is a number of trials.  Each trial is a Spark ML fit over the whole training split,
    which is read from the cached split, not from the source, and all validation metrics of a trial
    come from one aggregation.

    If many rows are equal in features and label, they are merged first and weigh as many: a fit's time then follows the
    different rows.  Linear and boosted models are the same up to rounding; a forest draws equal rows of the same
    ``_PARTS``-th of the keys together.  Models without weights get every row, and each row counts in the metrics.
    """
    metric = metric or ("rmse" if task == "regressor" else "f1")
    features = [f for f in features if f not in set(exclude) | {key, target}]
    known = df.dropna(subset=[target])
    filled = [f"_filled_{f}" for f in features]
    imputer = Imputer(inputCols=features, outputCols=filled, strategy="mean").fit(known)
    assembler = VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep")
    ready = imputer.transform(known).select(key, *filled, F.col(target).cast("double").alias(target))
    # a seed of its own: the rows may already be one side of a split by the same key
    train, held = split(ready, key, [1 - validation, validation], f"search-{seed}")
    train, held = (
        assembler.transform(_merged(side, [*filled, target], key, parts, seed)).select("features", target, "_rows").persist()
        for side, parts in ((train, _PARTS), (held, 1))
    )
    measure = regression_metrics if task == "regressor" else classification_metrics
    trials, best, models = [], None, {}
    try:
        for i, (family, params, estimator) in enumerate(_candidates(task, target, len(features), seed)[:max_trials]):
            weighs = estimator.hasParam("weightCol")
            fitted = without_summary(estimator.setWeightCol("_rows").fit(train) if weighs else estimator.fit(_each(train)))
            row = measure(_each(fitted.transform(held).select(target, "prediction", "_rows")), target, "prediction").first().asDict()
            metrics = {k: float(v) for k, v in row.items() if v is not None}
            run = {"run_id": f"trial-{i:03d}", "family": family, "params": {"regressor": family, **{k: str(v) for k, v in params.items()}},
                   "metrics": metrics, "end_time": time.time()}
            trials.append(run)
            models[run["run_id"]] = PipelineModel(stages=[imputer, assembler, fitted])
            score = metrics.get(metric)
            if score is None:
                continue
            sign = -1 if HIGHER_IS_BETTER[metric] else 1
            if best is None or sign * score < best[0]:
                best = (sign * score, run["run_id"])
    finally:
        train.unpersist()
        held.unpersist()
    if best is None:
        raise RuntimeError(f"no trial produced metric {metric!r}")
    return SearchResult(models[best[1]], best[1], metric, trials, models)


def without_summary(model):
    """The fitted model without its training summary.

    A summary keeps the session, and a session that has run an ``Observation`` cannot be serialized, so a
    model that still holds one cannot score rows any more ("Task not serializable")."""
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


@dataclass(frozen=True)
class FilledModel:
    """A searched regressor in pandas: features are filled with their means, then meet coefficients or trees.

    A tree is (feature, threshold, left, right, value) by node, the root first; a leaf's feature is -1."""

    features: tuple[str, ...]
    fills: tuple[float, ...]
    coefficients: tuple[float, ...] = ()
    intercept: float = 0.0
    trees: tuple[tuple[np.ndarray, ...], ...] = ()
    weights: tuple[float, ...] = ()

    def predict(self, pdf):
        x = pdf[list(self.features)].to_numpy(dtype=float)
        x = np.where(np.isnan(x), np.asarray(self.fills), x)
        if not self.trees:
            return x @ np.asarray(self.coefficients) + self.intercept
        out, rows = np.zeros(len(x)), np.arange(len(x))
        for weight, (feature, threshold, left, right, value) in zip(self.weights, self.trees):
            at = np.zeros(len(x), np.int64)
            while (feature[at] >= 0).any():
                down = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
                at = np.where(feature[at] >= 0, down, at)
            out += weight * value[at]
        return out


def in_pandas(model: PipelineModel) -> FilledModel:
    """A regressor of ``auto_fit`` as a model with ``predict``, which a SQL function can call."""
    imputer, _, fitted = model.stages
    features = tuple(imputer.getInputCols())
    row = imputer.surrogateDF.first()
    fills = tuple(float(row[f]) for f in features)
    if hasattr(fitted, "coefficients"):
        return FilledModel(features, fills, tuple(float(w) for w in fitted.coefficients), float(fitted.intercept))
    trees = tuple(_nodes(text) for text in re.split(r"\n\s*Tree \d+ .*:\n", fitted.toDebugString)[1:])
    weights = [float(w) for w in fitted.treeWeights]
    if "RandomForest" in type(fitted).__name__:  # a forest's trees are averaged, boosted ones added up
        weights = [1.0 / len(trees)] * len(trees)
    return FilledModel(features, fills, trees=trees, weights=tuple(weights))


def _nodes(text: str) -> tuple[np.ndarray, ...]:
    """The nodes of one tree from Spark's text of it, where a node is followed by its left, then its right side."""
    nodes: list[list] = []
    rights: list[int] = []  # nodes whose right side is still to come
    after = None
    for line in filter(None, map(str.strip, text.splitlines())):
        if line.startswith("Else"):
            after = rights.pop()
            continue
        if after is not None:
            nodes[after][3], after = len(nodes), None
        if line.startswith("Predict: "):
            nodes.append([-1, 0.0, 0, 0, float(line[9:])])
            continue
        found = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
        if not found:
            raise ValueError(f"no split at a threshold: {line}")
        rights.append(len(nodes))
        nodes.append([int(found[1]), float(found[2]), len(nodes) + 1, 0, 0.0])
    feature, threshold, left, right, value = zip(*nodes)
    return np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value)


def vote(cols: Sequence[str]) -> Column:
    """Mean of the members' prediction columns; NULL when a member has none."""
    out = F.col(cols[0])
    for c in cols[1:]:
        out = out + F.col(c)
    return out / len(cols)


def least_correlated(df: DataFrame, cols: Sequence[str], best: str, k: int) -> DataFrame:
    """The ``k`` prediction columns least correlated with that of the best model."""
    pairs = corr_matrix(df, cols).filter((F.col("col_a") == best) & (F.col("col_b") != best))
    return (
        pairs.select(F.col("col_b").alias("model"), F.abs("corr").alias("abs_corr"))
        .orderBy("abs_corr", "model")
        .limit(k)
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
