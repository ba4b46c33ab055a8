"""Feature preparation: encoders and scalers are fitted by one small aggregation and applied as
expressions, so applying them costs no shuffle and no Python."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import select_by_type


def fit_categories(df: DataFrame, cols: Iterable[str], max_categories: int = 1000) -> dict[str, list[str]]:
    """Sorted distinct non-NULL values of each column, at most ``max_categories`` per column.

    All columns share one pass; only distinct values are shuffled and no more than
    ``max_categories + 1`` per column reach the driver.  More categories than that is an error.
    """
    cols = list(cols)
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])
    distinct = df.select(F.inline(pairs)).filter("v IS NOT NULL").distinct()
    first = F.row_number().over(Window.partitionBy("c").orderBy("v"))
    found: dict[str, list[str]] = {c: [] for c in cols}
    for r in distinct.withColumn("_n", first).filter(F.col("_n") <= max_categories + 1).collect():
        found[r["c"]].append(r["v"])
    for c, values in found.items():
        if len(values) > max_categories:
            raise ValueError(f"column {c!r} has more than {max_categories} categories")
        values.sort()
    return found


def apply_one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each categorical column by one 0/1 double per category, named ``<column>_<value>`` with
    spaces as underscores; NULL and unseen values give all zeros."""
    keep = [F.col(c) for c in df.columns if c not in categories]
    made, names = [], [c for c in df.columns if c not in categories]
    for c, values in categories.items():
        for v in values:
            name = f"{c}_{v}".replace(" ", "_")
            names.append(name)
            made.append(F.when(F.col(c).cast("string") == v, 1.0).otherwise(0.0).alias(name))
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"one-hot column names collide: {twice}")
    return df.select(*keep, *made)


def one_hot(df: DataFrame, cols: Iterable[str], max_categories: int = 1000) -> DataFrame:
    return apply_one_hot(df, fit_categories(df, cols, max_categories))


def one_hot_vector(cols: Sequence[str], out: Sequence[str]) -> Pipeline:
    """Pipeline stages that encode string columns as vectors; an unseen value becomes the zero vector.

    The indexer keeps unseen values as one extra last index, and the encoder drops its last slot, so
    that index is exactly the one without a slot."""
    index = StringIndexer(inputCols=list(cols), outputCols=[f"{c}__ix" for c in cols], handleInvalid="keep",
                          stringOrderType="alphabetAsc")
    encode = OneHotEncoder(inputCols=[f"{c}__ix" for c in cols], outputCols=list(out), dropLast=True)
    return Pipeline(stages=[index, encode])


def bin_right_closed(col: str | Column, edges: Sequence[float], labels: Sequence[int]) -> Column:
    """Label of the bin ``(edge[i], edge[i+1]]``; NULL outside all bins."""
    if len(labels) != len(edges) - 1 or list(edges) != sorted(set(edges)):
        raise ValueError("need increasing edges and one label per bin")
    col = F.col(col) if isinstance(col, str) else col
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        cond = (col > lo) & (col <= hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def fit_minmax(df: DataFrame, cols: Iterable[str]) -> dict[str, tuple[float, float]]:
    cols = list(cols)
    row = df.agg(*[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}


def apply_minmax(df: DataFrame, stats: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Scale to [0, 1] by the fitted range (values beyond it leave the interval); constant columns give 0."""
    made = {}
    for c, (lo, hi) in stats.items():
        if lo is None or hi == lo:
            made[c] = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            made[c] = (F.col(c).cast("double") - F.lit(lo)) / F.lit(hi - lo)
    return df.withColumns(made)


def minmax(train: DataFrame, other: DataFrame, cols: Iterable[str], refit: bool = False) -> DataFrame:
    """Scale ``other`` by the range of ``train``, or by its own with ``refit``."""
    return apply_minmax(other, fit_minmax(other if refit else train, cols))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


def numeric_features(df: DataFrame, key: str, label: str) -> DataFrame:
    """Key plus every double column except the label."""
    return select_by_type(df, [T.DoubleType], keep=[key], exclude=[label])


TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def tokens(text: str | Column) -> Column:
    """Lower-cased runs of letters and digits."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(col), TOKEN_BREAK), lambda t: t != "")


def tokenize(df: DataFrame, text: str, out: str = "tokens", max_len: int | None = None) -> DataFrame:
    """Token array; ``max_len`` truncates it as a model with a fixed input length does."""
    col = tokens(text)
    return df.withColumn(out, F.slice(col, 1, max_len) if max_len else col)
