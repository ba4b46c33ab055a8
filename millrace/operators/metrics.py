"""Quality metrics and templated custom metrics; every function is one aggregation over its input."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _columns(y: str, p: str) -> tuple[Column, Column]:
    """Label and prediction as doubles; a row lacking either is left out of both."""
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    return F.when(both, F.col(y).cast("double")), F.when(both, F.col(p).cast("double"))


def regression_aggs(y: str, p: str) -> dict[str, Column]:
    yc, pc = _columns(y, p)
    sse = F.sum((yc - pc) * (yc - pc))
    n = F.count(yc)
    spread = F.var_pop(yc) * n
    mse = F.when(n > 0, sse / n)
    return {
        "n": n,
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mae": F.avg(F.abs(yc - pc)),
        "r2": F.when(spread > 0, 1 - sse / spread),
    }


def classification_aggs(y: str, p: str) -> dict[str, Column]:
    yc, pc = _columns(y, p)
    n = F.count(yc)
    tp = F.count_if((yc == 1) & (pc == 1))
    predicted, actual = F.count_if(pc == 1), F.count_if(yc == 1)
    return {
        "n": n,
        "accuracy": F.when(n > 0, F.count_if(yc == pc) / n),
        "precision": F.when(predicted > 0, tp / predicted).otherwise(F.lit(0.0)),
        "recall": F.when(actual > 0, tp / actual).otherwise(F.lit(0.0)),
        "f1": F.when(predicted + actual > 0, 2 * tp / (predicted + actual)).otherwise(F.lit(0.0)),
    }


def regression_metrics(df: DataFrame, y: str, p: str, by: Iterable[str] = ()) -> DataFrame:
    """n, mse, rmse, mae and R² where label and prediction are both present (R² is NULL for a constant label)."""
    return df.groupBy(*by).agg(*[c.alias(a) for a, c in regression_aggs(y, p).items()])


def classification_metrics(df: DataFrame, y: str, p: str, by: Iterable[str] = ()) -> DataFrame:
    """accuracy over all classes; precision, recall and F1 of class 1 (0 where undefined)."""
    return df.groupBy(*by).agg(*[c.alias(a) for a, c in classification_aggs(y, p).items()])


def evaluate(df: DataFrame, y: str, p: str, task: str, by: Iterable[str] = ()) -> DataFrame:
    """Default metrics of a fitted model on held-out rows."""
    if task == "regressor":
        return regression_metrics(df, y, p, by)
    if task == "classifier":
        return classification_metrics(df, y, p, by)
    raise ValueError(f"unknown task {task!r}")


def to_class(col: str | Column) -> Column:
    """Rounded probability as class; a half goes to the even neighbour."""
    col = F.col(col) if isinstance(col, str) else col
    return F.rint(col).cast("int")


def _corr(a: str, b: str) -> Column:
    """Correlation over the rows that have both values; NULL for a constant column, where the built-in
    aggregate divides by zero under ANSI rules."""
    x, y = (F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(c).cast("double")) for c in (a, b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_matrix(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Pearson correlation of every column pair as ``(col_a, col_b, corr)``, both triangles, one pass."""
    cols = list(cols)
    pairs = list(combinations_with_replacement(cols, 2))
    one = df.agg(*[_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"c{i}").alias("corr")))
    return one.select(F.inline(F.array(*cells)))


@dataclass(frozen=True)
class Metric:
    """``aggregate`` metrics are aggregate expressions over table columns, ``derived`` ones use other
    metrics by name, ``drift`` ones compare ``{{current_df}}.x`` with ``{{base_df}}.x``."""

    type: str
    name: str
    input_columns: tuple[str, ...]
    definition: str
    output_type: str = "double"

    def text(self, column: str) -> str:
        return self.definition.replace("{{input_column}}", column)


def _suffix(metric: Metric, column: str) -> str:
    return metric.name if len(metric.input_columns) == 1 else f"{metric.name}_{column}"


def custom_aggs(metrics: Iterable[Metric]) -> list[Column]:
    return [
        F.expr(m.text(c)).cast(m.output_type).alias(_suffix(m, c))
        for m in metrics
        if m.type == "aggregate"
        for c in m.input_columns
    ]


def add_derived(df: DataFrame, metrics: Iterable[Metric]) -> DataFrame:
    """Derived metrics in the order given; each may use the ones before it."""
    for m in metrics:
        if m.type == "derived":
            for c in m.input_columns:
                df = df.withColumn(_suffix(m, c), F.expr(m.text(c)).cast(m.output_type))
    return df


def custom_metrics(df: DataFrame, metrics: Iterable[Metric], by: Iterable[str] = ()) -> DataFrame:
    metrics = list(metrics)
    return add_derived(df.groupBy(*by).agg(*custom_aggs(metrics)), metrics)


def custom_drift(current: DataFrame, base: DataFrame, metrics: Iterable[Metric], on: Iterable[str] = (), keep: Iterable[str] = ()) -> DataFrame:
    """Drift metrics of metric rows against base metric rows: joined on ``on``, or against the one base
    row there is when ``on`` is empty.  ``keep`` names further columns of the current rows to carry."""
    on, cur, bas = list(on), current.alias("_cur"), base.alias("_base")
    if on:
        cond = F.lit(True)
        for c in on:
            cond = cond & F.col(f"_cur.{c}").eqNullSafe(F.col(f"_base.{c}"))
        joined = cur.join(bas, cond, "left")
    else:
        rows = base.limit(2).collect()
        if len(rows) != 1:
            raise ValueError("the base must be a single metric row when no join columns are given")
        one = [F.lit(rows[0][f.name]).cast(f.dataType).alias(f.name) for f in base.schema.fields]
        joined = current.select(F.struct(*[F.col(c) for c in current.columns]).alias("_cur"), F.struct(*one).alias("_base"))
    made = [
        F.expr(m.text(c).replace("{{current_df}}", "_cur").replace("{{base_df}}", "_base"))
        .cast(m.output_type)
        .alias(_suffix(m, c))
        for m in metrics
        if m.type == "drift"
        for c in m.input_columns
    ]
    return joined.select(*[F.col(f"_cur.{c}").alias(c) for c in dict.fromkeys([*on, *keep])], *made)
