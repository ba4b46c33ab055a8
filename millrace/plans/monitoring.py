"""Queries over profiles, slices, quality with late labels, drift, custom metrics and refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import with_constant, with_event_time
from millrace.functions.hashing import sql_bucket
from millrace.functions.udfs import model_udf
from millrace.operators.metrics import Metric, custom_drift, custom_metrics
from millrace.operators.models import LinearModel
from millrace.operators.monitor import (
    alerts,
    daily_profile,
    drift_categorical,
    drift_numeric,
    drift_previous,
    exact_quantiles,
    profile,
    quality,
    refresh,
    top_values,
    with_slices,
)
from millrace.operators.splits import split
from millrace.plans.registry import query, table
from millrace.plans.relational import REGRESSION_SQL, rounded
from millrace.plans.table_jobs import INFERENCE_SQL, fresh_tables, inference, late_labels, publish_log

SLICES = ["event_type", "value > 20"]
BASELINE_END = "2024-01-16"
PROFILE_ARGS = dict(numeric=["value", "label"], categorical=["event_type"], slices=SLICES, exact=True)

SLICED_SQL = f"""
  SELECT i.*, 'all' AS slice_key, 'all' AS slice_value FROM ({INFERENCE_SQL}) i
  UNION ALL SELECT i.*, 'event_type', event_type FROM ({INFERENCE_SQL}) i
  UNION ALL SELECT i.*, 'value > 20', (value > 20)::varchar FROM ({INFERENCE_SQL}) i
"""


def _profile_sql(source: str = SLICED_SQL, columns=("value", "label", "event_type"), digits=(8, 6)) -> str:
    numeric = f"""round(avg({{c}}), {digits[0]}) AS mean, round(stddev_samp({{c}}), {digits[1]}) AS stddev, min({{c}}) AS min, max({{c}}) AS max"""
    absent = "NULL::double AS mean, NULL::double AS stddev, NULL::double AS min, NULL::double AS max"
    return " UNION ALL ".join(
        f"""SELECT day, model_id, slice_key, slice_value, '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS n_null,
            {f'count(DISTINCT {c})' if c == 'event_type' else 'NULL::bigint'} AS n_distinct, {absent if c == 'event_type' else numeric.format(c=c)}
            FROM s GROUP BY 1, 2, 3, 4"""
        for c in columns
    ).join([f"WITH s AS ({source}) ", ""])


def shown(profiles: DataFrame) -> DataFrame:
    """Days as text; the sketched distinct counts of measured values are left to the tests."""
    df = profiles.withColumn("day", F.date_format("window_start", "yyyy-MM-dd")).drop("window_start")
    df = df.withColumn("n_distinct", F.when(F.col("column").isin(PROFILE_ARGS["categorical"]), F.col("n_distinct")))
    return rounded(df, mean=8, stddev=6)


@query("profile_metrics", _profile_sql())
def profile_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(profile(inference(spark, sf_dir), "timestamp", "1 day", **PROFILE_ARGS))


@query("profile_slices", f"SELECT slice_key, slice_value, count(*) AS n FROM ({SLICED_SQL}) GROUP BY 1, 2")
def profile_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_slices(inference(spark, sf_dir), SLICES).groupBy("slice_key", "slice_value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "profile_top_values",
    f"""SELECT day, slice_key, slice_value, value, n, rank FROM (
          SELECT day, slice_key, slice_value, event_type AS value, count(*) AS n,
            row_number() OVER (PARTITION BY day, slice_key, slice_value ORDER BY count(*) DESC, event_type) AS rank
          FROM ({SLICED_SQL}) GROUP BY 1, 2, 3, 4) WHERE rank <= 2""",
)
def profile_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = top_values(inference(spark, sf_dir), "timestamp", "1 day", "event_type", 2, SLICES)
    return df.withColumn("day", F.date_format("window_start", "yyyy-MM-dd")).drop("window_start")


@query(
    "profile_quantiles",
    f"""WITH r AS (SELECT day, value, row_number() OVER (PARTITION BY day ORDER BY value) AS k,
          count(*) OVER (PARTITION BY day) AS n FROM ({INFERENCE_SQL}))
        SELECT day, p AS prob, min(value) AS value FROM r, (VALUES (0.25::double), (0.5::double), (0.95::double)) v(p)
        WHERE k >= ceil(p * n) GROUP BY 1, 2""",
)
def profile_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_quantiles(inference(spark, sf_dir), ["day"], "value", [0.25, 0.5, 0.95])


@query(
    "quality_by_window",
    f"""SELECT day, event_type, {REGRESSION_SQL.replace(', 2) AS mse', ', 8) AS mse').replace(', 4)', ', 8)')} FROM (SELECT day, event_type, label AS y, prediction AS p
        FROM ({INFERENCE_SQL}) WHERE label IS NOT NULL) GROUP BY 1, 2""",
)
def quality_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality after the late labels were merged into the published log."""
    tables = fresh_tables(spark, "quality")
    publish_log(spark, sf_dir, tables)
    tables.merge_update("log", late_labels(spark, sf_dir), on="id", set_=["label"])
    df = quality(tables.read("log"), "timestamp", "1 day", "label", "prediction", by=["event_type"])
    df = df.withColumn("day", F.date_format("window_start", "yyyy-MM-dd")).drop("window_start")
    return rounded(df, mse=8, rmse=8, mae=8, r2=6)


# -- drift -----------------------------------------------------------------------------------------


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Drifted current rows (two event types become one new type) and baseline rows."""
    log = inference(spark, sf_dir)
    base = log.filter(F.col("day") < BASELINE_END)
    now = log.filter(F.col("day") >= BASELINE_END)
    kind = F.when(F.col("event_type").isin("error", "signup"), "failed").otherwise(F.col("event_type"))
    return now.withColumns({"event_type": kind, "value": F.col("value") * 1.1}), base


_NOW_SQL = f"""SELECT day, CASE WHEN event_type IN ('error', 'signup') THEN 'failed' ELSE event_type END AS kind, value * 1.1::double AS value,
  label FROM ({INFERENCE_SQL}) WHERE day >= '{BASELINE_END}'"""
_BASE_SQL = f"SELECT day, event_type AS kind, value, label FROM ({INFERENCE_SQL}) WHERE day < '{BASELINE_END}'"

_DRIFT_CAT_SQL = f"""
  WITH c AS (SELECT day, kind, count(*) AS c FROM ({_NOW_SQL}) GROUP BY 1, 2), b AS (SELECT kind, count(*) AS b FROM ({_BASE_SQL}) GROUP BY 1),
  grid AS (SELECT day, kind FROM (SELECT DISTINCT day FROM c), (SELECT kind FROM c UNION SELECT kind FROM b)),
  j AS (SELECT g.day, g.kind, coalesce(c, 0) AS c, coalesce(b, 0) AS b, sum(coalesce(c, 0)) OVER (PARTITION BY g.day) AS n,
        sum(coalesce(b, 0)) OVER (PARTITION BY g.day) AS nb
        FROM grid g LEFT JOIN c ON g.day = c.day AND g.kind = c.kind LEFT JOIN b ON g.kind = b.kind),
  s AS (SELECT *, c / n::double AS p, b / nb::double AS q FROM j WHERE c > 0 OR b > 0),
  t AS (SELECT *, greatest(p, 1e-6) AS fp, greatest(q, 1e-6) AS fq, (p + q) / 2 AS m FROM s)
  SELECT day, 'event_type' AS "column", round(sum(abs(p - q)) / 2, 6) AS total_variation, round(sum((fp - fq) * ln(fp / fq)), 6) AS psi,
    round(sum(CASE WHEN p > 0 THEN p * log2(p / m) / 2 ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / m) / 2 ELSE 0 END), 6) AS js_divergence,
    round(sum(CASE WHEN q > 0 THEN pow(c - q * n, 2) / (q * n) END), 4) AS chi_square,
    round(sum(CASE WHEN q = 0 THEN p ELSE 0 END), 6) AS unseen_share FROM t GROUP BY 1
"""


@query("drift_categorical", _DRIFT_CAT_SQL)
def categorical_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the second half against the baseline half."""
    now, base = _sides(spark, sf_dir)
    df = drift_categorical(now, base, ["event_type"], by=["day"])
    return rounded(df, total_variation=6, psi=6, js_divergence=6, chi_square=4, unseen_share=6)


def _ks_sql(col: str) -> str:
    return f"""SELECT max(abs(f - g)) FROM (SELECT v, sum(c) OVER (ORDER BY v) / (SELECT count({col}) FROM n)::double AS f,
      sum(b) OVER (ORDER BY v) / (SELECT count({col}) FROM b)::double AS g FROM (
        SELECT v, sum(c) AS c, sum(b) AS b FROM (SELECT {col} AS v, 1 AS c, 0 AS b FROM n WHERE {col} IS NOT NULL
          UNION ALL SELECT {col}, 0, 1 FROM b WHERE {col} IS NOT NULL) GROUP BY 1))"""


_DRIFT_NUM_SQL = f"WITH n AS ({_NOW_SQL}), b AS ({_BASE_SQL}) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT count(*) FROM n) - (SELECT count(*) FROM b) AS count_delta,
        round((SELECT 1 - count({c}) / count(*)::double FROM n) - (SELECT 1 - count({c}) / count(*)::double FROM b), 6) AS null_share_delta,
        round((SELECT avg({c}) FROM n) - (SELECT avg({c}) FROM b), 5) AS mean_delta, round(({_ks_sql(c)}), 6) AS ks"""
    for c in ("value", "label")
)


@query("drift_numeric", _DRIFT_NUM_SQL)
def numeric_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    now, base = _sides(spark, sf_dir)
    df = drift_numeric(now, base, ["value", "label"])
    return rounded(df, null_share_delta=6, mean_delta=5, ks=6)


@query(
    "drift_consecutive",
    f"""WITH p AS ({_profile_sql(digits=(12, 12))}), l AS (SELECT *, lag(day) OVER w AS previous, n - lag(n) OVER w AS n_delta, n_null - lag(n_null) OVER w AS n_null_delta,
          round(mean - lag(mean) OVER w, 8) AS mean_delta, round(stddev - lag(stddev) OVER w, 6) AS stddev_delta FROM p
          WINDOW w AS (PARTITION BY model_id, slice_key, slice_value, "column" ORDER BY day))
        SELECT day, previous, model_id, slice_key, slice_value, "column", n_delta, n_null_delta, mean_delta, stddev_delta
        FROM l WHERE previous IS NOT NULL""",
)
def drift_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = drift_previous(profile(inference(spark, sf_dir), "timestamp", "1 day", **PROFILE_ARGS))
    days = {"day": F.date_format("window_start", "yyyy-MM-dd"), "previous": F.date_format("previous_start", "yyyy-MM-dd")}
    return rounded(df.withColumns(days).drop("window_start", "previous_start"), mean_delta=8, stddev_delta=6)


# The metric definitions whose results must agree.
CUSTOM = [
    Metric("aggregate", "log_avg", ("price",), "avg(log(abs(`{{input_column}}`)+1))"),
    Metric("derived", "exp_log", ("price",), "exp(log_avg)"),
    Metric("drift", "delta_exp", ("price",), "{{current_df}}.exp_log - {{base_df}}.exp_log"),
]
_CUSTOM_SQL = "avg(ln(abs(l_extendedprice) + 1)) AS log_avg, exp(avg(ln(abs(l_extendedprice) + 1))) AS exp_log"


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("price"), "l_returnflag")


@query(
    "custom_metrics",
    f"SELECT l_returnflag, round(log_avg, 6) AS log_avg, round(exp_log, 4) AS exp_log FROM (SELECT l_returnflag, {_CUSTOM_SQL} FROM lineitem GROUP BY 1)",
)
def metrics_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(custom_metrics(prices(spark, sf_dir), CUSTOM, by=["l_returnflag"]), log_avg=6, exp_log=4)


@query(
    "custom_drift",
    f"""SELECT l_returnflag, round(exp_log - (SELECT exp_log FROM (SELECT {_CUSTOM_SQL} FROM lineitem)), 4) AS delta_exp
        FROM (SELECT l_returnflag, {_CUSTOM_SQL} FROM lineitem GROUP BY 1)""",
)
def drift_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each return flag's metric against that of the whole table."""
    df = prices(spark, sf_dir)
    base = custom_metrics(df, CUSTOM)
    current = custom_metrics(df, CUSTOM, by=["l_returnflag"])
    return rounded(custom_drift(current, base, CUSTOM, keep=["l_returnflag"]), delta_exp=4)


# -- scoring batches, refresh, alerts --------------------------------------------------------------

EVENT_MODEL = LinearModel(("value",), (2.0,), 1.0)
BATCH_EPOCHS = (1706745600, 1706832000)  # 2024-02-01 and 2024-02-02, 00:00 UTC


@query(
    "inference_log",
    f"""SELECT event_id AS id, CASE WHEN first THEN 2 * value + 1 ELSE 2 * 1.0 + 1 END::double AS prediction, 'v1' AS model_id, NULL::double AS label,
          CASE WHEN first THEN event_type WHEN event_type = 'click' THEN 'super click' ELSE event_type END AS event_type,
          CASE WHEN first THEN '2024-02-01' ELSE '2024-02-02' END AS day
        FROM (SELECT *, {sql_bucket('event_id', 42, 10000)} < 5000 AS first FROM events)""",
)
def inference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two simulated scoring batches a day apart, the second with drifted features, in one log."""
    tables = fresh_tables(spark, "inference-log")
    first, second = split(table(spark, sf_dir, "events"), "event_id", [0.5, 0.5])
    second = second.withColumns(
        {"event_type": F.when(F.col("event_type") == "click", "super click").otherwise(F.col("event_type")), "value": F.lit(1.0)}
    )
    predict = model_udf(EVENT_MODEL, EVENT_MODEL.features)
    for batch, epoch in zip((first, second), BATCH_EPOCHS):
        df = batch.select(F.col("event_id").alias("id"), "event_type", predict("value").alias("prediction"))
        df = with_event_time(with_constant(df, "model_id", "v1", "string"), "timestamp", epoch)
        if not tables.exists("log"):
            df = with_constant(df, "label", None, "double")
        tables.append("log", df)
    out = tables.read("log")
    return out.withColumn("day", F.date_format("timestamp", "yyyy-MM-dd")).drop("timestamp")


@query(
    "refresh_incremental",
    _profile_sql(
        f"""SELECT i.*, 'all' AS slice_key, 'all' AS slice_value FROM ({INFERENCE_SQL} WHERE true UNION ALL
            SELECT * REPLACE (id + 1000000 AS id) FROM ({INFERENCE_SQL}) WHERE day >= '2024-01-29') i"""
    ),
)
def refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels merged and the last days scored again; only changed days are profiled anew, and the
    published profile equals a full recomputation."""
    args = {**PROFILE_ARGS, "slices": []}
    tables = fresh_tables(spark, "refresh")
    publish_log(spark, sf_dir, tables)
    tables.overwrite("profiles", daily_profile(tables.read("log"), "timestamp", **args), partition_by=["day"])
    tables.snapshot("log", "log_before")
    tables.merge_update("log", late_labels(spark, sf_dir), on="id", set_=["label"])
    refresh(tables, "log_before", "log", "profiles", "id", "timestamp", **args)
    tables.snapshot("log", "log_before")
    again = inference(spark, sf_dir).filter("day >= '2024-01-29'").withColumn("id", F.col("id") + 1000000)
    tables.append("log", again)
    refresh(tables, "log_before", "log", "profiles", "id", "timestamp", **args)
    return shown(tables.read("profiles"))


@query(
    "drift_alerts",
    f"""WITH d AS ({_DRIFT_CAT_SQL}) SELECT day, 'psi' AS alert FROM d WHERE psi > 5 UNION ALL
        SELECT day, 'unseen' FROM d WHERE unseen_share > 0.4""",
)
def drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    now, base = _sides(spark, sf_dir)
    drift = drift_categorical(now, base, ["event_type"], by=["day"])
    drift = rounded(drift, psi=6, unseen_share=6)
    return alerts(drift, {"psi": "psi > 5", "unseen": "unseen_share > 0.4"}).select("day", "alert")
