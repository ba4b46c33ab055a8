"""Queries over scoring, gates, run log, model names, per-group models and model search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import map_get, where_like
from millrace.functions.hashing import sql_bucket
from millrace.functions.udfs import model_udf, register_model
from millrace.operators.gates import Threshold, champion, gate
from millrace.operators.forests import fit_group_forests, predict_group_forests
from millrace.operators.groups import fit_groups, fit_groups_ols, group_run_rows, predict_groups
from millrace.operators.joins import Lookup, score_lookup
from millrace.operators.metrics import evaluate, regression_metrics
from millrace.operators.models import LinearModel, auto_fit, fit_forest, fit_linear, fit_mean, least_correlated, vote
from millrace.operators.runlog import Models, RunLog, dataset_digest, dataset_tags
from millrace.operators.splits import split
from millrace.plans.registry import query, table
from millrace.plans.relational import LINE_PREDICTION, REGRESSION_SQL, SCORED_SQL, rounded, scored
from millrace.plans.table_jobs import fresh_tables
from millrace.session import shared_dir

LINE_MODEL = LinearModel(("l_quantity", "l_tax"), (1500.0, 1000.0), 0.0)


# -- scoring ---------------------------------------------------------------------------------------


@query("score_columns", f"SELECT l_orderkey, l_linenumber, round({LINE_PREDICTION}, 4) AS prediction FROM lineitem")
def score_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model as a vectorized column function over positional columns."""
    predict = model_udf(LINE_MODEL, LINE_MODEL.features)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(predict("l_quantity", "l_tax"), 4).alias("prediction")
    )


@query("score_sql", "SELECT p_partkey, round(p_size * 2.5 + p_retailprice * 0.5 + 7, 6) AS prediction FROM part")
def score_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model registered as a SQL function over the whole row."""
    register_model(spark, "part_model", LinearModel(("p_size", "p_retailprice"), (2.5, 0.5), 7.0), ["p_size", "p_retailprice"])
    table(spark, sf_dir, "part").createOrReplaceTempView("parts_to_score")
    return spark.sql("SELECT p_partkey, round(part_model(struct(*)), 6) AS prediction FROM parts_to_score")


@query(
    "score_batch",
    """SELECT l_partkey AS p_partkey, count(*) AS n, round(sum(p_size * 2.5 + p_retailprice * 0.5 + 7), 4) AS prediction
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in; features looked up; the coefficients of the aliased model version applied."""
    tables = fresh_tables(spark, "score-batch")
    models = Models(tables)
    coefs = spark.createDataFrame(
        [("price", 1, [0.0, 0.0], 1.0), ("price", 2, [2.5, 0.5], 7.0)],
        "name string, version int, coefficients array<double>, intercept double",
    )
    models.register(coefs)
    models.set_alias("price", "baseline", 1)
    models.set_alias("price", "baseline", 2)
    row = models.resolve("price", "baseline")
    model = LinearModel(("p_size", "p_retailprice"), tuple(row["coefficients"]), row["intercept"])
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    parts = Lookup(table(spark, sf_dir, "part"), "p_partkey", ("p_size", "p_retailprice"))
    made = score_lookup(keys, [parts], model.transform)
    return made.groupBy("p_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("prediction"), 4).alias("prediction")
    )


# -- baseline, gates, champions --------------------------------------------------------------------


@query(
    "dummy_regressor",
    f"""SELECT {REGRESSION_SQL} FROM (SELECT l_extendedprice AS y, (SELECT avg(l_extendedprice) FROM lineitem) AS p
        FROM lineitem)""",
)
def dummy_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("y"))
    df = evaluate(fit_mean(df, "y").transform(df, "p"), "y", "p", "regressor")
    return rounded(df, mse=2, rmse=4, mae=4, r2=6)


@query(
    "linear_regressor",
    """WITH s AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
         FROM lineitem)
       SELECT l_orderkey, l_linenumber, round(a * l_quantity + b, 3) AS prediction FROM lineitem, s""",
)
def linear_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    model = fit_linear(lines, ["l_quantity"], "l_extendedprice")
    return rounded(model.transform(lines).select("l_orderkey", "l_linenumber", "prediction"), prediction=3)


GATES = {
    "rmse": Threshold(value=30000.0, min_abs=50.0, min_rel=0.05, higher_is_better=False),
    "mse": Threshold(value=9.0e8, min_abs=1000.0, min_rel=0.5, greater_is_better=False),
    "r2": Threshold(value=0.4, min_abs=0.05, min_rel=None, higher_is_better=True),
}
_GATE_SQL = f"""
  WITH m AS (SELECT avg((y - p) * (y - p)) AS mse, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2,
      avg((y - b) * (y - b)) AS bmse, 1 - sum((y - b) * (y - b)) / (var_pop(y) * count(*)) AS br2
      FROM (SELECT *, (SELECT avg(y) FROM ({SCORED_SQL})) AS b FROM ({SCORED_SQL}))),
  g AS (SELECT 'rmse' AS metric, sqrt(mse) AS c, sqrt(bmse) AS b, sqrt(mse) <= 30000 AS t,
      sqrt(bmse) - sqrt(mse) >= 50 AS a, (sqrt(bmse) - sqrt(mse)) / sqrt(bmse) >= 0.05 AS r FROM m
    UNION ALL SELECT 'mse', mse, bmse, mse <= 9e8, bmse - mse >= 1000, (bmse - mse) / bmse >= 0.5 FROM m
    UNION ALL SELECT 'r2', r2, br2, r2 >= 0.4, r2 - br2 >= 0.05, true FROM m)
"""


@query(
    "validation_gate",
    _GATE_SQL + """SELECT metric, round(c, 3) AS candidate, round(b, 3) + 0.0 AS baseline, t AS meets_threshold,
    a AS meets_absolute, r AS meets_relative, t AND a AND r AS accepted FROM g""",
)
def validation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A candidate measured against the mean baseline under three kinds of limits."""
    df = scored(spark, sf_dir)
    base = fit_mean(df, "y").transform(df, "b")
    rows = gate(regression_metrics(df, "y", "p"), regression_metrics(base, "y", "b"), GATES)
    return rows.withColumns(
        {"candidate": F.round("candidate", 3), "baseline": F.round("baseline", 3) + F.lit(0.0)}
    )


@query(
    "champion_rmse",
    """WITH m AS (SELECT sqrt(avg(pow(y - a, 2))) AS a, sqrt(avg(pow(y - b, 2))) AS b, sqrt(avg(pow(y - c, 2))) AS c FROM
         (SELECT p_retailprice AS y, 950.0 AS a, 900.0 + p_size AS b, 948.0 + p_size / 10.0 AS c FROM part))
       SELECT 'baseline' AS model, round(a, 6) AS score, a <= b AND a <= c AS champion FROM m
       UNION ALL SELECT 'candidate', round(b, 6), b < a AND b <= c FROM m
       UNION ALL SELECT 'challenger', round(c, 6), c < a AND c < b FROM m""",
)
def champion_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").select(
        F.col("p_retailprice").alias("y"),
        F.lit(950.0).alias("a"),
        (900.0 + F.col("p_size")).alias("b"),
        (948.0 + F.col("p_size") / 10.0).alias("c"),
    )
    return rounded(champion(df, "y", {"baseline": "a", "candidate": "b", "challenger": "c"}, "rmse"), score=6)


@query(
    "champion_accuracy",
    """WITH m AS (SELECT count(*) FILTER (WHERE y = a)::double / count(*) AS a, count(*) FILTER (WHERE y = b)::double / count(*) AS b
         FROM (SELECT (c_acctbal < 2000)::int AS y, (c_nationkey < 5)::int AS a, (c_nationkey % 25 < 5)::int AS b FROM customer))
       SELECT 'baseline' AS model, round(a, 6) AS score, a >= b AS champion FROM m
       UNION ALL SELECT 'candidate', round(b, 6), b > a FROM m""",
)
def champion_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal accuracy: the baseline keeps its place."""
    df = table(spark, sf_dir, "customer").select(
        (F.col("c_acctbal") < 2000).cast("int").alias("y"),
        (F.col("c_nationkey") < 5).cast("int").alias("a"),
        (F.col("c_nationkey") % 25 < 5).cast("int").alias("b"),
    )
    return rounded(champion(df, "y", {"baseline": "a", "candidate": "b"}, "accuracy"), score=6)


# -- ensembles -------------------------------------------------------------------------------------

MEMBERS = {
    "sgd": "1400.0 * l_quantity",
    "xgb": "1500.0 * l_quantity + 9000.0 * l_discount",
    "lgbm": "20000.0 + 800.0 * l_quantity + 20000.0 * l_tax",
    "rf": "38000.0 + 60000.0 * l_discount",
}
_MEMBER_SQL = "SELECT l_extendedprice AS y, " + ", ".join(f"{e} AS {n}" for n, e in MEMBERS.items()) + " FROM lineitem"


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("y"), *[F.expr(e).alias(n) for n, e in MEMBERS.items()]
    )


@query(
    "voting_ensemble",
    f"SELECT {REGRESSION_SQL} FROM (SELECT y, (sgd + xgb + lgbm + rf) / 4 AS p FROM ({_MEMBER_SQL}))",
)
def voting_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = members(spark, sf_dir).withColumn("p", vote(list(MEMBERS)))
    return rounded(regression_metrics(df, "y", "p"), mse=2, rmse=4, mae=4, r2=6)


@query(
    "corr_pick",
    "SELECT model, round(abs_corr, 6) AS abs_corr FROM ("
    + " UNION ALL ".join(f"SELECT '{m}' AS model, abs(corr(xgb, {m})) AS abs_corr FROM ({_MEMBER_SQL})" for m in ("sgd", "lgbm", "rf"))
    + ") ORDER BY abs_corr, model LIMIT 2",
)
def corr_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(least_correlated(members(spark, sf_dir), list(MEMBERS), "xgb", 2), abs_corr=6)


# -- run log and model names -----------------------------------------------------------------------

FAMILIES = ["SGDRegressor", "XGBRegressor", "LGBMRegressor", "RandomForestRegressor"]
_FAMILY_SQL = "(['" + "','".join(FAMILIES) + "'])[(l_suppkey % 4) + 1]"
RUNS_SQL = f"""
  SELECT 'run-' || l_suppkey AS run_id, {_FAMILY_SQL} AS regressor, sqrt(avg(pow(l_extendedprice - ({LINE_PREDICTION}), 2))) AS val_rmse,
         (l_suppkey % 10)::varchar AS group_tag, max(l_shipdate) AS end_time FROM lineitem GROUP BY l_suppkey
"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run rows: the fixed line model evaluated for each supplier, tagged by family and group."""
    family = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), (F.col("l_suppkey") % 4 + 1).cast("int"))
    per = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.sqrt(F.avg(F.pow(F.col("l_extendedprice") - F.expr(LINE_PREDICTION), 2))).alias("rmse"),
            F.max("l_shipdate").cast("timestamp").alias("end_time"),
        )
    )
    return per.select(
        F.concat(F.lit("run-"), F.col("l_suppkey").cast("string")).alias("run_id"),
        F.lit("sweep").alias("parent_run_id"),
        F.lit("suppliers").alias("experiment"),
        F.create_map(F.lit("regressor"), family).alias("params"),
        F.create_map(F.lit("val_rmse"), F.col("rmse")).alias("metrics"),
        F.create_map(F.lit("group"), (F.col("l_suppkey") % 10).cast("string")).alias("tags"),
        "end_time",
    )


def run_log(spark: SparkSession, sf_dir: str) -> RunLog:
    log = RunLog(fresh_tables(spark, "runs"))
    log.append(runs(spark, sf_dir))
    return log


@query(
    "runlog_append",
    f"""SELECT run_id, 'sweep' AS parent_run_id, regressor, round(val_rmse, 4) AS val_rmse, group_tag FROM ({RUNS_SQL})
        UNION ALL SELECT 'sweep', NULL, NULL, round(sqrt(avg(pow(l_extendedprice - ({LINE_PREDICTION}), 2))), 4), NULL FROM lineitem""",
)
def runlog_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested runs appended first, their parent (without params or tags) in a second batch."""
    log = run_log(spark, sf_dir)
    whole = regression_metrics(scored(spark, sf_dir), "y", "p")
    log.append(
        whole.select(
            F.lit("sweep").alias("run_id"),
            F.lit("suppliers").alias("experiment"),
            F.create_map(F.lit("val_rmse"), F.col("rmse")).alias("metrics"),
        )
    )
    return log.read().select(
        "run_id",
        "parent_run_id",
        map_get("params", "regressor").alias("regressor"),
        F.round(map_get("metrics", "val_rmse"), 4).alias("val_rmse"),
        map_get("tags", "group").alias("group_tag"),
    )


@query(
    "runlog_latest",
    f"""SELECT run_id, group_tag, strftime(end_time, '%Y-%m-%d') AS day FROM ({RUNS_SQL}) WHERE group_tag IS NOT NULL
        ORDER BY end_time DESC, run_id LIMIT 10""",
)
def runlog_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = run_log(spark, sf_dir)
    found = log.search(map_get("tags", "group").isNotNull(), [F.col("end_time").desc()], 10)
    return found.select("run_id", map_get("tags", "group").alias("group_tag"), F.date_format("end_time", "yyyy-MM-dd").alias("day"))


@query(
    "runlog_best",
    f"""SELECT regressor AS family, run_id, round(val_rmse, 4) AS score FROM ({RUNS_SQL}) WHERE regressor LIKE '%GB%' OR regressor LIKE 'SGD%'
        QUALIFY row_number() OVER (PARTITION BY regressor ORDER BY val_rmse, run_id) = 1""",
)
def runlog_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best run of every family whose name matches a pattern."""
    best = run_log(spark, sf_dir).best_per_family("val_rmse")
    wanted = where_like(best, map_get("params", "regressor"), "%GB%").unionByName(
        where_like(best, map_get("params", "regressor"), "SGD%")
    )
    return wanted.select("family", "run_id", F.round("score", 4).alias("score"))


@query(
    "latest_version",
    """SELECT s_nationkey::varchar AS name, max(s_suppkey)::int AS version, arg_max(s_name, s_suppkey) AS uri FROM supplier GROUP BY 1""",
)
def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = Models(fresh_tables(spark, "models"))
    models.register(
        table(spark, sf_dir, "supplier").select(
            F.col("s_nationkey").cast("string").alias("name"), F.col("s_suppkey").cast("int").alias("version"), F.col("s_name").alias("uri")
        )
    )
    return models.latest()


@query("model_alias", "SELECT max(s_suppkey)::int AS version, 'champion' AS alias, arg_max(s_name, s_suppkey) AS uri FROM supplier")
def model_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias set, moved to a newer version, another one set and deleted again, then resolved."""
    models = Models(fresh_tables(spark, "aliases"))
    rows = table(spark, sf_dir, "supplier").select(
        F.lit("price").alias("name"), F.col("s_suppkey").cast("int").alias("version"), F.col("s_name").alias("uri")
    )
    models.register(rows)
    newest = models.latest().first()["version"]
    models.set_alias("price", "champion", 1)
    models.set_alias("price", "champion", newest)
    models.set_alias("price", "old", 1)
    models.delete_alias("price", "old")
    return models.resolved().select("version", "alias", "uri")


_ORDER_TEXT = "concat_ws('|', o_orderkey::varchar, o_custkey::varchar, o_orderstatus, o_orderpriority)"


@query(
    "dataset_digest",
    f"""SELECT 'fit-1' AS run_id, 'orders' AS dataset, count(*) AS n_rows,
          sum(('0x' || substr(md5({_ORDER_TEXT} || ':row'), 1, 8))::bigint)::varchar AS digest FROM orders""",
)
def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that names the dataset it was fitted on, read back from the run log."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    log = RunLog(fresh_tables(spark, "digest"))
    log.append(
        dataset_digest(orders, "orders").select(
            F.lit("fit-1").alias("run_id"), F.lit(None).cast("string").alias("parent_run_id"), F.lit("orders").alias("experiment"),
            F.create_map().cast("map<string,string>").alias("params"), F.create_map(F.lit("n_rows"), F.col("n_rows").cast("double")).alias("metrics"),
            dataset_tags().alias("tags"), F.current_timestamp().alias("end_time"),
        )
    )
    found = log.search(map_get("tags", "dataset") == "orders")
    return found.select("run_id", map_get("tags", "dataset").alias("dataset"), F.col("metrics")["n_rows"].cast("long").alias("n_rows"), map_get("tags", "digest").alias("digest"))


# -- models per group ------------------------------------------------------------------------------

GROUP_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def grouped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_suppkey") % 10).cast("int").alias("group_id"), *GROUP_FEATURES,
        F.col("l_extendedprice").alias("label"),
    )


@query(
    "group_models",
    """SELECT (l_suppkey % 10)::int AS group_id, count(*) AS n_used, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY 1""",
)
def group_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = fit_groups_ols(grouped_lines(spark, sf_dir), "group_id", "l_quantity", "label")
    return rounded(fitted.drop("mse"), slope=6, intercept=4)


# With one feature the elastic net has a closed form per ratio; the check computes all eleven.
_ENET_BEST_SQL = """
  WITH m AS (SELECT (l_suppkey % 10)::int AS group_id, count(*) AS n_used, var_pop(l_quantity) AS q,
      covar_pop(l_extendedprice, l_quantity) AS c, var_pop(l_extendedprice) AS v, avg(l_quantity) AS mx, avg(l_extendedprice) AS my
      FROM lineitem GROUP BY 1),
  t AS (SELECT *, sign(c) * greatest(abs(c) - l1, 0) / (q + 1 - l1) AS w FROM m, (SELECT i / 10.0::double AS l1 FROM range(11) r(i))),
  e AS (SELECT *, v - 2 * w * c + w * w * q AS mse FROM t)
  SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY mse, l1) = 1
"""
_ENET_SQL = f"""
  SELECT group_id, n_used, l1 AS l1_ratio, round(w, 6) AS coefficient, round(my - w * mx, 4) AS intercept, round(mse, 2) AS mse
  FROM ({_ENET_BEST_SQL})
"""


@query("group_elastic_net", _ENET_SQL)
def group_elastic_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elastic net per group with a search over eleven ratios."""
    fitted = fit_groups(grouped_lines(spark, sf_dir), "group_id", ["l_quantity"], "label")
    return rounded(
        fitted.select("group_id", "n_used", "l1_ratio", F.col("coefficients")[0].alias("coefficient"), "intercept", "mse"),
        coefficient=6, intercept=4, mse=2,
    )


@query(
    "group_predict",
    """WITH m AS (SELECT l_suppkey % 10 AS g, regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
         FROM lineitem WHERE l_suppkey % 10 <> 7 GROUP BY 1)
       SELECT l_orderkey, l_linenumber, round(a * l_quantity + b, 3) AS prediction FROM lineitem LEFT JOIN m ON l_suppkey % 10 = g""",
)
def group_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of group 7, which has no model, get no prediction."""
    lines = grouped_lines(spark, sf_dir)
    fitted = fit_groups_ols(lines.filter("group_id <> 7"), "group_id", "l_quantity", "label")
    models = fitted.select("group_id", F.array("slope").alias("coefficients"), "intercept")
    made = predict_groups(lines, models, "group_id", ["l_quantity"])
    return rounded(made.select("l_orderkey", "l_linenumber", "prediction"), prediction=3)


# Labels with a rule of their own in every group.
GROUP_LABEL = "l_quantity * (1000 + 100 * (l_suppkey % 10)) * (1 - l_discount)"


@query(
    "group_forests",
    f"""WITH g AS (SELECT (l_suppkey % 10)::int AS group_id, {GROUP_LABEL} AS y FROM lineitem)
        SELECT group_id, count(*) AS n_used, count(*) AS n_scored, round(stddev_pop(y), 2) AS spread, true AS good FROM g GROUP BY 1""",
)
def group_forests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forest per group, grown together over all features, stored; every row scored by its group's forest in one scan."""
    lines = grouped_lines(spark, sf_dir).withColumn("label", F.expr(GROUP_LABEL.replace("(l_suppkey % 10)", "group_id")))
    made = fit_group_forests(lines, "group_id", GROUP_FEATURES, "label", shared_dir(spark, "group-forests"), num_trees=100, feature_fraction=1.0)
    scored = predict_group_forests(lines, made, "group_id")
    error = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)))
    found = scored.groupBy("group_id").agg(
        F.count("prediction").alias("n_scored"), F.stddev_pop("label").alias("spread"), (error <= 0.3 * F.stddev_pop("label")).alias("good")
    )
    return rounded(found.join(made.select("group_id", "n_used"), "group_id"), spread=2)


@query(
    "group_workflow",
    f"SELECT group_id, 'enet-' || group_id AS run_id, n_used AS n, round(sqrt(mse), 4) AS rmse FROM ({_ENET_BEST_SQL})",
)
def group_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit per group, publish models and runs, read the latest runs back, predict every row, measure."""
    lines = grouped_lines(spark, sf_dir)
    tables = fresh_tables(spark, "groups")
    tables.overwrite("group_models", fit_groups(lines, "group_id", ["l_quantity"], "label"))
    models = tables.read("group_models")
    log = RunLog(tables)
    log.append(group_run_rows(models, "group_id", "enet", "session"))
    latest = log.search(map_get("tags", "group").isNotNull() & (F.col("parent_run_id") == "session"))
    wanted = latest.select(map_get("tags", "group").cast("int").alias("group_id"), "run_id")
    made = predict_groups(lines, models.join(wanted, "group_id"), "group_id", ["l_quantity"])
    quality = regression_metrics(made, "label", "prediction", by=["group_id"])
    return quality.join(wanted, "group_id").select("group_id", "run_id", "n", F.round("rmse", 4).alias("rmse"))


# -- fitted and searched models --------------------------------------------------------------------


# A label that depends on its features: quantity at a fixed unit price, less discount, plus tax.
LINE_PRICE = "l_quantity * 1000 * (1 - l_discount) * (1 + l_tax)"
LINE_ID = "(l_orderkey * 100 + l_linenumber)"
LINES_TEST_SQL = f"(SELECT {LINE_ID} AS id, {LINE_PRICE} AS price FROM lineitem WHERE {sql_bucket(LINE_ID, 42, 10000)} >= 8000)"
DEAR = 25_000


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a unique key for splitting."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr(LINE_ID).alias("id"), *GROUP_FEATURES, F.expr(LINE_PRICE).alias("price")
    )


def better_than_mean(scored: DataFrame, y: str, prediction: str, share: float) -> DataFrame:
    """``(n, spread, good)``: rows, error of their mean as prediction, and whether the model's error is at most
    ``share`` of it."""
    error = F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(y), 2)))
    spread_ = F.stddev_pop(F.col(y).cast("double"))
    made = scored.agg(F.count(F.lit(1)).alias("n"), spread_.alias("spread"), (error <= share * spread_).alias("good"))
    return rounded(made, spread=2)


def better_than_base(scored: DataFrame, y: str, prediction: str, margin: float) -> DataFrame:
    """``(n, base, good)``: rows, share of the larger class, and whether accuracy is at least ``margin`` above it."""
    one = F.avg(F.col(y).cast("double"))
    base, right = F.greatest(one, 1 - one), F.avg((F.col(y) == F.col(prediction)).cast("double"))
    return rounded(scored.agg(F.count(F.lit(1)).alias("n"), base.alias("base"), (right >= base + margin).alias("good")), base=6)


MEAN_SQL = f"SELECT count(*) AS n, round(stddev_pop(price), 2) AS spread, true AS good FROM {LINES_TEST_SQL}"
BASE_SQL = f"""SELECT count(*) AS n, round(greatest(avg((price > {DEAR})::int), 1 - avg((price > {DEAR})::int)), 6) AS base, true AS good
  FROM {LINES_TEST_SQL}"""


@query("forest_regression", MEAN_SQL)
def forest_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small forest's error on held-out lines is at most half that of the mean."""
    train, test = split(line_features(spark, sf_dir), "id", [0.8, 0.2])
    model = fit_forest(train, GROUP_FEATURES, "price", max_depth=3, num_trees=20, min_leaf_fraction=0.1, feature_fraction=0.67)
    return better_than_mean(model.transform(test), "price", "prediction", 0.5)


# Families in the order they are tried.
REGRESSORS = ["LinearRegression", "RandomForestRegressor", "GBTRegressor"] * 2
CLASSIFIERS = ["LogisticRegression", "RandomForestClassifier", "GBTClassifier", "MultilayerPerceptronClassifier", "LogisticRegression", "RandomForestClassifier"]


def _trials_sql(families: list[str]) -> str:
    rows = ", ".join(f"('trial-{i:03d}', '{family}', true)" for i, family in enumerate(families))
    return f"SELECT * FROM (VALUES {rows}) v(run_id, family, good)"


@query("auto_regress", _trials_sql(REGRESSORS))
def auto_regress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trial's validation error is at most half the spread of the label."""
    df = line_features(spark, sf_dir)
    board = auto_fit(df, "id", GROUP_FEATURES, "price", "regressor", "rmse").leaderboard(spark)
    spread_ = df.agg(F.stddev_pop("price")).first()[0]
    return board.select("run_id", "family", (F.col("score") <= 0.5 * spread_).alias("good"))


@query("auto_classify", _trials_sql(CLASSIFIERS))
def auto_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = line_features(spark, sf_dir).withColumn("dear", (F.col("price") > DEAR).cast("int")).drop("price")
    board = auto_fit(df, "id", GROUP_FEATURES, "dear", "classifier", "f1").leaderboard(spark)
    return board.select("run_id", "family", (F.col("score") >= 0.8).alias("good"))
