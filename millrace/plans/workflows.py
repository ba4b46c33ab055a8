"""End-to-end jobs composed of the operators; tables are the only hand-over between their steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import recode, sanitize_names, with_constant, with_event_time, with_key
from millrace.functions.hashing import hash32, sql_bucket
from millrace.functions.udfs import register_model
from millrace.operators.explain import explain, summary
from millrace.operators.features import (
    apply_minmax,
    apply_one_hot,
    bin_right_closed,
    fit_categories,
    fit_minmax,
    numeric_features,
    one_hot_vector,
)
from millrace.operators.gates import Threshold, champion, gate
from millrace.operators.index import with_dense_index
from millrace.operators.joins import Lookup, lookup
from millrace.operators.metrics import custom_drift, custom_metrics, regression_metrics, to_class
from millrace.operators.models import auto_fit, fit_forest, fit_linear, fit_mean, in_pandas, least_correlated, load_model, save_model, vote
from millrace.operators.monitor import daily_profile, drift_categorical, drift_numeric, quality, refresh
from millrace.operators.network import fit_network
from millrace.operators.quality import expect_counts
from millrace.operators.runlog import Models
from millrace.operators.splits import split, with_split
from millrace.plans.modeling import GROUP_FEATURES, LINE_PRICE, LINES_TEST_SQL, better_than_mean, line_features
from millrace.plans.monitoring import CUSTOM
from millrace.plans.registry import query, table
from millrace.plans.relational import rounded
from millrace.plans.table_jobs import BUCKETS, NULL_LABEL_SQL, fresh_tables, null_label
from millrace.session import cut_lineage, shared_dir
from millrace.sources.readers import read_external

SPLIT = [0.6, 0.2, 0.2]
EXPLAINED_ROWS = 100  # rows of the test side an explanation summary is taken over


def _publish_splits(tables, df: DataFrame, key: str) -> None:
    for name, part in zip(("training", "test", "inference"), split(df, key, SPLIT)):
        tables.overwrite(name, part)


# Fixed labels that depend on the features of their table.
PART_PRICE = "p_size * 10.0 + ascii(p_type)"
PART_KEY = "md5(p_partkey || '|' || p_name || '|' || p_brand)"


@query(
    "price_workflow",
    f"""SELECT {PART_KEY} AS "ID", {PART_PRICE.replace('10.0', '10.0::double')} AS price, true AS scored, true AS good FROM part
        WHERE {sql_bucket(PART_KEY, 42, 10000)} >= 8000""",
)
def price_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with a key -> one-hot -> three split tables -> network and searched model -> champion on the
    test table -> inference table scored by the champion."""
    tables = fresh_tables(spark, "price")
    raw = with_key(table(spark, sf_dir, "part"), "ID", ["p_partkey", "p_name", "p_brand"])
    tables.overwrite("raw", raw.select("ID", "p_brand", "p_type", "p_size", F.expr(PART_PRICE).cast("double").alias("price")))
    raw = tables.read("raw")
    encoded = sanitize_names(apply_one_hot(raw, fit_categories(raw, ["p_brand", "p_type"])))
    _publish_splits(tables, encoded, "ID")
    train, test, inference = (tables.read(n) for n in ("training", "test", "inference"))
    features = [c for c in train.columns if c not in ("ID", "price")]

    stats = fit_minmax(train, features)
    network = fit_network(apply_minmax(train, stats), "ID", features, "price", epochs=50, batch=16)
    searched = auto_fit(train, "ID", features, "price", "regressor", "rmse")

    def score(df: DataFrame) -> DataFrame:
        base = network.transform(apply_minmax(df, stats), "baseline").select("ID", "baseline")
        made = searched.best.transform(df).withColumnRenamed("prediction", "candidate")
        return made.select("ID", "price", "candidate").join(base, "ID")

    verdict = champion(score(test), "price", {"baseline": "baseline", "candidate": "candidate"}, "rmse")
    winner = verdict.filter("champion").first()
    models = Models(tables)
    models.register(verdict.select(F.lit("price").alias("name"), F.when(F.col("model") == "baseline", 1).otherwise(2).alias("version"), F.col("model").alias("uri")))
    models.set_alias("price", "champion", 1 if winner["model"] == "baseline" else 2)
    chosen = models.resolve("price", "champion")["uri"]
    spread_ = test.agg(F.stddev_pop("price")).first()[0]
    good = F.lit(winner["score"] <= 0.3 * spread_)  # the champion is far better than the mean
    return score(inference).select("ID", "price", F.col(chosen).isNotNull().alias("scored"), good.alias("good"))


@query("default_workflow", "SELECT * FROM (VALUES ('baseline', true, 1), ('candidate', true, 1)) v(model, good, champions)")
def default_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External table -> casts, bins, one-hot -> splits -> classifier network and searched classifier ->
    champion by accuracy; both are right for nine of ten customers, and one of them is the champion."""
    tables = fresh_tables(spark, "default")
    raw = read_external(spark, "parquet", path=f"{sf_dir}/customer.parquet").drop("c_name")
    raw = raw.select(
        "c_custkey",
        bin_right_closed("c_nationkey", [-1, 4, 9, 14, 19, 24], [1, 2, 3, 4, 5]).cast("string").alias("zone"),
        "c_mktsegment",
        (F.length("c_mktsegment") + F.col("c_nationkey") > 20).cast("int").alias("default_next"),
        (F.length("c_mktsegment") + F.col("c_nationkey")).cast("double").alias("size"),
    )
    encoded = sanitize_names(apply_one_hot(raw, fit_categories(raw, ["zone", "c_mktsegment"])))
    _publish_splits(tables, encoded, "c_custkey")
    train, test = tables.read("training"), tables.read("test")
    features = [c for c in train.columns if c not in ("c_custkey", "default_next")]
    stats = fit_minmax(train, features)
    network = fit_network(
        apply_minmax(train, stats), "c_custkey", features, "default_next", "classifier",
        hidden=(64, 32, 16), epochs=100, batch=16, monitor="accuracy", patience=15, start_from_epoch=30,
    )
    searched = auto_fit(train, "c_custkey", features, "default_next", "classifier", "f1")
    base = network.transform(apply_minmax(test, stats), "p").select("c_custkey", to_class("p").alias("baseline"))
    made = searched.best.transform(test).select("c_custkey", "default_next", F.col("prediction").alias("candidate"))
    scored = made.join(base, "c_custkey")
    verdict = champion(scored, "default_next", {"baseline": "baseline", "candidate": "candidate"}, "accuracy")
    champions = verdict.filter("champion").count()  # of two rows
    return verdict.select("model", (F.col("score") >= 0.9).alias("good"), F.lit(champions).alias("champions"))


@query("feature_workflow", "SELECT * FROM (VALUES ('rmse', true), ('shap', true)) v(name, good)")
def feature_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clone -> dense index -> feature table -> lookup -> forest, saved and reloaded -> scores by key ->
    explanation summary of 100 rows; the forest halves the mean's error and quantity explains most."""
    tables = fresh_tables(spark, "feature-flow")
    tables.clone(f"{sf_dir}/lineitem.parquet", "listings")
    listings = tables.read("listings").withColumn("l_extendedprice", F.expr(LINE_PRICE)).drop("l_returnflag", "l_linestatus", "l_shipdate")
    tables.overwrite("indexed", with_dense_index(listings, "index", ["l_orderkey", "l_linenumber"]), keys=["index"])
    indexed = tables.read("indexed").withColumnRenamed("l_extendedprice", "price")
    tables.overwrite("features", numeric_features(indexed, "index", "price"), keys=["index"])
    features = tables.read("features")
    columns = [c for c in features.columns if c != "index"]
    # looked up and split once: training, scores and explanations read the stored rows
    looked_up = lookup(indexed.select("index", "price"), [Lookup(features, "index")], label="price")
    tables.overwrite("joined", with_split(looked_up, "index", {"train": 0.8, "test": 0.2}, out="side"), keys=["index"])
    joined = tables.read("joined")
    train, test = (joined.filter(F.col("side") == side).drop("side") for side in ("train", "test"))
    path = shared_dir(spark, "forest")
    save_model(fit_forest(train.drop("index"), columns, "price", max_depth=3, num_trees=20), path)
    model = load_model(path)
    scored = model.transform(test)
    quality_ = better_than_mean(scored, "price", "prediction", 0.5).select(F.lit("rmse").alias("name"), "good")
    # reference rows: the mean feature row of every order-line position
    background = tables.read("indexed").groupBy("l_linenumber").agg(*[F.avg(c).alias(c) for c in columns])
    sample = test.orderBy(hash32("index", "explain"), "index").limit(EXPLAINED_ROWS).select("index", *columns)
    values = explain(sample, "index", columns, model.transform, background)
    top = summary(values).agg(F.max_by("feature", "mean_abs_shap").alias("top"), F.count(F.lit(1)).alias("n")).select(
        F.lit("shap").alias("name"), ((F.col("top") == "l_quantity") & (F.col("n") == len(columns))).alias("good")
    )
    return quality_.unionByName(top)


@query("monitor_workflow")
def monitor_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split -> model -> baseline table -> scored batches, the second drifted -> profiles -> late labels ->
    refresh -> quality, drift and custom drift as one metric table."""
    tables = fresh_tables(spark, "monitor")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("ID"), "event_type", F.get_json_object("props", "$.k").cast("double").alias("k"), F.col("value").alias("price")
    )
    train, baseline_rows, inference_rows = split(events, "ID", SPLIT)
    encoder = one_hot_vector(["event_type"], ["kind"]).fit(train)
    encoded = encoder.transform(train)
    model = fit_forest(encoded, ["kind", "k"], "price", max_depth=5, num_trees=36, min_leaf_fraction=0.1, feature_fraction=0.5)

    def predict(df: DataFrame) -> DataFrame:
        made = model.transform(encoder.transform(df)).select(*df.columns, "prediction")
        return with_constant(made, "model_id", "1", "string")

    tables.overwrite("baseline", predict(baseline_rows))
    labels = inference_rows.select("ID", "price")
    first, second = split(inference_rows.drop("price"), "ID", [0.5, 0.5], seed=7)
    second = with_constant(recode(second, "event_type", ["error", "signup"], "click"), "k", 1, "double")
    for batch, epoch in ((first, 1706745600), (second, 1706832000)):
        scored = with_constant(predict(with_event_time(batch, "timestamp", epoch)), "price", None, "double")
        scored = scored.withColumn("day", F.date_format("timestamp", "yyyy-MM-dd"))
        if tables.exists("log"):
            tables.append("log", scored)
        else:
            tables.overwrite("log", scored, partition_by=["day"], bucket_by=(BUCKETS, "ID"))
    args = dict(numeric=["k", "prediction", "price"], categorical=["event_type"], slices=["event_type", "k > 2"])
    tables.overwrite("profiles", daily_profile(tables.read("log"), "timestamp", **args), partition_by=["day"])
    tables.snapshot("log", "log_before")
    tables.merge_update("log", labels, on="ID", set_=["price"])
    refresh(tables, "log_before", "log", "profiles", "ID", "timestamp", **args)

    log, base = tables.read("log"), tables.read("baseline")
    wanted = F.date_format("window_start", "yyyy-MM-dd").alias("day")
    q = quality(log, "timestamp", "1 day", "price", "prediction").select(wanted, F.lit("rmse").alias("name"), F.col("rmse").alias("value"))
    cat = drift_categorical(log, base, ["event_type"], by=["day"]).select("day", F.lit("total_variation").alias("name"), F.col("total_variation").alias("value"))
    num = drift_numeric(log, base, ["k"], by=["day"]).select("day", F.lit("ks_k").alias("name"), F.col("ks").alias("value"))
    custom = custom_drift(custom_metrics(log, CUSTOM, by=["day"]), custom_metrics(base, CUSTOM), CUSTOM, keep=["day"])
    custom = custom.select("day", F.lit("delta_exp").alias("name"), F.col("delta_exp").alias("value"))
    known = tables.read("profiles").filter("slice_key = 'all' AND `column` = 'price'").select(
        "day", F.lit("labels").alias("name"), F.col("n").cast("double").alias("value")
    )
    return rounded(q.unionByName(cat).unionByName(num).unionByName(custom).unionByName(known), value=4)


_GATE_SQL = f"SELECT * FROM ({NULL_LABEL_SQL}) WHERE quality IS NOT NULL"


@query(
    "gate_workflow",
    f"""WITH r AS ({_GATE_SQL}), m AS (SELECT regr_slope(quality, n_chars) AS a, regr_intercept(quality, n_chars) AS b FROM r
          WHERE {sql_bucket('doc_id', 42, 10000)} < 8000)
        SELECT doc_id, true AS gated, true AS scored, round(a * n_chars + b, 5) AS line FROM r, m""",
)
def gate_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL audit -> table without NULL labels -> keyed features -> lookup -> search -> mean baseline ->
    gate -> alias -> scores from SQL by the model behind the alias.

    ``scored``: SQL gave the row a score; ``gated``: the alias follows the verdict, and what SQL scores has the very error on
    the test side that the gate saw of this model.  ``line`` is the score of a straight line on the length, also from SQL."""
    tables = fresh_tables(spark, "gate")
    audit = expect_counts(null_label(spark, sf_dir), {"labelled": "quality IS NOT NULL"}).first()
    null_label(spark, sf_dir).createOrReplaceTempView("raw_labelled")
    tables.ctas("labelled", "SELECT * FROM raw_labelled WHERE quality IS NOT NULL")
    rows = tables.read("labelled")
    if audit["passed"] != rows.count():
        raise RuntimeError("rows lost between audit and table")
    categories = fit_categories(rows, ["lang"])
    tables.overwrite("features", apply_one_hot(rows.drop("quality"), categories), keys=["doc_id"])
    features = tables.read("features")
    columns = [c for c in features.columns if c != "doc_id"]
    training, test = split(lookup(rows.select("doc_id", "quality"), [Lookup(features, "doc_id")], label="quality"), "doc_id", [0.8, 0.2])
    searched = auto_fit(training, "doc_id", columns, "quality", "regressor", "rmse")
    mean = fit_mean(training, "quality")
    limits = {"mse": Threshold(value=0.5, min_abs=0.0, min_rel=0.0, greater_is_better=False)}
    verdict = gate(
        regression_metrics(searched.best.transform(test), "quality", "prediction"),
        regression_metrics(mean.transform(test), "quality", "prediction"),
        limits,
    ).first()
    models = Models(tables)
    rows_ = [("quality", 1, "mean"), ("quality", 2, searched.best_run)]
    models.register(spark.createDataFrame(rows_, "name string, version int, uri string"))
    models.set_alias("quality", "champion", 2 if verdict["accepted"] else 1)
    uri = models.resolve("quality", "champion")["uri"]
    register_model(spark, "quality_model", mean if uri == "mean" else in_pandas(searched.models[uri]), columns)
    register_model(spark, "quality_line", fit_linear(training, ["n_chars"], "quality"), ["n_chars"])
    features.createOrReplaceTempView("quality_features")
    test.createOrReplaceTempView("quality_test")
    tables.overwrite("scores", spark.sql("SELECT doc_id, quality_model(struct(*)) AS prediction, quality_line(struct(*)) AS line FROM quality_features"))
    # the alias follows the gate's verdict, and SQL scores with the model the alias names
    error = regression_metrics(spark.sql("SELECT quality, quality_model(struct(*)) AS prediction FROM quality_test"), "quality", "prediction").first()["mse"]
    seen = verdict["candidate"] if verdict["accepted"] else verdict["baseline"]
    same = error == seen if error is None or seen is None else abs(error - seen) <= 1e-9 * max(1.0, seen)
    gated = uri == (searched.best_run if verdict["accepted"] else "mean") and same
    return tables.read("scores").select(
        "doc_id", F.lit(gated).alias("gated"), F.col("prediction").isNotNull().alias("scored"), F.round("line", 5).alias("line")
    )


@query("ensemble_workflow", f"SELECT 'rmse' AS metric, count(*) AS n, true AS good, true AS decided FROM {LINES_TEST_SQL}")
def ensemble_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search -> correlation of the members' predictions -> vote of the best with the two least correlated
    -> gate against the best member.  Both are at most half as wrong as the mean, and the verdict follows
    from their errors."""
    train, test = split(line_features(spark, sf_dir), "id", [0.8, 0.2])
    searched = auto_fit(train, "id", GROUP_FEATURES, "price", "regressor", "rmse")
    made = test.select("id", "price", *GROUP_FEATURES)
    for run, model in searched.models.items():
        made = model.transform(made).withColumnRenamed("prediction", run.replace("-", "_")).drop("features")
    names = [r.replace("-", "_") for r in searched.models]
    best = searched.best_run.replace("-", "_")
    made = cut_lineage(made.select("id", "price", *names))  # every row is scored once
    partners = [r["model"] for r in least_correlated(made, names, best, 2).collect()]
    voted = made.withColumn("ensemble", vote([best, *partners]))
    limit = Threshold(value=60000.0, min_abs=0.05, min_rel=0.05, higher_is_better=False)
    verdict = gate(regression_metrics(voted, "price", "ensemble"), regression_metrics(voted, "price", best), {"rmse": limit})
    row = voted.agg(F.stddev_pop("price").alias("s"), F.count(F.lit(1)).alias("n")).first()
    c, b = F.col("candidate"), F.col("baseline")
    follows = F.col("accepted") == ((c <= 60000.0) & (b - c >= 0.05) & ((b - c) / b >= 0.05))
    return verdict.select("metric", F.lit(row["n"]).alias("n"), (F.greatest(c, b) <= 0.5 * row["s"]).alias("good"), follows.alias("decided"))
