"""Queries over small preparation steps: keys, names, types, vectors, saved models, table comments."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import cast_all, categorical_columns, sanitize_names, with_unique_id
from millrace.functions.hashing import sql_bucket
from millrace.operators.features import apply_one_hot, assemble, fit_categories, one_hot_vector
from millrace.operators.gates import ModelRejected, Threshold, gate_or_fail
from millrace.operators.metrics import regression_metrics
from millrace.operators.models import LinearModel, load_model, save_model
from millrace.operators.splits import split
from millrace.operators.topk import head
from millrace.plans.registry import query, table
from millrace.plans.relational import rounded
from millrace.plans.table_jobs import fresh_tables
from millrace.session import shared_dir
from millrace.sources.readers import from_pandas

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("pandas_rows", "SELECT r_regionkey::bigint AS r_regionkey, r_name, n_nationkey FROM region JOIN nation ON r_regionkey = n_regionkey")
def pandas_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pandas frame of a few rows, joined to a table."""
    import pandas as pd

    rows = table(spark, sf_dir, "region").select("r_regionkey", "r_name").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("region has more than 1000 rows")
    frame = pd.DataFrame([r.asDict() for r in rows], columns=["r_regionkey", "r_name"])
    regions = from_pandas(spark, frame, "r_regionkey bigint, r_name string")
    return regions.join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey")).select("r_regionkey", "r_name", "n_nationkey")


@query("table_comment", "SELECT 'Parts and their prices' AS comment, count(*) AS n FROM part")
def table_comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fresh_tables(spark, "commented")
    tables.overwrite("parts", table(spark, sf_dir, "part"), comment="Parts and their prices")
    return tables.read("parts").agg(F.count(F.lit(1)).alias("n")).withColumn("comment", F.lit(tables.comment("parts")))


@query(
    "cast_all_columns",
    """SELECT p_partkey::varchar AS p_partkey, p_name, p_brand, p_type, p_size::varchar AS p_size FROM part""",
)
def cast_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_all(table(spark, sf_dir, "part").drop("p_retailprice"), "string")


@query(
    "categoricals_by_type",
    "SELECT c_custkey, c_nationkey, c_acctbal, "
    + ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END::double AS c_mktsegment_{s}" for s in SEGMENTS)
    + " FROM customer",
)
def categoricals_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every non-numeric column found by its type and encoded."""
    df = table(spark, sf_dir, "customer").drop("c_name")
    made = apply_one_hot(df, fit_categories(df, categorical_columns(df)))
    missing = [f"c_mktsegment_{s}" for s in SEGMENTS if f"c_mktsegment_{s}" not in made.columns]
    return made.withColumns({c: F.lit(0.0) for c in missing})  # small tables may lack a segment


@query("sanitize_names", "SELECT s_suppkey AS supplier_key, s_name AS full_name, s_acctbal AS account_balance_now FROM supplier")
def names_without_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitize_names(table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier key"), F.col("s_name").alias("full name"), F.col("s_acctbal").alias("account balance now")
    ))


@query("unique_ids", "SELECT count(*) AS n, count(*) AS n_unique, 0::bigint AS lowest FROM orders")
def unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = with_unique_id(table(spark, sf_dir, "orders").select("o_orderkey"), "id")
    ids = made.groupBy("id").agg(F.count(F.lit(1)).alias("c"))  # one row per id: nothing is collected
    return ids.agg(F.sum("c").alias("n"), F.count_if(F.col("c") == 1).alias("n_unique"), F.min("id").alias("lowest"))


@query("first_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return head(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 25)


_KNOWN = "ECONOMY LARGE MEDIUM PROMO SMALL".split()


@query(
    "one_hot_unseen",
    "SELECT p_partkey, p_type, array_to_string(["
    + ", ".join(f"CASE WHEN p_type = '{t}' THEN '1' ELSE '0' END" for t in _KNOWN)
    + "], ' ') AS code FROM part",
)
def one_hot_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoder fitted without one part type: rows of that type get the zero vector."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    fitted = one_hot_vector(["p_type"], ["v"]).fit(parts.filter("p_type <> 'STANDARD'"))
    code = F.array_join(F.transform(vector_to_array("v"), lambda x: x.cast("int").cast("string")), " ")
    return fitted.transform(parts).select("p_partkey", "p_type", code.alias("code"))


@query("assemble_vector", "SELECT l_orderkey, l_linenumber, round(l_quantity + l_discount + l_tax, 6) AS total FROM lineitem")
def assemble_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = assemble(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return made.select("l_orderkey", "l_linenumber", F.round(total, 6).alias("total"))


_PART_BUCKET = sql_bucket("p_partkey", 42, 10000)


@query("fitted_pipeline_reload", f"SELECT p_partkey, p_type, CASE WHEN p_type = 'PROMO' THEN 1.0 ELSE 0.0 END::double AS promo FROM part WHERE {_PART_BUCKET} >= 8000")
def fitted_pipeline_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted pipeline, saved and loaded again, applied to rows it was not fitted on."""
    train, test = split(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_partkey", [0.8, 0.2])
    path = shared_dir(spark, "fitted-pipeline")
    save_model(one_hot_vector(["p_type"], ["v"]).fit(train), path)
    loaded = load_model(path)
    names = loaded.stages[0].labelsArray[0]
    code = vector_to_array("v")
    promo = code[names.index("PROMO")] if "PROMO" in names else F.lit(0.0)
    return loaded.transform(test).select("p_partkey", "p_type", promo.alias("promo"))


@query(
    "gate_or_fail",
    """SELECT 'accepted' AS outcome, 'mse' AS metric, round(avg(pow(p_retailprice - (0.1 * p_partkey + 900), 2)), 2) AS candidate FROM part
       UNION ALL SELECT 'rejected', 'mse', NULL::double""",
)
def gate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A better model passes the gate, the same model against itself is rejected by an exception."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    good = LinearModel(("p_partkey",), (0.1,), 900.0)
    measured = lambda m: regression_metrics(m.transform(parts), "p_retailprice", "prediction")
    better, poor = measured(good), measured(LinearModel(("p_partkey",), (0.0,), -1e6))
    rules = {"mse": Threshold(min_rel=0.05, greater_is_better=False)}
    passed = gate_or_fail(better, poor, rules).select(F.lit("accepted").alias("outcome"), "metric", "candidate")
    try:
        gate_or_fail(better, better, rules)
        raise RuntimeError("a model without gain passed")
    except ModelRejected as e:
        rejected = spark.createDataFrame([("rejected", m, None) for m in e.failed], "outcome string, metric string, candidate double")
    return rounded(passed.unionByName(rejected), candidate=2)
