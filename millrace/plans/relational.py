"""Queries over projections, joins, aggregates, top-k, splits and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import cast, drop, fill_template, project, rename, select_by_type
from millrace.functions.hashing import sql_bucket
from millrace.operators.aggregates import concat_text, group_stats, row_count, text_length, to_messages
from millrace.operators.features import apply_minmax, bin_right_closed, fit_minmax, one_hot, tokenize
from millrace.operators.index import with_dense_index
from millrace.operators.joins import Lookup, attach_groups, join_truth, lookup
from millrace.operators.metrics import classification_metrics, corr_matrix, regression_metrics, to_class
from millrace.operators.splits import route, split, split_audit, with_split
from millrace.plans.registry import query, table

# -- projections -----------------------------------------------------------------------------------


@query(
    "project_rename_cast",
    """SELECT try_cast(json_extract_string(props,'$.k') AS int) AS k, try_cast(event_type AS int) AS kind,
       event_id::double AS event, value::bigint AS whole FROM events""",
)
def project_rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    # Spark truncates on a cast to integer where other engines round
    df = df.withColumn("value", F.rint("value"))
    df = rename(df, {"event_id": "event", "event_type": "kind", "value": "whole"})
    df = cast(df, {"k": "int", "kind": "int", "event": "double", "whole": "bigint"})
    return project(df, "k", "kind", "event", "whole")


@query("drop_columns", "SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop(table(spark, sf_dir, "customer"), "c_name", "c_acctbal")


@query("select_by_type", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem")
def by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_by_type(
        table(spark, sf_dir, "lineitem"), [T.DoubleType], keep=["l_orderkey", "l_linenumber"], exclude=["l_extendedprice"]
    )


@query(
    "dense_index",
    """SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS index FROM customer""",
)
def dense_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return with_dense_index(df, "index", ["c_acctbal", "c_custkey"])


# -- joins -----------------------------------------------------------------------------------------

# A fixed linear expression that stands in for a fitted model on line items.
LINE_PREDICTION = "1500.0 * l_quantity + 1000.0 * l_tax"
SCORED_SQL = f"SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice AS y, {LINE_PREDICTION} AS p FROM lineitem"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_extendedprice").alias("y"), F.expr(LINE_PREDICTION).alias("p")
    )


@query(
    "join_pred_truth",
    """SELECT o.o_orderkey, round(p.prediction, 4) AS prediction, o.o_totalprice AS price FROM orders o
       JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS prediction FROM lineitem GROUP BY 1) p
       ON o.o_orderkey = p.l_orderkey""",
)
def join_pred_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("prediction"))
    )
    truth = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    return join_truth(pred, truth, "o_orderkey")


@query(
    "left_join_group",
    """SELECT l_orderkey, l_linenumber, l_suppkey, n_used, round(mean_q, 6) AS mean_q FROM lineitem
       JOIN (SELECT l_suppkey AS s, count(*) AS n_used, avg(l_quantity) AS mean_q FROM lineitem GROUP BY 1) ON l_suppkey = s""",
)
def left_join_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    groups = group_stats(lines, "l_suppkey", ["l_quantity"]).select(
        "l_suppkey", "n_used", F.round("mean_l_quantity", 6).alias("mean_q")
    )
    return attach_groups(lines, groups, "l_suppkey").drop("l_quantity")


@query(
    "feature_lookup",
    """SELECT l_extendedprice, p_size, p_brand, s_acctbal FROM lineitem
       LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def feature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and keys of the lines, features of part and supplier; the keys are left out of the set."""
    lines = rename(table(spark, sf_dir, "lineitem"), {"l_partkey": "p_partkey", "l_suppkey": "s_suppkey"})
    lookups = [
        Lookup(table(spark, sf_dir, "part"), "p_partkey", ("p_size", "p_brand")),
        Lookup(table(spark, sf_dir, "supplier"), "s_suppkey", ("s_acctbal",)),
    ]
    return lookup(lines, lookups, label="l_extendedprice", exclude=["p_partkey", "s_suppkey"])


# -- aggregates ------------------------------------------------------------------------------------


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


@query(
    "group_stats",
    """SELECT l_suppkey, count(*) AS n_used, round(avg(l_quantity), 6) AS mean_l_quantity,
       min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity FROM lineitem GROUP BY 1""",
)
def stats_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = group_stats(table(spark, sf_dir, "lineitem"), "l_suppkey", ["l_quantity"])
    return df.withColumn("mean_l_quantity", F.round("mean_l_quantity", 6))


REGRESSION_SQL = """count(*) AS n, round(avg((y - p) * (y - p)), 2) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
       round(avg(abs(y - p)), 4) AS mae, round(1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0), 6) AS r2"""


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("regression_metrics", f"SELECT l_returnflag, {REGRESSION_SQL} FROM ({SCORED_SQL}) GROUP BY 1")
def regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = regression_metrics(scored(spark, sf_dir), "y", "p", by=["l_returnflag"])
    return rounded(df, mse=2, rmse=4, mae=4, r2=6)


DEFAULT_SQL = """SELECT c_custkey, c_mktsegment, (c_acctbal < 2000)::int AS y,
       round_even(least(greatest(0.9 - c_nationkey / 25.0::double, 0), 1), 0)::int AS p FROM customer"""


@query(
    "classification_metrics",
    f"""SELECT c_mktsegment, n, round(acc / n, 6) AS accuracy, round(CASE WHEN pp > 0 THEN tp / pp ELSE 0 END, 6) AS precision,
        round(CASE WHEN ap > 0 THEN tp / ap ELSE 0 END, 6) AS recall,
        round(CASE WHEN pp + ap > 0 THEN 2 * tp / (pp + ap) ELSE 0 END, 6) AS f1 FROM (
        SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE y = p)::double AS acc,
          count(*) FILTER (WHERE y = 1 AND p = 1)::double AS tp, count(*) FILTER (WHERE p = 1)::double AS pp,
          count(*) FILTER (WHERE y = 1)::double AS ap FROM ({DEFAULT_SQL}) GROUP BY 1)""",
)
def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    prob = F.least(F.greatest(F.lit(0.9) - F.col("c_nationkey") / 25.0, F.lit(0.0)), F.lit(1.0))
    df = table(spark, sf_dir, "customer").select(
        "c_mktsegment", (F.col("c_acctbal") < 2000).cast("int").alias("y"), to_class(prob).alias("p")
    )
    df = classification_metrics(df, "y", "p", by=["c_mktsegment"])
    return rounded(df, accuracy=6, precision=6, recall=6, f1=6)


CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for a in CORR_COLUMNS
        for b in CORR_COLUMNS
    ),
)
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(corr_matrix(table(spark, sf_dir, "lineitem"), CORR_COLUMNS), corr=6)


@query(
    "concat_text",
    """SELECT conv_id, ((turn - 1) // 4)::bigint AS part_no, string_agg(text, '' ORDER BY turn) AS text,
       length(string_agg(text, '' ORDER BY turn)) AS n_chars FROM conversations WHERE turn >= 1 GROUP BY 1, 2""",
)
def concat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat_text(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", start=1, per_part=4)


@query("text_length", "SELECT conv_id, sum(length(text))::bigint AS n_chars FROM conversations WHERE turn >= 1 GROUP BY 1")
def length_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_length(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", start=1)


@query(
    "messages",
    """SELECT conv_id, (turn // 64)::bigint AS segment, count(*)::int AS turns,
       string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS chat FROM conversations GROUP BY 1, 2""",
)
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = to_messages(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", per_segment=64)
    line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return chats.select("conv_id", "segment", F.size("messages").alias("turns"), F.array_join(line, "\n").alias("chat"))


# -- splits ----------------------------------------------------------------------------------------

SPLIT_SQL = f"{sql_bucket('p_partkey', 42, 10000)}"
SPLIT_CASE = f"CASE WHEN {SPLIT_SQL} < 6000 THEN 'train' WHEN {SPLIT_SQL} < 8000 THEN 'test' ELSE 'inference' END"


@query("split_three", f"SELECT p_partkey, {SPLIT_CASE} AS split FROM part")
def split_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").select("p_partkey")
    return with_split(df, "p_partkey", {"train": 0.6, "test": 0.2, "inference": 0.2})


@query(
    "split_audit",
    "SELECT count(*) AS source_rows, count(*) AS part_rows, 0 AS missing, 0 AS extra, 0 AS overlapping FROM orders",
)
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select("o_orderkey")
    return split_audit(df, split(df, "o_orderkey", [0.5, 0.5]), "o_orderkey")


ROUTE_SQL = f"CASE WHEN {sql_bucket('o_orderkey', 'route', 10000)} < 9000 THEN 'baseline' ELSE 'candidate' END"


@query("ab_route", f"SELECT o_orderkey, {ROUTE_SQL} AS variant FROM orders")
def ab_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", {"baseline": 90, "candidate": 10})


@query(
    "ab_metrics",
    f"""SELECT {ROUTE_SQL} AS variant, {REGRESSION_SQL} FROM (SELECT o_orderkey, o_totalprice AS y,
        250000.0 + 100.0 * (o_custkey % 7) AS p FROM orders) GROUP BY 1""",
)
def ab_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Served predictions routed 90/10 and measured per variant."""
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("y"), (250000.0 + 100.0 * (F.col("o_custkey") % 7)).alias("p")
    )
    df = route(df, "o_orderkey", {"baseline": 90, "candidate": 10})
    return rounded(regression_metrics(df, "y", "p", by=["variant"]), mse=2, rmse=4, mae=4, r2=6)


# -- features --------------------------------------------------------------------------------------

# Categories of the driver's part table, in sorted order.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "one_hot",
    "SELECT p_partkey, p_size, "
    + ", ".join(f"CASE WHEN p_type = '{t}' THEN 1.0 ELSE 0.0 END::double AS p_type_{t}" for t in PART_TYPES)
    + " FROM part",
)
def one_hot_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_hot(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type"), ["p_type"])


@query(
    "bin_right_closed",
    """SELECT p_partkey, p_size, CASE WHEN p_size > 0 AND p_size <= 10 THEN 1 WHEN p_size > 10 AND p_size <= 20 THEN 2
       WHEN p_size > 20 AND p_size <= 30 THEN 3 WHEN p_size > 30 AND p_size <= 45 THEN 4 END AS bin FROM part""",
)
def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return df.withColumn("bin", bin_right_closed("p_size", [0, 10, 20, 30, 45], [1, 2, 3, 4]))


@query(
    "minmax_scale",
    f"""WITH t AS (SELECT min(p_size) AS lo, max(p_size) AS hi, min(p_retailprice) AS plo, max(p_retailprice) AS phi
          FROM part WHERE {SPLIT_CASE} = 'train')
        SELECT p_partkey, round((p_size - lo) / (hi - lo)::double, 9) AS p_size,
          round((p_retailprice - plo) / (phi - plo), 9) AS p_retailprice FROM part, t WHERE {SPLIT_CASE} <> 'train'""",
)
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range fitted on the training split, applied to the others."""
    cols = ["p_size", "p_retailprice"]
    df = table(spark, sf_dir, "part").select("p_partkey", *cols)
    train, test, inference = split(df, "p_partkey", [0.6, 0.2, 0.2])
    scaled = apply_minmax(test.unionByName(inference), fit_minmax(train, cols))
    return rounded(scaled, p_size=9, p_retailprice=9)


@query(
    "tokenize_truncate",
    r"""SELECT doc_id, len(t)::int AS n_tokens, array_to_string(t[1:64], ' ') AS head FROM (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t FROM documents)""",
)
def tokenize_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tokenize(table(spark, sf_dir, "documents"), "text")
    df = tokenize(df, "text", "head", max_len=64)
    return df.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("head", " ").alias("head"))


PROMPT = "Use only the text below.\n\n{context}\n\nQuestion: {question}\n\nResponse:\n"


@query(
    "fill_template",
    "SELECT p_partkey, 'Part ' || p_name || ' of ' || p_brand || ' costs ' || p_size || ' {p_name}.' AS line FROM part",
)
def template(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part")
    slots = {"name": "p_name", "brand": "p_brand", "size": "p_size"}
    return fill_template(df, "Part {name} of {brand} costs {size} {p_name}.", slots, "line").select("p_partkey", "line")
