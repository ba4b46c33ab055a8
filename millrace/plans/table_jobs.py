"""Queries over sources, sinks, table maintenance and expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import not_null, null_rows, recode, with_key
from millrace.functions.hashing import bucket, hash32, sql_bucket, sql_hash32, sql_uniform
from millrace.operators.quality import expect_counts, failing_rows
from millrace.plans.clickstream import CLICKS_SQL, EXPECTS, EXPECTS_OR_FAIL, clicks, prepare
from millrace.plans.registry import query, table
from millrace.session import shared_dir
from millrace.sources.readers import (
    HTML_RULES,
    from_rows,
    load_documents,
    query_path,
    read_csv,
    read_external,
    read_json,
    read_parquet,
)
from millrace.sources.synthetic import synth_groups
from millrace.sources.tables import Features, Tables, append_frames, write_parquet

EVENT_JSON = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"


def fresh_tables(spark: SparkSession, label: str) -> Tables:
    return Tables(spark, shared_dir(spark, label))


@query("scan_json", "SELECT event_id, user_id, event_type, value, props FROM events")
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "events-json")
    table(spark, sf_dir, "events").write.json(path)
    return read_json(spark, path).select("event_id", "user_id", "event_type", "value", "props")


@query("scan_sql_path", "SELECT * FROM part")
def scan_sql_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_path(spark, "parquet", f"{sf_dir}/part.parquet")


@query("scan_external", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def scan_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_external(spark, "parquet", path=f"{sf_dir}/customer.parquet")
    return df.drop("c_name", "c_acctbal")


@query("scan_csv", "SELECT p_partkey::bigint AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "part-csv")
    table(spark, sf_dir, "part").write.option("header", True).csv(path)
    return read_csv(spark, path).withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query(
    "literal_rows",
    """SELECT v.seg_id, v.seg_name, v.contact, count(c_custkey) AS customers
       FROM (VALUES (1,'BUILDING','Ada'),(2,'MACHINERY','Ben'),(3,'HOUSEHOLD','Cleo'),(4,'NOWHERE','Dov'))
            v(seg_id, seg_name, contact) LEFT JOIN customer ON c_mktsegment = v.seg_name GROUP BY ALL""",
)
def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal table with a declared non-null schema, counted against the customers."""
    rows = [(1, "BUILDING", "Ada"), (2, "MACHINERY", "Ben"), (3, "HOUSEHOLD", "Cleo"), (4, "NOWHERE", "Dov")]
    named = from_rows(spark, rows, "seg_id int not null, seg_name string not null, contact string not null")
    counts = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("c_custkey").alias("customers"))
    return named.join(counts, F.col("seg_name") == F.col("c_mktsegment"), "left").select(
        "seg_id", "seg_name", "contact", F.coalesce("customers", F.lit(0)).alias("customers")
    )


@query(
    "synth_groups",
    f"""SELECT group_id, count(*) AS n, round(avg(f1), 6) AS mean_1, round(avg(f2), 6) AS mean_2,
          round(avg(f3), 6) AS mean_3, round(avg(f1 + f2 + f3 + noise), 6) AS mean_label
        FROM (SELECT o_orderkey % 10 AS group_id, {sql_uniform('o_orderkey', '42-f1')} AS f1,
          {sql_uniform('o_orderkey', '42-f2')} * 2 AS f2, {sql_uniform('o_orderkey', '42-f3')} * 3 AS f3,
          {sql_uniform('o_orderkey', '42-noise')} AS noise FROM orders) GROUP BY 1""",
)
def synth(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = synth_groups(table(spark, sf_dir, "orders"), "o_orderkey")
    means = {f"feature_{i}": f"mean_{i}" for i in (1, 2, 3)} | {"label": "mean_label"}
    return df.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(c), 6).alias(a) for c, a in means.items()]
    )


def _html_sql(col: str) -> str:
    for pattern, to in HTML_RULES:
        col = f"regexp_replace({col}, '{pattern}', '{to}', 'g')"
    return f"trim({col})"


@query("page_text", f"SELECT * FROM (SELECT page_id AS doc_id, {_html_sql('html')} AS text FROM pages) WHERE text <> ''")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_documents(table(spark, sf_dir, "pages"), "page_id", "html")


@query("table_roundtrip", "SELECT * FROM nation UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet directory -> named table -> append -> read back by name."""
    path = shared_dir(spark, "nation")
    write_parquet(table(spark, sf_dir, "nation"), path)
    write_parquet(read_parquet(spark, f"{sf_dir}/nation.parquet"), path)
    tables = fresh_tables(spark, "roundtrip")
    tables.overwrite("places", read_parquet(spark, path).withColumn("n_nationkey", F.col("n_nationkey").cast("bigint")))
    tables.append(
        "places",
        table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("n_nationkey"), F.col("s_name").alias("n_name"), F.col("s_nationkey").alias("n_regionkey")
        ),
        merge_schema=False,
    )
    return tables.read("places")


@query(
    "table_overwrite_schema",
    "SELECT p_partkey, p_size::double AS size, upper(p_brand) AS brand, p_retailprice * 2 AS twice FROM part",
)
def table_overwrite_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is computed from the one it replaces and has another schema."""
    tables = fresh_tables(spark, "overwrite")
    tables.overwrite("parts", table(spark, sf_dir, "part"))
    old = tables.read("parts")
    tables.overwrite(
        "parts",
        old.select(
            "p_partkey",
            F.col("p_size").cast("double").alias("size"),
            F.upper("p_brand").alias("brand"),
            (F.col("p_retailprice") * 2).alias("twice"),
        ),
    )
    return tables.read("parts")


@query(
    "append_merge_schema",
    """SELECT event_id, value, event_type, NULL::double AS label FROM events WHERE event_type <> 'error'
       UNION ALL SELECT event_id, value, NULL, value * 2 FROM events WHERE event_type = 'error'""",
)
def append_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    tables = fresh_tables(spark, "append")
    tables.overwrite("log", events.filter("event_type <> 'error'").select("event_id", "value", "event_type"))
    errors = events.filter("event_type = 'error'").select("event_id", "value", (F.col("value") * 2).alias("label"))
    tables.append("log", errors)
    return tables.read("log")


@query(
    "append_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::varchar AS kind FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier""",
)
def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    s = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return append_frames(c, s)


NULL_LABEL_SQL = "SELECT d.doc_id, d.lang, d.n_chars, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def null_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label that is missing for most of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("null_audit", f"SELECT doc_id, lang, n_chars FROM ({NULL_LABEL_SQL}) WHERE quality IS NULL")
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_rows(null_label(spark, sf_dir), "quality").drop("quality")


@query("ctas_not_null", f"SELECT * FROM ({NULL_LABEL_SQL}) WHERE quality IS NOT NULL")
def ctas_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fresh_tables(spark, "ctas")
    not_null(null_label(spark, sf_dir), "quality").createOrReplaceTempView("labelled_documents")
    tables.ctas("labelled", "SELECT * FROM labelled_documents WHERE quality IS NOT NULL")
    return tables.read("labelled")


@query("deep_clone", "SELECT * FROM supplier")
def deep_clone(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fresh_tables(spark, "clone")
    tables.clone(f"{sf_dir}/supplier.parquet", "supplier")
    return tables.read("supplier")


def inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inference log over ``events``: prediction, and a true value known for the half of the ids whose
    digest falls below 50."""
    known = bucket("event_id", "label") < 50
    noise = hash32("event_id", "noise") % 1000 / 100.0
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("timestamp"),
        F.lit("v1").alias("model_id"),
        "event_type",
        "value",
        F.col("value").alias("prediction"),
        F.when(known, F.col("value") + noise).alias("label"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


INFERENCE_SQL = f"""
  SELECT event_id AS id, ts AS timestamp, 'v1' AS model_id, event_type, value, value AS prediction,
         CASE WHEN {sql_bucket('event_id', 'label')} < 50
              THEN value + ({sql_hash32('event_id', 'noise')} % 1000) / 100.0::double END AS label,
         strftime(ts, '%Y-%m-%d') AS day
  FROM events
"""


BUCKETS = 8  # of the log, by its key


def publish_log(spark: SparkSession, sf_dir: str, tables: Tables) -> None:
    """The log as scored: partitioned by day, bucketed by key, no label known yet."""
    df = inference(spark, sf_dir).withColumn("label", F.lit(None).cast("double"))
    tables.overwrite("log", df, keys=["id"], partition_by=["day"], bucket_by=(BUCKETS, "id"))


def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference(spark, sf_dir).filter("label IS NOT NULL").select("id", "label")


@query(
    "merge_late_labels",
    f"SELECT id, event_type, prediction, label, day FROM ({INFERENCE_SQL})",
)
def merge_late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fresh_tables(spark, "merge")
    publish_log(spark, sf_dir, tables)
    tables.merge_update("log", late_labels(spark, sf_dir), on="id", set_=["label"])
    return tables.read("log").select("id", "event_type", "prediction", "label", "day")


@query(
    "change_feed",
    f"""SELECT _change, count(*) AS n, sum(id)::bigint AS ids, round(sum(coalesce(label, 0)), 4) AS labels FROM (
        SELECT id, NULL AS label, 'update_preimage' AS _change FROM ({INFERENCE_SQL}) WHERE label IS NOT NULL
        UNION ALL SELECT id, label, 'update_postimage' FROM ({INFERENCE_SQL}) WHERE label IS NOT NULL
        UNION ALL SELECT id + 1000000, label, 'insert' FROM ({INFERENCE_SQL}) WHERE event_type = 'error')
        GROUP BY 1""",
)
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels merged into a log, then a batch appended: what changed from a snapshot taken before.

    The ids of the batch may be those of rows in the log, so each of the two writes is compared with the snapshot before it."""
    tables = fresh_tables(spark, "changes")
    publish_log(spark, sf_dir, tables)
    tables.snapshot("log", "log_before")
    tables.merge_update("log", late_labels(spark, sf_dir), on="id", set_=["label"])
    tables.snapshot("log", "log_merged")
    more = inference(spark, sf_dir).filter("event_type = 'error'").withColumn("id", F.col("id") + 1000000)
    tables.append("log", more)
    feed = tables.changes("log_before", "log_merged", ["id"]).unionByName(tables.changes("log_merged", "log", ["id"]))
    return feed.groupBy("_change").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("id").alias("ids"),
        F.round(F.sum(F.coalesce("label", F.lit(0.0))), 4).alias("labels"),
    )


@query("feature_table", "SELECT p_partkey, p_retailprice, p_size::double AS size FROM part")
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = Features(fresh_tables(spark, "features"))
    features.write(
        "parts",
        table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("size")),
        keys=["p_partkey"],
    )
    return features.read("parts")


ALL_EXPECTS = {**EXPECTS, **EXPECTS_OR_FAIL, "many_clicks": "click_count > 20", "no_campaign_7": "previous_page_title <> 'campaign_7'"}


@query(
    "expect_counts",
    f"""WITH p AS (SELECT curr_title AS current_page_title, n::int AS click_count, prev_title AS previous_page_title
                  FROM ({CLICKS_SQL}))
    """
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS name, count(*) FILTER (WHERE coalesce({c}, false)) AS passed,
            count(*) FILTER (WHERE NOT coalesce({c}, false)) AS failed FROM p"""
        for n, c in ALL_EXPECTS.items()
    ),
)
def expectation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect_counts(prepare(clicks(spark, sf_dir)), ALL_EXPECTS)


@query(
    "expect_fail_rows",
    f"""SELECT * FROM (SELECT curr_title AS current_page_title, n::int AS click_count,
          prev_title AS previous_page_title,
          concat_ws(',', CASE WHEN NOT coalesce(n::int > 20, false) THEN 'many_clicks' END,
                    CASE WHEN NOT coalesce(prev_title <> 'campaign_7', false) THEN 'no_campaign_7' END) AS broken
        FROM ({CLICKS_SQL})) WHERE broken <> ''""",
)
def expect_fail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failing_rows(prepare(clicks(spark, sf_dir)), ALL_EXPECTS)


@query("hash_key", "SELECT c_custkey, md5(c_custkey::varchar || '|' || c_name) AS id FROM customer")
def hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_key(table(spark, sf_dir, "customer"), "id", ["c_custkey", "c_name"]).select("c_custkey", "id")


@query(
    "recode_categories",
    """SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1','Brand#2','Brand#3') THEN 'Brand#9' ELSE p_brand END AS p_brand,
       CASE WHEN p_type = 'ECONOMY' THEN 'SUPER ECONOMY' ELSE p_type END AS p_type, 1.0::double AS p_size FROM part""",
)
def recode_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic drift: categories recoded, one feature held constant."""
    df = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    df = recode(df, "p_brand", ["Brand#1", "Brand#2", "Brand#3"], "Brand#9")
    df = recode(df, "p_type", ["ECONOMY"], "SUPER ECONOMY")
    return df.withColumn("p_size", F.lit(1).cast("double"))
