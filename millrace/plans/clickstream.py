"""Clickstream datasets: raw JSON -> prepared with expectations -> top referrers of one page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import cast, project, rename
from millrace.operators.topk import top_n
from millrace.plans.datasets import Datasets
from millrace.plans.registry import query, table
from millrace.session import shared_dir
from millrace.sources.readers import read_json
from millrace.sources.tables import Tables

RAW_SCHEMA = "curr_title string, prev_title string, n string"
EXPECTS = {"valid_current_page_title": "current_page_title IS NOT NULL"}
EXPECTS_OR_FAIL = {"valid_count": "click_count > 0"}
TARGET = "purchase_1"


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click pairs counted from ``events``: the page is event type and ``k mod 4``, the referrer the
    campaign ``k div 4``.  A plain partial aggregation; no ordering of a user's events is needed."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        table(spark, sf_dir, "events")
        .select(
            F.concat_ws("_", "event_type", (k % 4).cast("string")).alias("curr_title"),
            F.concat(F.lit("campaign_"), F.floor(k / 4).cast("string")).alias("prev_title"),
        )
        .groupBy("curr_title", "prev_title")
        .agg(F.count(F.lit(1)).cast("string").alias("n"))
    )


CLICKS_SQL = """
  SELECT concat_ws('_', event_type, (json_extract_string(props,'$.k')::int % 4)::varchar) AS curr_title,
         'campaign_' || (json_extract_string(props,'$.k')::int // 4)::varchar AS prev_title,
         count(*)::varchar AS n
  FROM events GROUP BY 1, 2
"""


def prepare(raw: DataFrame) -> DataFrame:
    df = cast(raw, {"n": "int"})
    df = rename(df, {"n": "click_count", "curr_title": "current_page_title", "prev_title": "previous_page_title"})
    return project(df, "current_page_title", "click_count", "previous_page_title")


def top_referrers_of(prepared: DataFrame, page: str, n: int = 10) -> DataFrame:
    hits = rename(prepared.filter(F.col("current_page_title") == page), {"previous_page_title": "referrer"})
    return top_n(hits.select("referrer", "click_count"), F.col("click_count").desc(), n, tie=["referrer"])


def clickstream_datasets(spark: SparkSession, json_dir: str, tables: Tables, page: str = TARGET) -> Datasets:
    ds = Datasets(tables)

    @ds.dataset("clickstream_raw", comment="Raw click pairs as ingested.")
    def raw():
        return read_json(spark, json_dir, RAW_SCHEMA)

    @ds.dataset(
        "clickstream_prepared",
        comment="Click pairs cleaned and prepared for analysis.",
        expects=EXPECTS,
        expects_or_fail=EXPECTS_OR_FAIL,
    )
    def prepared():
        return prepare(ds.read("clickstream_raw"))

    @ds.dataset("top_referrers", comment="Pages that lead to the target page most often.")
    def top():
        return top_referrers_of(ds.read("clickstream_prepared"), page)

    return ds


@query(
    "top_referrers",
    f"""WITH clicks AS ({CLICKS_SQL})
    SELECT prev_title AS referrer, n::int AS click_count FROM clicks
    WHERE curr_title = '{TARGET}' ORDER BY click_count DESC, referrer NULLS LAST LIMIT 10""",
)
def top_referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_dir = shared_dir(spark, "clickstream-json")
    clicks(spark, sf_dir).write.json(raw_dir)
    ds = clickstream_datasets(spark, raw_dir, Tables(spark, shared_dir(spark, "clickstream")))
    return ds.refresh("top_referrers")
