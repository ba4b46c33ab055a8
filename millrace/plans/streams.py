"""Queries over file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.clickstream import CLICKS_SQL, EXPECTS, EXPECTS_OR_FAIL, RAW_SCHEMA, TARGET, clicks, prepare, top_referrers_of
from millrace.plans.registry import query, table
from millrace.plans.relational import rounded
from millrace.plans.table_jobs import EVENT_JSON
from millrace.session import shared_dir
from millrace.streaming.files import (
    read_stream_sink,
    stream_expect,
    stream_expect_or_fail,
    stream_files,
    stream_profile,
    stream_table,
    violations_table,
)


@query("stream_ingest", "SELECT event_id, user_id, event_type, value, props FROM events")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds over a folder that grows in between; every row arrives once."""
    source, sink, state = (shared_dir(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    events = table(spark, sf_dir, "events")
    for condition in ("event_type <> 'click'", "event_type = 'click'"):
        events.filter(condition).repartition(4, "event_id").write.mode("append").json(source)
        stream_table(stream_files(spark, source, "json", EVENT_JSON, max_files=3), sink, state)
    return read_stream_sink(spark, sink).select("event_id", "user_id", "event_type", "value", "props")


def _clean_stream(spark: SparkSession, sf_dir: str) -> str:
    """Raw click stream table -> cleaned stream table; returns the folder of the latter."""
    source, raw, clean = (shared_dir(spark, n) for n in ("clicks-in", "clicks-raw", "clicks-clean"))
    clicks(spark, sf_dir).repartition(4, "curr_title", "prev_title").write.json(source)
    stream_table(stream_files(spark, source, "json", RAW_SCHEMA, max_files=2), raw, shared_dir(spark, "state-raw"))
    prepared = prepare(stream_files(spark, raw, "parquet", RAW_SCHEMA))
    prepared = stream_expect_or_fail(stream_expect(prepared, EXPECTS), EXPECTS_OR_FAIL)
    stream_table(prepared, clean, shared_dir(spark, "state-clean"))
    return clean


@query(
    "stream_clean",
    f"""SELECT curr_title AS current_page_title, n::int AS click_count, prev_title AS previous_page_title FROM ({CLICKS_SQL})""",
)
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_stream_sink(spark, _clean_stream(spark, sf_dir))


@query(
    "stream_top_referrers",
    f"""SELECT prev_title AS referrer, n::int AS click_count FROM ({CLICKS_SQL}) WHERE curr_title = '{TARGET}'
        ORDER BY click_count DESC, referrer LIMIT 10""",
)
def stream_top_referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_referrers_of(read_stream_sink(spark, _clean_stream(spark, sf_dir)), TARGET)


@query(
    "stream_daily_profile",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, count(*) - count(value) AS value_null,
         round(avg(value), 6) AS value_mean, min(value) AS value_min, max(value) AS value_max FROM events
       WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2""",
)
def stream_daily_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows the watermark has closed."""
    source, sink = shared_dir(spark, "log-in"), shared_dir(spark, "log-profile")
    log = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    log.repartitionByRange(4, "ts").write.parquet(source)
    stream = stream_files(spark, source, "parquet", log.schema)
    made = stream_profile(stream, "ts", "1 day", "1 day", ["value"], by=["event_type"])
    stream_table(made, sink, shared_dir(spark, "state-profile"))
    out = read_stream_sink(spark, sink).withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    return rounded(out.drop("window_start", "window_end"), value_mean=6)


STREAM_RULES = {"dear": "value > 20", "known user": "user_id IS NOT NULL", "no error": "event_type <> 'error'"}


@query(
    "stream_expectations",
    " UNION ALL ".join(
        f"SELECT '{n}' AS expectation, count(*) AS n_rows, count(*) FILTER (NOT coalesce({c}, false)) AS n_failed FROM events" for n, c in STREAM_RULES.items()
    ),
)
def stream_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of a stream's expectations as a table, over all its micro-batches."""
    source, sink = shared_dir(spark, "expect-in"), shared_dir(spark, "expect-out")
    log = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    log.repartition(6, "event_id").write.parquet(source)
    stream = stream_expect(stream_files(spark, source, "parquet", log.schema, max_files=1), STREAM_RULES)
    done = stream_table(stream, sink, shared_dir(spark, "expect-state"))
    return violations_table(spark, done, STREAM_RULES)
