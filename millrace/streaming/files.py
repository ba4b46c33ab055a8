"""File streams: incremental ingest, stateless tables, expectations and windowed profiles.

Each stream runs until the files present at its start are processed (``availableNow``) and records its
progress in a checkpoint folder, so a later run takes up only what is new and every row is written once.
Checkpoint and sink folders must be shared storage on a cluster.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.quality import passed

_KEPT = "spark.sql.streaming.numRecentProgressUpdates"


def stream_files(spark: SparkSession, path: str, fmt: str, schema: StructType | str, max_files: int | None = None) -> DataFrame:
    """New files of a folder as a stream, at most ``max_files`` per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_table(df: DataFrame, path: str, checkpoint: str, partition_by: Iterable[str] = ()) -> StreamingQuery:
    """Append a stream to a parquet table and wait until the present input is written.

    The query keeps the progress of all its micro-batches (Spark drops all but 100 unless told), so
    counts taken from it afterwards are complete."""
    with _all_progress(df.sparkSession):
        query = (
            df.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .partitionBy(*partition_by)
            .trigger(availableNow=True)
            .start(path)
        )
        query.awaitTermination()
    return query


@contextmanager
def _all_progress(spark: SparkSession):
    """Streams that run inside keep every progress report."""
    before = spark.conf.get(_KEPT, None)
    spark.conf.set(_KEPT, 2**31 - 1)
    try:
        yield
    finally:
        spark.conf.unset(_KEPT) if before is None else spark.conf.set(_KEPT, before)


def read_stream_sink(spark: SparkSession, path: str) -> DataFrame:
    """Batch snapshot of a table a stream writes; files of unfinished batches are not part of it."""
    return spark.read.parquet(path)


def stream_expect(df: DataFrame, expectations: Mapping[str, str], name: str = "expectations") -> DataFrame:
    """Count violations of every micro-batch in its progress; rows are kept."""
    counters = [F.count_if(~passed(c)).alias(f"failed_{i}") for i, c in enumerate(expectations.values())]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *counters)


def stream_violations(query: StreamingQuery, expectations: Mapping[str, str], name: str = "expectations") -> dict[str, int]:
    """Violations over all micro-batches of a query that ``stream_table`` ran."""
    out = dict.fromkeys(expectations, 0)
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        if row is not None:
            for i, n in enumerate(expectations):
                out[n] += int(row[f"failed_{i}"] or 0)
    return out


def violations_table(spark: SparkSession, query: StreamingQuery, expectations: Mapping[str, str], name: str = "expectations") -> DataFrame:
    """``(expectation, n_rows, n_failed)`` of a finished stream, one row per expectation."""
    seen = sum(int(p.observedMetrics[name]["rows"] or 0) for p in query.recentProgress if p.observedMetrics.get(name) is not None)
    rows = [(n, seen, failed) for n, failed in stream_violations(query, expectations, name).items()]
    return spark.createDataFrame(rows, "expectation string, n_rows bigint, n_failed bigint")


def stream_expect_or_fail(df: DataFrame, expectations: Mapping[str, str]) -> DataFrame:
    """Stop the stream at the first violating row: the task raises, so the batch that holds it is not
    committed and earlier batches stay."""
    for name, cond in expectations.items():
        stop = F.raise_error(F.lit(f"expectation violated: {name}")).cast("boolean")
        df = df.filter(F.when(passed(cond), F.lit(True)).otherwise(stop))
    return df


def stream_profile(
    df: DataFrame, ts: str, granularity: str, watermark: str, numeric: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Windowed profile of a growing log: count, and per column nulls, mean, minimum and maximum.

    A window is emitted once, when the watermark passes its end; rows later than that are dropped and
    counted in the progress (``numRowsDroppedByWatermark``).  State is one row per open window and group.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in numeric:
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"{c}_null"),
            F.avg(c).alias(f"{c}_mean"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    return (
        df.withWatermark(ts, watermark)
        .groupBy(F.window(ts, granularity).alias("window"), *by)
        .agg(*aggs)
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, *[a for a in _names(numeric)])
    )


def _names(numeric: Sequence[str]) -> list[str]:
    out = ["n"]
    for c in numeric:
        out += [f"{c}_null", f"{c}_mean", f"{c}_min", f"{c}_max"]
    return out


def dropped_rows(query: StreamingQuery) -> int:
    """Late rows dropped by the watermark over all micro-batches of a query that ``stream_table`` ran."""
    return sum(int(op.numRowsDroppedByWatermark) for p in query.recentProgress for op in p.stateOperators)
