import datetime as dt

import pytest

from millrace.streaming.files import (
    dropped_rows, read_stream_sink, stream_expect, stream_expect_or_fail, stream_files, stream_profile, stream_table, stream_violations, violations_table,
)

SCHEMA = "k int, v double"


def put(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{folder}/in")


def test_each_row_once_over_runs(spark, folder):
    for rows in ([(1, 1.0), (2, 2.0)], [(3, 3.0)]):
        put(spark, folder, rows)
        stream_table(stream_files(spark, f"{folder}/in", "json", SCHEMA, 1), f"{folder}/out", f"{folder}/state")
    assert sorted(r["k"] for r in read_stream_sink(spark, f"{folder}/out").collect()) == [1, 2, 3]


def test_expectations_are_counted(spark, folder):
    put(spark, folder, [(1, 1.0), (None, 2.0)])
    put(spark, folder, [(None, -3.0)])
    rules = {"key": "k IS NOT NULL", "positive": "v > 0"}
    q = stream_table(stream_expect(stream_files(spark, f"{folder}/in", "json", SCHEMA, 1), rules), f"{folder}/out", f"{folder}/state")
    assert stream_violations(q, rules) == {"key": 2, "positive": 1}
    assert read_stream_sink(spark, f"{folder}/out").count() == 3


def test_violations_of_more_batches_than_spark_keeps(spark, folder):
    spark.createDataFrame([(None, float(i)) for i in range(101)], SCHEMA).repartition(101).write.option("maxRecordsPerFile", 1).json(f"{folder}/in")
    rules = {"key": "k IS NOT NULL"}
    q = stream_table(stream_expect(stream_files(spark, f"{folder}/in", "json", SCHEMA, 1), rules), f"{folder}/out", f"{folder}/state")
    assert stream_violations(q, rules) == {"key": 101}
    assert [tuple(r) for r in violations_table(spark, q, rules).collect()] == [("key", 101, 101)]


def test_failing_expectation_keeps_earlier_batches(spark, folder):
    def run():
        s = stream_files(spark, f"{folder}/in", "json", SCHEMA, 1)
        return stream_table(stream_expect_or_fail(s, {"positive": "v > 0"}), f"{folder}/out", f"{folder}/state")

    put(spark, folder, [(1, 1.0)])
    run()
    put(spark, folder, [(2, 2.0), (3, None)])
    with pytest.raises(Exception, match="positive"):
        run()
    assert [r["k"] for r in read_stream_sink(spark, f"{folder}/out").collect()] == [1]


def test_profile_drops_and_counts_late_rows(spark, folder):
    schema = "ts timestamp, v double"
    day = dt.datetime(2024, 1, 1)

    def run(rows):
        spark.createDataFrame([(day + dt.timedelta(days=d), v) for d, v in rows], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        s = stream_files(spark, f"{folder}/in", "parquet", schema)
        return stream_table(stream_profile(s, "ts", "1 day", "1 day", ["v"]), f"{folder}/out", f"{folder}/state")

    run([(0, 1.0), (0, None), (1, 5.0), (4, 7.0)])
    q = run([(0, 100.0), (4, 9.0), (9, 1.0)])  # the first day is closed by now
    assert dropped_rows(q) == 1
    got = {r["window_start"].day: (r["n"], r["v_null"], r["v_mean"]) for r in read_stream_sink(spark, f"{folder}/out").collect()}
    assert got == {1: (2, 1, 1.0), 2: (1, 0, 5.0), 5: (2, 0, 8.0)}
