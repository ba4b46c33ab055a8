import pytest
from pyspark.sql import functions as F

from millrace.operators.quality import ExpectationError, expect, expect_counts, expect_or_fail, failing_rows, violations
from millrace.plans.clickstream import RAW_SCHEMA, clickstream_datasets
from millrace.sources.readers import from_pandas, from_rows, read_csv, read_external, read_json
from millrace.sources.tables import Features, Tables, append_frames, diff


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_overwrite_from_itself_and_comment(spark, folder):
    t = Tables(spark, folder)
    with pytest.raises(LookupError):
        t.read("x")
    t.overwrite("x", spark.createDataFrame([(1, "a")], "k int, v string"), comment="the 'first'", keys=["k"])
    assert t.comment("x") == "the 'first'" and t.keys("x") == ["k"] and t.violations("x") == {}
    old = t.read("x")
    t.overwrite("x", old.withColumn("w", F.lit(2.5)).drop("v"))
    assert rows(t.read("x"), "k", "w") == [(1, 2.5)] and t.comment("x") is None
    assert rows(old, "k", "v") == [(1, "a")]  # a reader of the replaced rows goes on
    assert spark.sql(f"SELECT w FROM {t.full('x')}").first()[0] == 2.5
    other = Tables(spark, folder + "-other")
    assert not other.exists("x")


def test_append_merges_schema_and_casts(spark, folder):
    t = Tables(spark, folder)
    t.append("x", spark.createDataFrame([(1, 1.0)], "k bigint, v double"))
    t.append("x", spark.createDataFrame([(2, "n")], "k int, w string"))
    assert [tuple(r) for r in t.read("x").orderBy("k").collect()] == [(1, 1.0, None), (2, None, "n")]
    with pytest.raises(ValueError):
        t.append("x", spark.createDataFrame([(3,)], "other int"), merge_schema=False)
    assert t.read("x").count() == 2


def test_empty_table(spark, folder):
    t = Tables(spark, folder)
    t.overwrite("x", spark.createDataFrame([], "k int, v string"))
    assert t.read("x").count() == 0 and t.read("x").columns == ["k", "v"]


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["day"]}, {"bucket_by": (3, "k")}, {"partition_by": ["day"], "bucket_by": (3, "k")}])
def test_merge_update(spark, folder, layout):
    t = Tables(spark, folder)
    base = spark.createDataFrame([(1, "a", None), (2, "a", 5.0), (None, "b", 7.0), (4, None, 8.0)], "k int, day string, v double")
    t.overwrite("x", base, **layout)
    t.merge_update("x", spark.createDataFrame([(1, 1.5), (4, None), (9, 9.0), (None, 3.0)], "k int, v double"), "k", ["v"])
    got = {(r["k"], r["day"]): r["v"] for r in t.read("x").collect()}
    assert got == {(1, "a"): 1.5, (2, "a"): 5.0, (None, "b"): 7.0, (4, None): None}
    assert t.partition_by("x") == layout.get("partition_by", []) and t.bucket_by("x") == layout.get("bucket_by")
    with pytest.raises(ValueError, match="more than once"):
        t.merge_update("x", spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, v double"), "k", ["v"])


def test_merge_rewrites_only_touched_partitions(spark, folder):
    t = Tables(spark, folder)
    t.overwrite("x", spark.range(100).selectExpr("id", "cast(id % 10 as string) AS day", "cast(null as double) AS v"), partition_by=["day"])
    files = lambda: {(r["day"], r["f"]) for r in t.read("x").select("day", F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    t.merge_update("x", spark.createDataFrame([(13, 1.0)], "id bigint, v double"), "id", ["v"])
    assert {d for d, _ in files() ^ before} == {"3"}
    assert t.read("x").count() == 100 and t.read("x").filter("v is not null").count() == 1
    before = files()
    t.merge_update("x", spark.createDataFrame([(1000, 1.0)], "id bigint, v double"), "id", ["v"])  # no match
    assert files() == before


def test_merge_moves_no_row_of_a_bucketed_table(spark, folder, monkeypatch):
    t = Tables(spark, folder)
    t.overwrite("x", spark.range(1000).selectExpr("id", "cast(id % 3 as string) AS day", "cast(null as double) AS v"), partition_by=["day"], bucket_by=(4, "id"))
    plans, insert = [], t._insert
    monkeypatch.setattr(t, "_insert", lambda name, df, **kw: plans.append(df._jdf.queryExecution().executedPlan().toString()) or insert(name, df, **kw))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "long").asNondeterministic()
    try:
        t.merge_update("x", spark.range(0, 1000, 7).select(count("id").alias("id"), F.lit(1.0).alias("v")), "id", ["v"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans[0].count("Exchange hashpartitioning") == 1  # of the source only
    assert t.read("x").filter("v = 1").count() == 143 and seen.value == 143  # the source is computed once


def test_replaced_partitions_and_those_left_empty(spark, folder):
    t = Tables(spark, folder)
    t.overwrite("x", spark.range(6).selectExpr("id", "cast(id % 3 as string) AS day"), partition_by=["day"])
    t.replace_partitions("x", spark.createDataFrame([(10, "0")], "id bigint, day string"), [["0"], ["1"]])
    assert rows(t.read("x"), "id", "day") == [(2, "2"), (5, "2"), (10, "0")]
    t.overwrite("y", spark.range(3))
    with pytest.raises(ValueError):
        t.replace_partitions("y", spark.range(1), [])


def test_changes_between_snapshots(spark, folder):
    t = Tables(spark, folder)
    t.overwrite("x", spark.range(20).selectExpr("id", "cast(id % 4 as string) AS day", "id * 1.0D AS v"), keys=["id"], partition_by=["day"], bucket_by=(2, "id"))
    t.snapshot("x", "before")
    assert t.keys("before") == ["id"] and t.bucket_by("before") == (2, "id") and t.partition_by("before") == ["day"]
    assert t.changes("before", "x", ["id"]).count() == 0
    t.merge_update("x", spark.createDataFrame([(3, -1.0), (7, 7.0), (5, None)], "id bigint, v double"), "id", ["v"])
    t.append("x", spark.createDataFrame([(99, "2", 9.0)], "id bigint, day string, v double"))
    got = {(r["id"], r["v"], r["_change"]) for r in t.changes("before", "x", ["id"]).collect()}
    assert got == {(3, 3.0, "update_preimage"), (3, -1.0, "update_postimage"), (5, 5.0, "update_preimage"), (5, None, "update_postimage"), (99, 9.0, "insert")}


def test_diff_deletes_and_new_columns(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "b", None), (3, "c", 1)], "k int, v string, w int")
    got = {(r["k"], r["_change"]) for r in diff(old, new, ["k"]).collect()}
    assert got == {(1, "delete"), (3, "insert")}


def test_diff_of_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (4, "d"), (4, "e")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (1, "a"), (1, "z"), (2, "b"), (2, "b"), (3, "x"), (4, "e")], "k int, v string")
    got = sorted((r["k"], r["v"], r["_change"]) for r in diff(old, new, ["k"]).collect())
    assert got == [(1, "z", "insert"), (2, "b", "insert"), (3, "c", "update_preimage"), (3, "x", "update_postimage"), (4, "d", "delete")]


def test_clone_and_ctas(spark, folder, sf_dir):
    t = Tables(spark, folder)
    t.clone(f"{sf_dir}/nation.parquet", "n")
    assert t.read("n").schema["n_name"].dataType.simpleString() == "string" and t.read("n").count() == 25
    t.read("n").createOrReplaceTempView("nv")
    t.ctas("m", "SELECT n_regionkey, count(*) AS c FROM nv GROUP BY 1")
    assert t.read("m").agg(F.sum("c")).first()[0] == 25


def test_features_key_is_checked(spark, folder):
    f = Features(Tables(spark, folder))
    f.write("x", spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double"), ["k"])
    assert f.keys("x") == ["k"] and f.read("x").count() == 2
    for bad in ([(1, 1.0), (1, 2.0)], [(None, 1.0)]):
        with pytest.raises(ValueError):
            f.write("x", spark.createDataFrame(bad, "k int, v double"), ["k"])
    assert f.read("x").count() == 2


def test_expectations(spark, folder):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", 0), ("d", None)], "t string, n int")
    rules = {"named": "t IS NOT NULL", "positive": "n > 0"}
    watched, obs = expect(df, rules)
    assert watched.count() == 4
    assert violations(obs, rules) == {"named": 1, "positive": 2}
    assert {r["name"]: (r["passed"], r["failed"]) for r in expect_counts(df, rules).collect()} == {"named": (3, 1), "positive": (2, 2)}
    assert sorted(r["broken"] for r in failing_rows(df, rules).collect()) == ["named", "positive", "positive"]
    with pytest.raises(ExpectationError) as e:
        expect_or_fail(df, rules)
    assert e.value.failures == {"named": 1, "positive": 2}
    t = Tables(spark, folder)
    t.overwrite("x", df.filter("n > 0"), expects={"positive": "n > 0"})
    with pytest.raises(ExpectationError):
        t.overwrite("x", df, expects={"positive": "n > 0"})
    assert t.read("x").count() == 2
    with pytest.raises(ExpectationError):
        t.append("x", df, expects={"positive": "n > 0"})
    assert t.read("x").count() == 2


def test_datasets_report_and_fails(spark, folder):
    raw = spark.createDataFrame([("p", "a", "3"), (None, "b", "2"), ("p", "c", "5")], RAW_SCHEMA)
    raw.write.json(f"{folder}/in")
    ds = clickstream_datasets(spark, f"{folder}/in", Tables(spark, f"{folder}/t"), page="p")
    assert [tuple(r) for r in ds.refresh("top_referrers").collect()] == [("c", 5), ("a", 3)]
    assert ds.report("clickstream_prepared") == {"valid_current_page_title": 1}
    assert ds.tables.comment("clickstream_raw") == "Raw click pairs as ingested."
    spark.createDataFrame([("p", "d", "zero"), ("p", "e", "0")], RAW_SCHEMA).write.mode("append").json(f"{folder}/in")
    with pytest.raises(ExpectationError) as e:
        ds.refresh("top_referrers")
    assert e.value.failures == {"valid_count": 2}
    assert ds.tables.read("top_referrers").count() == 2  # the published version stays


def test_readers(spark, folder):
    df = spark.createDataFrame([(1, "x y", 2.5), (2, None, None)], "k int, s string, v double")
    df.write.json(f"{folder}/j")
    assert rows(read_json(spark, f"{folder}/j", "k int, s string, v double").na.fill({"s": "", "v": 0.0}), "k", "s", "v") == [(1, "x y", 2.5), (2, "", 0.0)]
    assert dict(read_json(spark, f"{folder}/j").dtypes)["k"] == "bigint"
    df.write.option("header", True).csv(f"{folder}/c")
    assert dict(read_csv(spark, f"{folder}/c").dtypes) == {"k": "int", "s": "string", "v": "double"}
    assert read_external(spark, "json", path=f"{folder}/j").count() == 2
    lit = from_rows(spark, [(1, "A")], "id int not null, name string not null")
    assert [f.nullable for f in lit.schema] == [False, False]
    import pandas as pd

    assert from_pandas(spark, pd.DataFrame({"a": [1, 2]})).count() == 2


def test_append_frames(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([("s",)], "y string")
    assert sorted(map(str, append_frames(a, b).collect())) == ["Row(x=1, y=None)", "Row(x=None, y='s')"]
