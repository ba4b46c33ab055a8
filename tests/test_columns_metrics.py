import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import (
    cast, cast_all, categorical_columns, fill_template, map_get, numeric_columns, recode, sanitize_names, select_by_type,
    with_constant, with_event_time, with_key, with_unique_id,
)
from millrace.functions.hashing import bucket
from millrace.operators.aggregates import concat_text, text_length, to_messages
from millrace.operators.features import (
    apply_minmax, apply_one_hot, bin_right_closed, fit_categories, fit_minmax, minmax, one_hot, one_hot_vector, tokenize,
)
from millrace.operators.gates import ModelRejected, Threshold, champion, gate, gate_or_fail
from millrace.operators.index import running_sums, with_dense_index
from millrace.operators.metrics import Metric, classification_metrics, corr_matrix, custom_drift, custom_metrics, regression_metrics, to_class
from millrace.operators.splits import pick, route, split, split_audit
from millrace.operators.topk import best_per, head, latest, latest_version, top_n


def one(df):
    return df.first().asDict()


def test_casts(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", None)], "a string, b string")
    assert [tuple(r) for r in cast(df, {"a": "int", "b": "double"}).collect()] == [(1, 2.5), (None, None)]
    with pytest.raises(Exception):
        cast(df, {"a": "int"}, strict=True).collect()
    assert {t for _, t in cast_all(df, "bigint").dtypes} == {"bigint"}


def test_column_choice(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 3.0)], "k int, s string, v double, y double")
    assert select_by_type(df, [T.DoubleType], keep=["k"], exclude=["y"]).columns == ["k", "v"]
    assert categorical_columns(df) == ["s"] and numeric_columns(df, exclude=["k"]) == ["v", "y"]


def test_rewrites(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    assert [r[0] for r in recode(df, "s", ["a"], "z").collect()] == ["z", "b", None]
    made = with_event_time(with_constant(df, "n", None, "double"), "ts", 86400)
    assert dict(made.dtypes) == {"s": "string", "n": "double", "ts": "timestamp"}
    assert str(made.first()["ts"]).startswith("1970-01-02")


def test_names_and_keys(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, c int")
    assert sanitize_names(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError):
        sanitize_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))
    keyed = with_key(spark.range(100), "k", ["id"])
    assert keyed.select("k").distinct().count() == 100
    assert with_key(keyed, "u").select("u").distinct().count() == 100
    assert with_unique_id(spark.range(0, 100, 1, 7), "u").select("u").distinct().count() == 100


def test_template_does_not_expand_twice(spark):
    df = spark.createDataFrame([("{b}", "B"), (None, "B")], "a string, b string")
    assert [r["o"] for r in fill_template(df, "{a}-{b}-{c}", {"a": "a", "b": "b"}, "o").collect()] == ["{b}-B-{c}", "-B-{c}"]


def test_map_get(spark):
    df = spark.createDataFrame([({"g": "1"},), ({},), (None,)], "tags map<string,string>")
    assert [r[0] for r in df.select(map_get("tags", "g")).collect()] == ["1", None, None]


@pytest.mark.parametrize("parts", [1, 5])
def test_dense_index(spark, parts):
    df = spark.range(0, 500, 1, parts).select("id", (F.col("id") % 3).alias("hot"))  # few values, a third of the rows each
    got = [(r["hot"], r["id"], r["i"]) for r in with_dense_index(df, "i", ["hot", "id"]).collect()]
    assert [g[2] for g in sorted(got)] == list(range(500))


def test_dense_index_empty(spark):
    assert with_dense_index(spark.range(0), "i", ["id"]).count() == 0


def test_running_sums(spark):
    df = spark.range(300).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 300).alias("v"), F.lit(2).cast("bigint").alias("c"))
    for g in (0, 1):
        got = [(r["v"], r["cum_c"]) for r in running_sums(df, ["g"], ["v"], ["c"]).filter(F.col("g") == g).collect()]
        assert [c for _, c in sorted(got)] == [2 * (i + 1) for i in range(150)]


def test_topk(spark):
    df = spark.createDataFrame([("a", 1, 3.0), ("a", 2, 3.0), ("b", 3, None), ("b", 4, 9.0), ("c", 5, None)], "f string, k int, m double")
    assert sorted((r["f"], r["k"]) for r in best_per(df, "f", "m", tie="k").collect()) == [("a", 1), ("b", 4)]
    assert [r["k"] for r in top_n(df, F.col("m").desc(), 3, tie=["k"]).collect()] == [4, 1, 2]
    assert [r["k"] for r in latest(df, "k", 2).collect()] == [5, 4]
    assert sorted((r["f"], r["k"]) for r in latest_version(df, "f", "k").collect()) == [("a", 2), ("b", 4), ("c", 5)]
    assert [r["k"] for r in head(df, "k", 2).collect()] == [1, 2]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0), (None, 1.0), (7.0, None)], "y double, p double")
    m = one(regression_metrics(df, "y", "p"))
    assert m["n"] == 3 and m["mse"] == pytest.approx(2 / 3) and m["rmse"] == pytest.approx(math.sqrt(2 / 3)) and m["r2"] == pytest.approx(1 - 2 / 8)
    flat = one(regression_metrics(spark.createDataFrame([(2.0, 1.0)], "y double, p double"), "y", "p"))
    assert flat["r2"] is None
    none = one(regression_metrics(df.limit(0), "y", "p"))
    assert none["n"] == 0 and none["mse"] is None


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "y int, p int")
    m = one(classification_metrics(df, "y", "p"))
    assert (m["accuracy"], m["precision"], m["recall"]) == (0.6, pytest.approx(2 / 3), pytest.approx(2 / 3)) and m["f1"] == pytest.approx(2 / 3)
    m = one(classification_metrics(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p"))
    assert m["f1"] == 0 and m["accuracy"] == 1
    assert [r[0] for r in spark.createDataFrame([(0.5,), (1.5,), (0.51,)], "p double").select(to_class("p")).collect()] == [0, 2, 1]


def test_corr_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in corr_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "a")] == 1.0 and got[("a", "b")] is None and len(got) == 4


def test_custom_metrics(spark):
    metrics = [
        Metric("aggregate", "m", ("x", "y"), "avg(`{{input_column}}`)"),
        Metric("derived", "twice", ("x",), "2 * m_{{input_column}}"),
        Metric("drift", "d", ("x",), "{{current_df}}.twice - {{base_df}}.twice"),
    ]
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "g string, x double, y double")
    cur, base = custom_metrics(df, metrics, by=["g"]), custom_metrics(df, metrics)
    assert {r["g"]: r["d"] for r in custom_drift(cur, base, metrics, keep=["g"]).collect()} == {"a": -2.0, "b": 2.0}
    assert {r["g"]: r["d"] for r in custom_drift(cur, cur, metrics, on=["g"]).collect()} == {"a": 0.0, "b": 0.0}


def test_splits(spark):
    df = spark.range(5000)
    for parts in (split(df, "id", [0.6, 0.2, 0.2]), split(df.repartition(13), "id", [0.6, 0.2, 0.2])):
        sizes = [p.count() for p in parts]
        assert sum(sizes) == 5000 and abs(sizes[0] - 3000) < 150
    a = one(split_audit(df, parts, "id"))
    assert a == {"source_rows": 5000, "part_rows": 5000, "missing": 0, "extra": 0, "overlapping": 0}
    a = one(split_audit(df, [parts[0], parts[0], parts[1]], "id"))
    assert a["overlapping"] == sizes[0] and a["missing"] == sizes[2]
    again = split(parts[0], "id", [0.5, 0.5], seed="again")
    assert abs(again[0].count() - sizes[0] / 2) < 150
    shares = {r["variant"]: r["count"] for r in route(df, "id", {"a": 90, "b": 10}).groupBy("variant").count().collect()}
    assert abs(shares["b"] - 500) < 100
    with pytest.raises(ValueError):
        pick("id", {}, 1)
    assert spark.createDataFrame([(42,)], "k int").select(bucket("k", 42, 100)).first()[0] == int(__import__("hashlib").md5(b"42:42").hexdigest()[:8], 16) % 100


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b x"), (2, "a"), (3, None)], "k int, c string")
    made = one_hot(df, ["c"])
    assert made.columns == ["k", "c_a", "c_b_x"]
    assert sorted(tuple(r) for r in made.collect()) == [(1, 0.0, 1.0), (2, 1.0, 0.0), (3, 0.0, 0.0)]
    unseen = apply_one_hot(spark.createDataFrame([(9, "new")], "k int, c string"), fit_categories(df, ["c"]))
    assert tuple(unseen.first()) == (9, 0.0, 0.0)
    with pytest.raises(ValueError, match="more than 1 categories"):
        fit_categories(df, ["c"], max_categories=1)
    assert fit_categories(spark.createDataFrame([(None,)], "c string"), ["c"]) == {"c": []}


def test_one_hot_vector_ignores_unseen(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    model = one_hot_vector(["c"], ["v"]).fit(train)
    got = {r["c"]: r["v"].toArray().tolist() for r in model.transform(spark.createDataFrame([("b",), ("zz",)], "c string")).collect()}
    assert got == {"b": [0.0, 1.0, 0.0], "zz": [0.0, 0.0, 0.0]}


def test_bins(spark):
    df = spark.createDataFrame([(v,) for v in (20.0, 20.5, 30.0, 31.0, 80.0, 81.0, None)], "x double")
    got = [r[0] for r in df.select(bin_right_closed("x", [20, 30, 40, 50, 60, 70, 80], [1, 2, 3, 4, 5, 6])).collect()]
    assert got == [None, 1, 1, 2, 6, None, None]
    with pytest.raises(ValueError):
        bin_right_closed("x", [1, 2], [1, 2])


def test_minmax(spark):
    train = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0)], "a double, b double")
    test = spark.createDataFrame([(20.0, 5.0), (None, 7.0)], "a double, b double")
    assert [tuple(r) for r in apply_minmax(test, fit_minmax(train, ["a", "b"])).collect()] == [(2.0, 0.0), (None, 0.0)]
    assert [r["a"] for r in minmax(train, test, ["a"], refit=True).collect()] == [0.0, None]


def test_texts(spark):
    df = spark.createDataFrame([(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in (3, 0, 2, 1, 4)], "k int, o int, r string, t string")
    parts = sorted(tuple(r) for r in concat_text(df, "k", "o", "t", start=1, per_part=2, sep=" ").collect())
    assert parts == [(1, 0, "t1 t2", 5), (1, 1, "t3 t4", 5)]
    assert tuple(text_length(df, "k", "o", "t", 1).first()) == (1, 8)
    chats = {r["segment"]: [m["content"] for m in r["messages"]] for r in to_messages(df, "k", "o", "r", "t", per_segment=3).collect()}
    assert chats == {0: ["t0", "t1", "t2"], 1: ["t3", "t4"]}
    assert tokenize(spark.createDataFrame([("A-b, É1",)], "t string"), "t", max_len=2).first()["tokens"] == ["a", "b"]


def metric_row(spark, **kw):
    return spark.createDataFrame([tuple(kw.values())], ", ".join(f"{k} double" for k in kw))


def test_gate(spark):
    t = {"rmse": Threshold(value=0.5, min_abs=0.05, min_rel=0.05, higher_is_better=False)}
    ok = gate(metric_row(spark, rmse=0.4), metric_row(spark, rmse=0.5), t).first()
    assert ok["accepted"]
    for cand, base in ((0.6, 0.9), (0.48, 0.5), (0.5, 0.5), (None, 0.5)):
        assert not gate(metric_row(spark, rmse=cand), metric_row(spark, rmse=base), t).first()["accepted"]
    higher = {"f1": Threshold(min_abs=0.1, greater_is_better=True)}
    assert gate_or_fail(metric_row(spark, f1=0.9), metric_row(spark, f1=0.7), higher).count() == 1
    with pytest.raises(ModelRejected):
        gate_or_fail(metric_row(spark, f1=0.75), metric_row(spark, f1=0.7), higher)
    with pytest.raises(ValueError):
        Threshold(value=1.0).higher()


def test_champion(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.0), (0.0, 0.0, 0.0)], "y double, a double, b double")
    won = {r["model"]: r["champion"] for r in champion(df, "y", {"base": "a", "cand": "b"}, "rmse").collect()}
    assert won == {"base": True, "cand": False}
    tie = {r["model"]: r["champion"] for r in champion(df, "y", {"base": "a", "cand": "a"}, "accuracy").collect()}
    assert tie == {"base": True, "cand": False}
