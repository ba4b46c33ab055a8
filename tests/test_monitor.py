import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators.metrics import Metric
from millrace.operators.monitor import (
    alerts, daily_profile, drift_categorical, drift_numeric, drift_previous, exact_quantiles, profile, profile_all, quality,
    refresh, top_values, with_slices,
)
from millrace.sources.tables import Tables

DAY = dt.datetime(2024, 1, 1)


def log(spark, rows):
    made = [(i, DAY + dt.timedelta(days=d, hours=1), "m", c, v) for i, (d, c, v) in enumerate(rows)]
    return spark.createDataFrame(made, "id int, ts timestamp, model_id string, c string, v double")


def test_profile(spark):
    df = log(spark, [(0, "a", 1.0), (0, "a", 3.0), (0, "b", None), (1, None, 5.0)])
    custom = [Metric("aggregate", "total", ("v",), "sum(`{{input_column}}`)"), Metric("derived", "half", ("v",), "total / 2")]
    got = {
        (r["window_start"].day, r["slice_key"], r["slice_value"], r["column"]): r
        for r in profile(df, "ts", "1 day", ["v"], ["c"], ["c", "v > 2"], exact=True, probs=[0.5], custom=custom).collect()
    }
    r = got[(1, "all", "all", "v")]
    assert (r["n"], r["n_null"], r["n_distinct"], r["mean"], r["min"], r["max"]) == (2, 1, 2, 2.0, 1.0, 3.0)
    assert r["quantiles"] == [1.0] and r["total"] == 4.0 and r["half"] == 2.0
    assert got[(1, "c", "a", "v")]["n"] == 2 and got[(1, "v > 2", "null", "c")]["n"] == 1
    assert got[(2, "c", "null", "c")]["n_null"] == 1 and got[(1, "all", "all", "c")]["mean"] is None
    both = profile_all(df, "ts", ["1 day", "7 days"], numeric=["v"])
    assert {r["granularity"] for r in both.collect()} == {"1 day", "7 days"}


def test_slices_and_top_values(spark):
    df = log(spark, [(0, "a", 1.0), (0, "a", 3.0), (0, "b", 1.0)])
    assert with_slices(df, ["c"]).count() == 6
    assert [(r["value"], r["n"], r["rank"]) for r in top_values(df, "ts", "1 day", "c", 1).collect()] == [("a", 2, 1)]


@pytest.mark.parametrize("by", [[], ["c"]])
def test_quantiles(spark, by):
    rng = np.random.default_rng(0)
    rows = [(0, "hot" if i % 3 else (f"c{i % 4}" if i % 4 else None), float(rng.integers(0, 50))) for i in range(500)]
    df = log(spark, rows)
    got = {(r["c"] if by else None, r["prob"]): r["value"] for r in exact_quantiles(df, by, "v", [0.0, 0.1, 0.5, 1.0]).collect()}
    groups = {}
    for _, c, v in rows:
        groups.setdefault(c if by else None, []).append(v)
    for g, vals in groups.items():
        vals.sort()
        for p in (0.0, 0.1, 0.5, 1.0):
            assert got[(g, p)] == vals[max(int(np.ceil(p * len(vals))), 1) - 1]


def ks(a, b):
    every = np.sort(np.concatenate([a, b]))
    return np.abs(np.searchsorted(np.sort(a), every, "right") / len(a) - np.searchsorted(np.sort(b), every, "right") / len(b)).max()


def test_drift_numeric_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 1, 300).round(2)
    days = {"d1": rng.normal(0.5, 1, 200).round(2), "d2": np.full(50, 0.25), "d3": rng.normal(9, 1, 20).round(2)}
    b = spark.createDataFrame([(float(x),) for x in base] + [(None,)] * 10, "v double")
    c = spark.createDataFrame([(d, float(x)) for d, xs in days.items() for x in xs] + [("d1", None)] + [("d4", None)] + [(None, 0.25)] * 50, "day string, v double")
    got = {r["day"]: r for r in drift_numeric(c, b, ["v"], by=["day"]).collect()}
    for d, xs in days.items():
        assert got[d]["ks"] == pytest.approx(ks(xs, base)) and got[d]["mean_delta"] == pytest.approx(xs.mean() - base.mean())
    assert got["d1"]["count_delta"] == 201 - 310 and got["d1"]["null_share_delta"] == pytest.approx(1 / 201 - 10 / 310)
    assert got[None]["ks"] == got["d2"]["ks"]
    assert got["d4"]["ks"] is None and got["d4"]["mean_delta"] is None
    assert drift_numeric(b, b, ["v"]).first()["ks"] == 0


def test_drift_categorical_identity_and_disjoint(spark):
    a = spark.createDataFrame([("x",)] * 6 + [("y",)] * 3 + [(None,)], "c string")
    same = drift_categorical(a, a, ["c"]).first()
    assert all(abs(same[m]) < 1e-12 for m in ("total_variation", "psi", "js_divergence", "chi_square", "unseen_share"))
    other = drift_categorical(spark.createDataFrame([("z",)] * 4, "c string"), a, ["c"]).first()
    assert other["total_variation"] == pytest.approx(1) and other["js_divergence"] == pytest.approx(1) and other["unseen_share"] == 1


def test_quality_alerts_and_previous(spark):
    df = log(spark, [(0, "a", 1.0), (0, "a", None), (1, "b", 4.0)]).withColumn("p", F.lit(2.0))
    got = {r["window_start"].day: (r["n"], r["mse"]) for r in quality(df, "ts", "1 day", "v", "p").collect()}
    assert got == {1: (1, 1.0), 2: (1, 4.0)}
    rows = drift_previous(profile(df, "ts", "1 day", ["v"])).collect()
    assert len(rows) == 1 and rows[0]["mean_delta"] == 3.0 and rows[0]["n_delta"] == 0
    m = spark.createDataFrame([(1, 0.5), (2, None), (3, 2.0)], "k int, psi double")
    assert [(r["k"], r["alert"]) for r in alerts(m, {"high": "psi > 1", "any": "psi >= 0.5"}).orderBy("k", "alert").collect()] == [(1, "any"), (3, "any"), (3, "high")]


def test_refresh_equals_recomputation(spark, folder):
    t = Tables(spark, folder)
    df = log(spark, [(i % 5, "ab"[i % 2], float(i)) for i in range(50)]).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    args = dict(numeric=["v"], categorical=["c"], exact=True)
    t.overwrite("log", df, partition_by=["day"])
    t.overwrite("prof", daily_profile(t.read("log"), "ts", **args), partition_by=["day"])
    t.snapshot("log", "before")
    t.merge_update("log", spark.createDataFrame([(3, -100.0), (8, 5.0)], "id int, v double"), "id", ["v"])
    files = lambda: {(r["day"], r["f"]) for r in t.read("prof").select("day", F.input_file_name().alias("f")).distinct().collect()}
    old = files()
    refresh(t, "before", "log", "prof", "id", "ts", **args)
    assert {d for d, _ in files() ^ old} == {"2024-01-04"}
    key = ["day", "column", "slice_key"]
    want = sorted(map(str, daily_profile(t.read("log"), "ts", **args).select(*sorted(t.read("prof").columns)).collect()))
    assert sorted(map(str, t.read("prof").select(*sorted(t.read("prof").columns)).collect())) == want and key
    t.snapshot("log", "before")
    old = files()
    refresh(t, "before", "log", "prof", "id", "ts", **args)
    assert files() == old  # nothing changed, nothing written
