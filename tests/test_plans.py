"""Shape of the physical plans, and rules the package keeps."""

import io
import re
from contextlib import redirect_stdout
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators.index import with_dense_index
from millrace.operators.metrics import regression_metrics
from millrace.operators.topk import best_per, top_n
from millrace.plans import all_queries, all_sql
from millrace.plans.monitoring import drift_consecutive, numeric_drift, profile_metrics, profile_quantiles
from millrace.plans.registry import table
from millrace.plans.table_jobs import inference
from millrace.sources.tables import Tables

PACKAGE = Path(__file__).resolve().parent.parent / "millrace"


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_top_n_is_bounded(spark, sf_dir):
    text = plan(top_n(table(spark, sf_dir, "lineitem"), F.col("l_tax").desc(), 10))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_metrics_read_two_columns_in_one_pass(spark, sf_dir):
    text = plan(regression_metrics(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity"))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in text
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(table(spark, sf_dir, "part").filter("p_size = 3").select("p_partkey"))
    assert "PushedFilters: [IsNotNull(p_size), EqualTo(p_size,3)]" in text


def test_best_per_aggregates_before_the_shuffle(spark, sf_dir):
    text = plan(best_per(table(spark, sf_dir, "part"), "p_brand", "p_retailprice", tie="p_partkey"))
    assert "partial_min_by" in text and "Window" not in text


def test_profile_multiplies_by_slices_only(spark, sf_dir):
    for text in (plan(profile_metrics(spark, sf_dir)), plan(drift_consecutive(spark, sf_dir))):
        assert text.count("Scan parquet") == 2 and "Expand" not in text
        assert all("value" not in keys.replace("slice_value", "") and "label" not in keys for keys in re.findall(r"hashpartitioning\((.*?)\)", text))


def test_drift_and_quantiles_read_their_rows_once(spark, sf_dir):
    """What is left to run starts from stored value counts."""
    for made in (numeric_drift(spark, sf_dir), profile_quantiles(spark, sf_dir)):
        assert "Scan parquet" not in plan(made)


def test_dense_index_has_no_single_partition(spark):
    text = plan(with_dense_index(spark.range(100), "i", ["id"]))
    assert "SinglePartition" not in text


def test_table_reads_prune_partitions(spark, sf_dir, folder):
    t = Tables(spark, folder)
    t.overwrite("log", inference(spark, sf_dir), partition_by=["day"])
    t.merge_update("log", inference(spark, sf_dir).filter("id = 5").select("id", F.lit(1.0).alias("label")), "id", ["label"])
    text = plan(t.read("log").filter("day = '2024-01-09'").select("id"))
    assert "PartitionFilters" in text and "ReadSchema: struct<id:bigint>" in text
    assert t.read("log").count() == 1000


@pytest.mark.parametrize("word", ["toPandas", "localCheckpoint", "crossJoin", ".rdd", "applyInPandasWithState"])
def test_package_does_not_use(word):
    hits = [p.name for p in PACKAGE.rglob("*.py") if word in p.read_text()]
    assert hits == []


def test_no_query_runs_on_literal_rows_only():
    assert len(all_queries()) >= 100 and len(all_sql()) >= 80
    for name in all_queries():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)


def test_pandas_rows_takes_no_part_of_a_longer_region(spark, sf_dir, monkeypatch):
    from millrace.plans import preparation

    long = spark.range(1001).select(F.col("id").alias("r_regionkey"), F.lit("x").alias("r_name"))
    monkeypatch.setattr(preparation, "table", lambda s, d, name: long if name == "region" else table(s, d, name))
    with pytest.raises(ValueError, match="1000"):
        preparation.pandas_rows(spark, sf_dir)
