"""Every query with SQL text gives the rows DuckDB gives on the same files."""

import pytest

from check import compare, duck
from millrace.plans import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, sf_dir, con, name):
    ok, message, _ = compare(QUERIES[name](spark, sf_dir), con, SQL[name])
    assert ok, message


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["referrer", "click_count"]
    counts = [r["click_count"] for r in df.collect()]
    assert 0 < len(counts) <= 10 and counts == sorted(counts, reverse=True)
