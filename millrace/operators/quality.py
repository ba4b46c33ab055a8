"""Row expectations.  A row passes when the condition is TRUE; FALSE and NULL both count as failed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ExpectationError(RuntimeError):
    """Raised when a failing expectation meets at least one violating row."""

    def __init__(self, failures: Mapping[str, int]):
        self.failures = dict(failures)
        super().__init__("expectations violated: " + ", ".join(f"{k} ({v} rows)" for k, v in failures.items()))


def passed(condition: str | Column) -> Column:
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(cond, F.lit(False))


def expect(df: DataFrame, expectations: Mapping[str, str], name: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach violation counters to ``df``.  They are filled by whatever action next runs over the
    returned frame, in the same pass; no row is removed."""
    obs = Observation(name) if name else Observation()
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count_if(~passed(c)).alias(f"failed_{i}") for i, c in enumerate(expectations.values())]
    return df.observe(obs, *counters), obs


def violations(obs: Observation, expectations: Mapping[str, str]) -> dict[str, int]:
    """Counters of an observed action by expectation name."""
    got = obs.get
    return {n: int(got.get(f"failed_{i}") or 0) for i, n in enumerate(expectations)}


def expect_counts(df: DataFrame, expectations: Mapping[str, str]) -> DataFrame:
    """``(name, passed, failed)`` from one aggregation over ``df``."""
    total = F.count(F.lit(1))
    rows = [
        F.struct(
            F.lit(n).alias("name"),
            F.count_if(passed(c)).alias("passed"),
            (total - F.count_if(passed(c))).alias("failed"),
        )
        for n, c in expectations.items()
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def failing_rows(df: DataFrame, expectations: Mapping[str, str]) -> DataFrame:
    """Violating rows with the names of the expectations they break."""
    broken = F.filter(
        F.array(*[F.when(~passed(c), F.lit(n)) for n, c in expectations.items()]), lambda x: x.isNotNull()
    )
    return df.withColumn("broken", F.array_join(broken, ",")).filter(F.col("broken") != "")


def expect_or_fail(df: DataFrame, expectations: Mapping[str, str]) -> DataFrame:
    """Count violations now and raise if there are any, else hand back ``df``."""
    bad = {r["name"]: r["failed"] for r in expect_counts(df, expectations).collect() if r["failed"]}
    if bad:
        raise ExpectationError(bad)
    return df
