"""Reproducible weighted splits and traffic routing by key digest: no shuffle, stable under retries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import bucket

_STEPS = 10_000


def pick(key: str | Column, weights: Mapping[str, float], seed: int | str) -> Column:
    """Name drawn for each key with probability proportional to its weight."""
    total = sum(weights.values())
    if not weights or total <= 0 or min(weights.values()) < 0:
        raise ValueError("weights must be non-negative and not all zero")
    drawn, edge, out = bucket(key, seed, _STEPS), 0.0, None
    names = list(weights)
    for name in names[:-1]:
        edge += weights[name]
        cond = drawn < F.lit(round(edge / total * _STEPS))
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])


def with_split(df: DataFrame, key: str, weights: Mapping[str, float], seed: int = 42, out: str = "split") -> DataFrame:
    return df.withColumn(out, pick(key, weights, seed))


def split(df: DataFrame, key: str, weights: Sequence[float], seed: int | str = 42) -> list[DataFrame]:
    """Disjoint frames that together hold every row.  To split a part again, give another seed."""
    named = {str(i): w for i, w in enumerate(weights)}
    tagged = with_split(df, key, named, seed, "_split")
    return [tagged.filter(F.col("_split") == n).drop("_split") for n in named]


def split_audit(df: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    """One row: source rows, part rows, keys missing from the parts, foreign keys, keys in two parts.

    Source and parts are unioned and counted per key in one shuffle (partial counts first)."""
    tagged = df.select(F.col(key).alias("_k"), F.lit(-1).alias("_p"))
    for i, p in enumerate(parts):
        tagged = tagged.unionByName(p.select(F.col(key).alias("_k"), F.lit(i).alias("_p")))
    member = [F.max(F.when(F.col("_p") == i, 1).otherwise(0)) for i in range(len(parts))]
    held = member[0]
    for m in member[1:]:
        held = held + m
    per_key = tagged.groupBy("_k").agg(
        F.count_if(F.col("_p") < 0).alias("src"), F.count_if(F.col("_p") >= 0).alias("out"), held.alias("held")
    )
    return per_key.agg(
        F.sum("src").alias("source_rows"),
        F.sum("out").alias("part_rows"),
        F.count_if(F.col("out") < F.col("src")).alias("missing"),
        F.count_if(F.col("out") > F.col("src")).alias("extra"),
        F.count_if(F.col("held") > 1).alias("overlapping"),
    )


def route(df: DataFrame, key: str, variants: Mapping[str, float], seed: int | str = "route", out: str = "variant") -> DataFrame:
    """Assign each request key to a model variant, e.g. ``{"baseline": 90, "candidate": 10}``."""
    return df.withColumn(out, pick(key, variants, seed))
