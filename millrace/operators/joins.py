"""Key joins of prediction, truth, group results and feature tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import sized_broadcast


def join_truth(pred: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    return pred.join(truth, key)


def attach_groups(df: DataFrame, groups: DataFrame, key: str, max_bytes: int = 64 << 20) -> DataFrame:
    """Left join of one-row-per-group results.  The group table is computed once and stored; below
    ``max_bytes`` it is sent to the rows, so a group that holds a third of them is not shuffled to one task."""
    return df.join(sized_broadcast(groups, max_bytes), key, "left")


@dataclass(frozen=True)
class Lookup:
    """Feature columns to take from a keyed table (all non-key columns when none are named)."""

    table: DataFrame
    key: str
    features: tuple[str, ...] = field(default=())

    def frame(self) -> DataFrame:
        return self.table.select(self.key, *(self.features or [c for c in self.table.columns if c != self.key]))


def lookup(df: DataFrame, lookups: Iterable[Lookup], label: str | None = None, exclude: Iterable[str] = ()) -> DataFrame:
    """Left join every lookup on its key.  Of ``df`` itself only the keys, and the label, are kept."""
    lookups = list(lookups)
    keys = list(dict.fromkeys(x.key for x in lookups))
    made = df.select(*keys, *([label] if label and label not in keys else []))
    for x in lookups:
        made = made.join(x.frame(), x.key, "left")
    return made.drop(*exclude)


def score_lookup(keys: DataFrame, lookups: Iterable[Lookup], score, out: str = "prediction") -> DataFrame:
    """Keys in, features looked up, ``score(frame) -> frame with the prediction column`` applied."""
    lookups = list(lookups)
    return score(lookup(keys, lookups)).select(*dict.fromkeys(x.key for x in lookups), out)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same rows, counted by value digest (used after copies)."""
    def digest(df: DataFrame):
        cols = sorted(df.columns)
        return df.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("h"),
        ).first()

    return digest(a) == digest(b)
