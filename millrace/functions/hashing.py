"""Reproducible pseudo-random values derived from a row's own key.

``rand()``, ``uuid()`` and ``randomSplit`` depend on the layout of the data, so a retry or another
partitioning changes the answer.  An md5 prefix of key and seed does not, costs no shuffle, and can be
recomputed in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX_RANGE = 4294967296  # 2**32: eight hexadecimal digits


def hash32(key, seed: int | str = 42) -> Column:
    """Unsigned 32-bit integer from ``md5(key:seed)`` as a bigint."""
    col = F.col(key) if isinstance(key, str) else key
    text = F.concat_ws(":", col.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(key, seed: int | str = 42) -> Column:
    """Value in [0, 1) determined by key and seed."""
    return hash32(key, seed) / F.lit(float(PREFIX_RANGE))


def bucket(key, seed: int | str = 42, buckets: int = 100) -> Column:
    """Bucket number 0 .. buckets-1 determined by key and seed."""
    return (hash32(key, seed) % F.lit(buckets)).cast("int")


def sql_hash32(key: str, seed: int | str = 42) -> str:
    """The same 32-bit value as SQL text for the DuckDB side of a check."""
    return f"('0x' || substr(md5(({key})::varchar || ':{seed}'), 1, 8))::bigint"


def sql_uniform(key: str, seed: int | str = 42) -> str:
    return f"({sql_hash32(key, seed)} / {PREFIX_RANGE}.0::double)"


def sql_bucket(key: str, seed: int | str = 42, buckets: int = 100) -> str:
    return f"({sql_hash32(key, seed)} % {buckets})"
