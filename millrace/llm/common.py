"""What the operators of this subpackage share: text rules, staged tables, hashes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir

#: White space of every word and line rule here: blank, tab to carriage return.
SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_of(c: str) -> Column:
    """The column as text, NULL as empty."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII text takes the byte-wise ``lower``, which then is the same."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def hash128(c: Column) -> list[Column]:
    """Two independent 64-bit hashes, ``h1`` and ``h2``."""
    return [F.xxhash64(F.lit(1), c).alias("h1"), F.xxhash64(F.lit(2), c).alias("h2")]


def row_key(id_col: Column, digest: Column) -> Column:
    """A text that is equal exactly for equal (id, digest), with NULL ids equal to each other."""
    return F.concat_ws(":", F.when(id_col.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), id_col.cast("string"))), digest.cast("string"))


def packed(rows: DataFrame) -> Column:
    """The whole row as one struct ``_row``, so that its column names meet no others."""
    return F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Let Spark remove a job's shuffle files as soon as its result is stored."""
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)


_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch(spark: SparkSession):
    """Tables staged inside are removed at the end, but for those staged with ``outer``.

    What is left must not read them: results are staged with ``outer`` before the end.
    """
    own: list[str] = []
    token = _SCRATCH.set((*_SCRATCH.get(), own))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        conf = spark._jsc.hadoopConfiguration()
        for path in own:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def staged(df: DataFrame, label: str, outer: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, lost executors lose nothing.

    With ``outer`` it outlives the innermost ``scratch`` and belongs to the one around it, if any.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    scopes = _SCRATCH.get()[: -1 if outer else None]
    if scopes:
        scopes[-1].append(path)
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bitmap(hashes: DataFrame, bits: int = 24) -> np.ndarray:
    """The set bits of a table of one 64-bit hash, by its leading bits: 2^bits bits however many rows there are."""
    h = f"`{hashes.columns[0]}`"
    place = f"shiftrightunsigned({h}, {64 - bits})"
    one = hashes.select(F.expr(f"shiftright({place}, 6)").alias("slot"), F.expr(f"shiftleft(1L, CAST({place} & 63 AS INT))").alias("word"))
    found = one.groupBy("slot").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["slot"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set; hashes that are not in the table meet a set bit by chance only."""
    place = hashes.view(np.uint64) >> np.uint64(65 - (len(bits) * 8).bit_length())
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def slots(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Cut a long text at white space into pieces of about ``size`` bytes, so that no word is cut."""
    start, n = 0, len(data)
    while n - start > size:
        end = start + size
        cut = max(data.rfind(s, start, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\f"))
        if cut <= start:  # one word longer than a piece
            ends = [p for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\f") if (p := data.find(s, end)) >= 0]
            cut = min(ends, default=n)
        yield data[start:cut]
        start = cut
    yield data[start:]
