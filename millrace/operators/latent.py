"""TF-IDF over hashed tokens and its latent vectors by a distributed randomised SVD.

A token's slot is a digest, a document a sparse row of counts times weights, scaled to unit length.  The right singular vectors
come from a range finder with power iterations: each pass multiplies the matrix and its transpose by a thin block without
either leaving the tasks - a row adds its part to ``slots x (rank + oversample)`` sums, which are added up by Spark in blocks -
and the driver only makes the block orthogonal.  What it sees depends on slots and rank, never on the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import hash32
from millrace.operators.features import tokens
from millrace.session import shared_dir

_BLOCK = 256  # slots per row of the sums
_FEW = 8192  # up to so many slots, rows are multiplied as dense ones
_CELLS = 1 << 20  # numbers of dense rows at once


def token_slots(text: str | Column, slots: int) -> Column:
    """The slot of every token, in order; NULL text has none."""
    return F.coalesce(F.transform(tokens(text), lambda t: (hash32(t, "slot") % slots).cast("int")), F.array().cast("array<int>"))


def _token_bytes(text: str | Column) -> Column:
    return F.coalesce(F.transform(tokens(text), lambda t: t.cast("binary")), F.array().cast("array<binary>"))


def _slotted(batch: pa.Array, slots: int) -> pa.Array:
    """``token_slots`` of lists of tokens: a batch's different tokens are digested once."""
    found = batch.flatten().dictionary_encode()
    slot = [int(hashlib.md5(t + b":slot").hexdigest()[:8], 16) % slots for t in found.dictionary.to_pylist()]
    ends = batch.offsets.to_numpy()
    return pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(np.array(slot, np.int32)[found.indices.to_numpy()]))


def idf_weights(df: DataFrame, text: str, slots: int) -> np.ndarray:
    """ln((rows + 1) / (rows with the slot + 1)) of every slot; one row per slot reaches the driver."""
    rows = df.count()
    held = np.zeros(slots)
    for r in df.select(F.explode(F.array_distinct(token_slots(text, slots))).alias("s")).groupBy("s").count().collect():
        held[r["s"]] = r["count"]
    return np.log((rows + 1) / (held + 1))


def _counted(batch: pa.Array, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, count) of the different slots of every row."""
    ends = batch.offsets.to_numpy()
    slot = batch.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    key, count = np.unique(np.repeat(np.arange(len(batch)), np.diff(ends)) * slots + slot, return_counts=True)
    return *np.divmod(key, slots), count


def _unit(row: np.ndarray, slot: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """Values of ``n`` unit-length TF-IDF rows."""
    value = count * idf[slot]
    norm = np.sqrt(np.bincount(row, value**2, n))
    return value / np.where(norm > 0, norm, 1.0)[row]


def _rows(batch: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of unit-length TF-IDF rows."""
    row, slot, count = _counted(batch, len(idf))
    return row, slot, _unit(row, slot, count, idf, len(batch))


def tfidf(df: DataFrame, id_: str, text: str, idf: np.ndarray) -> DataFrame:
    """``(id, slot, weight)``: the unit-length TF-IDF row of every text, its entries only."""
    shared = df.sparkSession.sparkContext.broadcast(idf)
    kind = df.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, slot, value = _rows(b.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(slot.astype(np.int32)), pa.array(value)], names=["id", "slot", "weight"])

    rows = df.select(F.col(id_).alias("id"), token_slots(text, len(idf)).alias("s"))
    return rows.mapInArrow(run, f"id {kind}, slot int, weight double").withColumnRenamed("id", id_)


def _times(row: np.ndarray, slot: np.ndarray, value: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    """Sparse rows times ``block``: (n, width)."""
    out = np.zeros((n, block.shape[1]))
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    if len(first):
        out[row[first]] = np.add.reduceat(block[slot] * value[:, None], first, axis=0)
    return out


def _squared(row: np.ndarray, slot: np.ndarray, value: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    """Transpose times sparse rows times ``block``: (slots, width)."""
    slots = len(block)
    if slots > _FEW:
        part, order = _times(row, slot, value, block, n), np.argsort(slot, kind="stable")
        return _times(slot[order], row[order], value[order], part, slots)
    total, some = np.zeros(block.shape), max(1, _CELLS // slots)
    cuts = np.searchsorted(row, np.arange(0, n + some, some))
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        dense = np.zeros((some, slots))
        dense[row[a:b] - i * some, slot[a:b]] = value[a:b]
        total += dense.T @ (dense @ block)
    return total


@dataclass
class LatentEncoder:
    """Documents to ``rank`` numbers: their TF-IDF row times the leading right singular vectors."""

    idf: np.ndarray
    vectors: np.ndarray  # (slots, rank)
    values: np.ndarray  # singular values

    def encode(self, df: DataFrame, text: str, out: str = "vector") -> DataFrame:
        """Add ``array<float>``; a text without tokens is at the origin."""
        shared = df.sparkSession.sparkContext.broadcast((self.idf, self.vectors))

        @F.arrow_udf("array<float>")
        def project(found: pa.Array) -> pa.Array:
            idf, vectors = shared.value
            made = _times(*_rows(_slotted(found, len(idf)), idf), vectors, len(found)).astype(np.float32)
            ends = np.arange(len(found) + 1, dtype=np.int32) * made.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))

        return df.withColumn(out, project(_token_bytes(text)))


def fit_latent(df: DataFrame, text: str, slots: int = 4096, rank: int = 64, oversample: int = 10, iterations: int = 2, seed: int = 42) -> LatentEncoder:
    """The leading right singular vectors of the table's TF-IDF matrix; ``iterations`` + 2 passes over its stored slots."""
    spark = df.sparkSession
    width = min(rank + oversample, slots)
    path = shared_dir(spark, "token-slots")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, slot, count = _counted(_slotted(b.column(0), slots), slots)
            ends = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (slot, count)]
            yield pa.RecordBatch.from_arrays(lists, names=["s", "c"])

    df.select(_token_bytes(text).alias("t")).mapInArrow(counted, "s array<int>, c array<int>").write.parquet(path)
    rows = spark.read.parquet(path)
    held = np.zeros(slots)
    for r in rows.select(F.explode("s").alias("s")).groupBy("s").count().collect():  # one row per slot
        held[r["s"]] = r["count"]
    idf = np.log((rows.count() + 1) / (held + 1))

    def summed(block: np.ndarray) -> np.ndarray:
        """Transpose times matrix times ``block``."""
        shared = spark.sparkContext.broadcast((idf, block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            idf, block = shared.value
            total = np.zeros((len(idf), block.shape[1]))
            for b in batches:
                slot, count = (c.flatten().to_numpy() for c in b.columns)
                row = np.repeat(np.arange(b.num_rows), np.diff(b.column(0).offsets.to_numpy()))
                total += _squared(row, slot, _unit(row, slot, count, idf, b.num_rows), block, b.num_rows)
            cuts = range(0, len(total), _BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(list(cuts), pa.int32()), pa.array([total[a : a + _BLOCK].ravel().tolist() for a in cuts])], names=["at", "sums"])

        made = rows.mapInArrow(run, "at int, sums array<double>").select("at", F.posexplode("sums").alias("i", "x"))
        found = made.groupBy("at", "i").agg(F.sum("x").alias("x")).toArrow()  # slots x width numbers
        out = np.zeros((-(-slots // _BLOCK), _BLOCK * block.shape[1]))
        out[found["at"].to_numpy() // _BLOCK, found["i"].to_numpy()] = found["x"].to_numpy()
        return out.reshape(-1, block.shape[1])[:slots]

    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(slots, width)))[0]
    for _ in range(iterations + 1):
        basis = np.linalg.qr(summed(basis))[0]
    square = basis.T @ summed(basis)  # the matrix' squares, seen from the basis
    values, turned = np.linalg.eigh((square + square.T) / 2)
    lead = np.argsort(-values)[:rank]
    vectors = basis @ turned[:, lead]
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(lead))] < 0, -1.0, 1.0)
    return LatentEncoder(idf, vectors, np.sqrt(np.maximum(values[lead], 0.0)))
