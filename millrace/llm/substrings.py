"""Substring dedup by Rabin-Karp hashes of every window of a fixed number of words, counted in Spark.

Tasks hash each word, and each window by a polynomial over its word hashes (differences of prefix sums, modulo 2^64).  A first
pass adds up the hashes of a chunk of documents and Spark groups and counts them.  Those found twice become a bitmap of fixed
size.  A second pass sends the windows that meet it with their places, one row per window and chunk, and two independent hashes,
128 bits together, settle which are repeated; a passage that a third of the
documents share stays as small as any.  Repeated windows are sorted by document and place and merge into maximal intervals of
words, and texts meet their intervals.  No task holds more than a chunk, a document, or what Spark can spill.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bitmap, in_bitmap, scratch, staged, word_pieces

_BYTE_BASE, _WORD_BASE, _CHECK_BASE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xCA5A826395121157))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0 .. base^(n-1) and those of its inverse, modulo 2^64."""
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hash of values[start:end], for many spans at once."""
    up, down = _powers(int(base), 1 << max(10, int(len(values)).bit_length()))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * down[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * up[ends - 1]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, piece by piece."""
    found = []
    for piece in word_pieces(text.encode("utf-8", "surrogatepass")):
        data = np.frombuffer(piece, np.uint8)
        if not len(data):
            continue
        edge = np.diff(np.r_[True, _SPACE[data], True].astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if len(starts):
            found.append(_mix(_spans_hash(data.astype(np.uint64) + np.uint64(1), starts, ends, _BYTE_BASE)))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def window_hashes(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, second hash) of every window."""
    starts = np.arange(max(0, len(words) - size + 1))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(_mix(_spans_hash(words, starts, starts + size, base)) for base in (_WORD_BASE, _CHECK_BASE))


def _chunks(batches: Iterator[pa.RecordBatch], size: int, chunk_words: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(k1, k2, t) to (keys, document, place, hash, check) of the windows of some documents at a time."""

    def chunk() -> tuple[np.ndarray, ...]:
        counts = [len(w) - size + 1 for w in words]
        pairs = [window_hashes(w, size) for w in words]
        place = np.concatenate([np.arange(n) for n in counts])
        return np.array(keys, np.int64), np.repeat(np.arange(len(counts)), counts), place, *(np.concatenate(p) for p in zip(*pairs))

    keys, words, held = [], [], 0
    for batch in batches:
        for k1, k2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            found = word_hashes(text.as_py() or "")
            if len(found) < size:
                continue
            keys.append((k1, k2))
            words.append(found)
            held += len(found)
            if held >= chunk_words:
                yield chunk()
                keys, words, held = [], [], 0
    if keys:
        yield chunk()


def _runs(*sorted_cols: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin, and the end."""
    n = len(sorted_cols[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in sorted_cols:
        new[1:] |= c[1:] != c[:-1]
    return np.r_[np.flatnonzero(new), n]


def _window_counts(batches: Iterator[pa.RecordBatch], size: int, chunk_words: int) -> Iterator[pa.RecordBatch]:
    """(h, n): each hash of a chunk once, with how often it occurs there."""
    for *_, hashes, _ in _chunks(batches, size, chunk_words):
        hashes = np.sort(hashes)
        at = _runs(hashes)
        yield pa.RecordBatch.from_arrays([pa.array(hashes[at[:-1]].view(np.int64)), pa.array(np.diff(at).astype(np.int32))], names=["h", "n"])


def _again(batches: Iterator[pa.RecordBatch], size: int, chunk_words: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows whose hash meets the bitmap, each (h, c) of a chunk once: in which documents and where."""
    for keys, doc, place, hashes, checks in _chunks(batches, size, chunk_words):
        hit = np.flatnonzero(in_bitmap(bits, hashes))
        hit = hit[np.lexsort((checks[hit], hashes[hit]))]
        h, c = hashes[hit].view(np.int64), checks[hit].view(np.int64)
        at = _runs(h, c)
        first = at[:-1]
        for lo in range(0, len(first), 1 << 14):
            hi = min(lo + (1 << 14), len(first))
            some, offsets = hit[at[lo] : at[hi]], pa.array((at[lo : hi + 1] - at[lo]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (keys[doc[some], 0], keys[doc[some], 1], place[some].astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(h[first[lo:hi]]), pa.array(c[first[lo:hi]]), *lists], names=["h", "c", "k1", "k2", "at"])


def _intervals(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (k1, k2, at) to (k1, k2, starts, ends): maximal intervals of words to remove."""
    held: list[np.ndarray] | None = None

    def found(cols: list[np.ndarray]) -> pa.RecordBatch:
        k1, k2, at = cols
        doc = _runs(k1, k2)
        cut = np.zeros(len(at), bool)
        cut[doc[:-1]] = True
        cut[1:] |= np.diff(at) > size
        begin = np.flatnonzero(cut)
        end = np.r_[begin[1:], len(at)] - 1
        offsets = pa.array(np.searchsorted(begin, doc).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (at[begin].astype(np.int64), at[end].astype(np.int64) + size)]
        return pa.RecordBatch.from_arrays([pa.array(k1[doc[:-1]]), pa.array(k2[doc[:-1]]), *lists], names=["k1", "k2", "starts", "ends"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy() for c in batch.columns]
        held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
        last = int(_runs(held[0], held[1])[-2])  # the last document may go on
        if last:
            yield found([c[:last] for c in held])
            held = [c[last:] for c in held]
    if held is not None:
        yield found(held)


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, starts, ends) to (id, n_words, n_removed, kept_text)."""
    for whole in batches:
        for first in range(0, whole.num_rows, 1024):
            batch = whole.slice(first, 1024)
            totals, removed, texts = [], [], []
            for text, starts, ends in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                kept, at = words, 0
                if starts:
                    kept = []
                    for a, b in zip(starts, ends):
                        kept += words[at:a]
                        at = b
                    kept += words[at:]
                totals.append(len(words))
                removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "n_removed", "kept_text"],
            )


def dedup_substrings(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 35, chunk_words: int = 1 << 19, bits: int = 28
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_text (kept words joined by one blank).

    Words are runs of characters that are no white space.  Each word covered by a window of ``size`` words that also starts
    elsewhere, in another document or in the same one, is removed; windows are judged on the input.  Equal windows, and rows
    that agree in id and text, are told by 128 bits of hash.  NULL text has no words; texts shorter than a window keep all
    words.  A repeated row is another document, so rows that repeat a long text lose it.  An empty table gives no rows; other
    columns are not read.
    """
    spark = rows.sparkSession
    docs = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    docs = docs.select("id", F.xxhash64(F.lit(1), "id", "t").alias("k1"), F.xxhash64(F.lit(2), "id", "t").alias("k2"), "t")
    texts = docs.select("k1", "k2", "t")
    with scratch(spark):
        counted = texts.mapInArrow(lambda b: _window_counts(b, size, chunk_words), "h long, n int")
        # chunks are added up before the shuffle; what arrives is counted where it arrives, and spills if it must
        often = staged(counted.repartition("h").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h"), "repeated-hashes")
        held = spark.sparkContext.broadcast(bitmap(often, bits))
        places = "h long, c long, k1 array<long>, k2 array<long>, at array<int>"
        met = texts.mapInArrow(lambda b: _again(b, size, chunk_words, held.value), places)
        # both hashes decide, over one row per window and chunk
        met = met.withColumn("n", F.sum(F.size("at")).over(Window.partitionBy("h", "c"))).filter("n > 1")
        met = staged(met.select("k1", "k2", "at"), "repeated-places")  # stored: its shuffle ends before the next begins
        each = met.select(F.explode(F.arrays_zip("k1", "k2", "at")).alias("x")).select("x.k1", "x.k2", "x.at")
        spans = (
            each.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "at")
            .mapInArrow(lambda b: _intervals(b, size), "k1 long, k2 long, starts array<long>, ends array<long>")
        )
        spans = staged(spans, "repeated-spans", outer=True)
    joined = docs.join(spans, ["k1", "k2"], "left").select("id", "t", "starts", "ends")
    kind = joined.schema["id"].dataType.simpleString()
    return joined.mapInArrow(_strip, f"id {kind}, n_words long, n_removed long, kept_text string").withColumnRenamed("id", id_col)
