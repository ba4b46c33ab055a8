"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Candidates are dealt to groups by a hash of the row; every group sees every query.  A task holds one group at a time: per term
(component) a posting list of the rows with a nonzero weight.  Queries stream past in tiles: each nonzero query weight scatters
weight x postings into the tile's dense score array.  A partition selection keeps each query's k best of the group, and a
window with a limit per query merges the groups.  Memory is bounded by the group and the tile, the rows moved by k per query
and group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import slots, staged


class _Block:
    """Posting lists of one group of candidates, in the order of their ids; ``numbers`` tell rows of one id apart."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, rows: list[np.ndarray]):
        order = np.argsort(ids, kind="stable")
        self.ids, self.numbers = ids[order], numbers[order]
        width = max(map(len, rows))
        dense = np.zeros((width, len(ids)), np.int64)
        for at, i in enumerate(order):
            dense[: len(rows[i]), at] = rows[i]
        self.most = np.abs(dense).max(axis=1).astype(float)
        small = self.most.max(initial=0) < 2**31
        self.postings = []
        for values in dense:
            places = np.flatnonzero(values)
            full = 2 * len(places) > len(values)  # long lists are stored with their zeros, without places
            kept = values if full else values[places]
            self.postings.append((None if full else places, kept.astype(np.int32) if small else kept))

    def scores(self, queries: np.ndarray) -> np.ndarray:
        """(queries, candidates); 32 bits wide if no sum can leave them."""
        width = min(queries.shape[1], len(self.postings))
        bound = (np.abs(queries[:, :width]).max(axis=0, initial=0).astype(float) * self.most[:width]).sum()
        kind = np.int32 if bound < 2**31 else np.int64
        out = np.zeros((len(queries), len(self.ids)), kind)
        for term in range(width):
            weights = queries[:, term].astype(kind)
            with_term = np.flatnonzero(weights)
            places, values = self.postings[term]
            if not len(with_term) or not len(values):
                continue
            values = values.astype(kind, copy=False)
            if places is not None:
                out[with_term[:, None], places[None, :]] += weights[with_term, None] * values
            elif 2 * len(with_term) > len(weights):
                out += weights[:, None] * values
            else:
                out[with_term] += weights[with_term, None] * values
        return out


def _search(batches: Iterator[pa.RecordBatch], k: int, cells: int) -> Iterator[pa.RecordBatch]:
    """Sorted (grp, query, id, number, v): of each group the candidates, then the queries."""
    group, block, ids, numbers, rows, tile = None, None, [], [], [], []

    def answers() -> Iterator[pa.RecordBatch]:
        if not tile or block is None:
            return
        width = max(len(v) for _, _, v in tile)
        queries = np.zeros((len(tile), width), np.int64)
        for i, (_, _, v) in enumerate(tile):
            queries[i, : len(v)] = v
        got: list[tuple[np.ndarray, ...]] = []
        for (q, number, _), score in zip(tile, block.scores(queries)):
            others = np.flatnonzero(block.numbers != number)
            score = score[others].astype(np.int64)
            if len(score) > k:
                least = np.partition(score, len(score) - k)[len(score) - k]
                better = np.flatnonzero(score > least)
                best = np.r_[better, np.flatnonzero(score == least)[: k - len(better)]]  # ids ascend: ties to the smaller
            else:
                best = np.arange(len(score))
            got.append((np.full(len(best), number), np.full(len(best), q), block.ids[others[best]], score[best]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*got)], names=["number", "query_id", "vec_id", "score"])

    for batch in batches:
        values = batch.column(4)
        flat, offsets = values.flatten().to_numpy(zero_copy_only=False), values.offsets.to_numpy()
        offsets = offsets - offsets[0]
        for i, (g, is_query, vec, number) in enumerate(zip(*(batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in range(4)))):
            v = flat[offsets[i] : offsets[i + 1]].astype(np.int64)
            if g != group:
                yield from answers()
                group, block, ids, numbers, rows, tile = g, None, [], [], [], []
            if not is_query:
                ids.append(vec)
                numbers.append(number)
                rows.append(v)
                continue
            if block is None and ids:
                block, rows = _Block(np.array(ids), np.array(numbers), rows), []
            if block is not None:
                tile.append((vec, number, v))
                if len(tile) * len(ids) >= cells:
                    yield from answers()
                    tile = []
    yield from answers()


def top_k(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20, scale: int = 64,
    group_rows: int = 1 << 16, tile_cells: int = 1 << 21,
) -> DataFrame:
    """(query_id, rank, <id>, score): the ``k`` best of every query, all if there are fewer; ties to the smaller id.

    Components become floor(scale * x).  Queries are the rows whose id is divisible by ``every``; candidates are all rows but
    the query's own.  Vectors that are NULL, or hold NULL or non-finite components, and rows with a NULL id take no part.  Every
    row counts: repeated ones are candidates as often as they occur, and each of them as a query has a list of its own.
    Shorter vectors count as zero beyond their end; an empty vector scores 0.  Scores are exact within 64 bits.
    """
    spark = rows.sparkSession
    x = F.col(vector_col).cast("array<double>")
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    vecs = (
        rows.select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
        .filter(F.col("id").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", bad))
        .select("id", F.monotonically_increasing_id().alias("number"), F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v"))
    )
    vecs = staged(vecs, "vectors")  # with their numbers: from here on these are the same in every attempt
    groups = max(slots(spark), -(-vecs.count() // group_rows))
    candidates = vecs.select(F.pmod(F.xxhash64("number"), F.lit(groups)).cast("int").alias("grp"), F.lit(False).alias("query"), "id", "number", "v")
    queries = vecs.filter(F.col("id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), F.lit(True).alias("query"), "id", "number", "v"
    )
    found = (
        candidates.unionByName(queries)
        .repartitionById(groups, F.col("grp"))
        .sortWithinPartitions("grp", "query", "id")
        .mapInArrow(lambda b: _search(b, k, tile_cells), "number long, query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
