"""Ranked lexical search with the Best Position Algorithm.

A first pass keeps of each document its length and the occurrences of the queries' terms; the corpus numbers and the weights
come from it.  A second pass reads this index where it lies, unshuffled: a task takes a block of documents at a time and makes
an impact list per term, best first.  A query reads its lists in parallel.  Each new document is scored at once by direct access
to all its lists, which also marks its place in each.  A list's best position is the end of its unbroken run of seen places;
the impacts that follow these runs bound every document not yet seen, more tightly than those at the places read last.  The
query stops when the bound is strictly below its k-th score, counting what the task found in earlier blocks.  A window merges
k rows per query and task.

Queries come in blocks of a bounded number of items and terms; each block is a pass of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged, word_pieces

#: Terms are runs of bytes that are ASCII digits and letters or no ASCII; A-Z become lower case.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_LISTS = pa.list_(pa.int32()), pa.list_(pa.int64())


def term_counts(text: str | None) -> Counter[bytes]:
    """How often each term occurs; long texts are read piece by piece."""
    found: Counter[bytes] = Counter()
    for piece in word_pieces((text or "").encode("utf-8", "surrogatepass").translate(_FOLD)):
        found.update(piece.split())
    return found


def _occurrences(batches: Iterator[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, n, terms, tfs); documents without terms are left out."""
    for batch in batches:
        ids, lengths, terms, tfs = [], [], [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = term_counts(text.as_py())
            if counts:
                ids.append(i)
                lengths.append(counts.total())
                hit = counts.keys() & number.keys()
                terms.append([number[t] for t in hit])
                tfs.append([counts[t] for t in hit])
        out = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, _LISTS[0]), pa.array(tfs, _LISTS[1])]
        yield pa.RecordBatch.from_arrays(out, names=["id", "n", "terms", "tfs"])


class ImpactLists:
    """The impact lists of a block of documents, for sorted and direct access."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.begin = np.r_[0, np.cumsum(sizes)]  # of each document's postings
        self.terms, self.impacts = terms, impacts
        order = np.lexsort((-impacts, terms))
        self.docs = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.best_first = impacts[order]
        self.place = np.empty(len(order), np.int64)  # of each posting in its list
        self.place[order] = np.arange(len(order))
        self.first = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores): all that can be among the best ``k``, where only scores of ``least`` or more matter."""
        at, end = self.first[terms], self.first[terms + 1]
        used = (end > at) & (weights > 0)
        at, end, weights_of = at[used].copy(), end[used], weights[used]
        weight = np.zeros(len(self.first) - 1, np.int64)
        weight[terms[used]] = weights_of
        seen = np.zeros(len(self.docs), bool)
        scored = np.zeros(len(self.begin) - 1, bool)
        docs, scores, top, step = [], [], np.zeros(0, np.int64), 16
        while (open_ := at < end).any():
            bound = int((weights_of[open_] * self.best_first[at[open_]]).sum())
            if bound < least:
                break
            read = np.concatenate([np.arange(a, min(a + step, e)) for a, e in zip(at[open_].tolist(), end[open_].tolist())])
            step = min(2 * step, 4096)
            new = np.unique(self.docs[read])
            new = new[~scored[new]]
            scored[new] = True
            score = self._direct(new, weight, seen)
            docs.append(new)
            scores.append(score)
            top = np.concatenate([top, score])
            if len(top) > k:
                top = np.partition(top, len(top) - k)[-k:]
            if len(top) == k:
                least = max(least, int(top.min()))
            for i in np.flatnonzero(open_).tolist():  # on to the first place not seen
                run = seen[at[i] : end[i]]
                gap = int(run.argmin())
                at[i] = end[i] if run[gap] else at[i] + gap
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found, score = np.concatenate(docs), np.concatenate(scores)
        good = score >= least
        return found[good], score[good]

    def _direct(self, docs: np.ndarray, weight: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """The scores of ``docs``; their places in the lists become seen."""
        if not len(docs):
            return np.zeros(0, np.int64)
        many = self.begin[docs + 1] - self.begin[docs]
        offsets = np.cumsum(many) - many
        rows = np.repeat(self.begin[docs] - offsets, many) + np.arange(int(many.sum()))
        w = weight[self.terms[rows]]
        seen[self.place[rows[w > 0]]] = True
        return np.add.reduceat(w * self.impacts[rows], offsets)


def _impacts(tf: np.ndarray, n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    most = 50 * int(n.max(initial=0)) * total_docs
    m = 50 + (50 * n * total_docs // total_terms if most < 2**63 else np.array([50 * x * total_docs // total_terms for x in n.tolist()], np.int64))
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def _best(
    batches: Iterator[pa.RecordBatch], items: list[tuple[np.ndarray, np.ndarray]], n_terms: int, totals: tuple[int, int], k: int, postings: int
) -> Iterator[pa.RecordBatch]:
    """Sorted by nothing: (id, n, terms, tfs) to each item's best ``k`` of the task."""
    kept = [[] for _ in items]  # (-score, id is NULL, id), sorted
    held: list[pa.RecordBatch] = []

    def block() -> None:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, n, terms, tfs = (table.column(i).combine_chunks() for i in range(4))
        sizes = np.diff(terms.offsets.to_numpy())
        flat_terms, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
        lists = ImpactLists(sizes, flat_terms, _impacts(tf, np.repeat(n.to_numpy(), sizes), *totals), n_terms)
        keys = ids.to_pylist()
        for at, (item_terms, weights) in enumerate(items):
            full = len(kept[at]) == k
            docs, scores = lists.search(item_terms, weights, k, -kept[at][-1][0] if full else 1)
            new = [(-s, keys[d] is None, keys[d] or 0) for d, s in zip(docs.tolist(), scores.tolist())]
            kept[at] = sorted(kept[at] + new)[:k]

    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column(2).flatten()) + batch.num_rows
        if size >= postings:
            block()
            held, size = [], 0
    if held:
        block()
    rows = [(at, None if none else i, -s) for at, best in enumerate(kept) for s, none, i in best]
    cols = list(zip(*rows)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "id", "score"])


def _blocks(items: DataFrame, id_col: str, text_col: str, most_items: int, most_terms: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    """(ids, distinct terms of each) of some items at a time."""
    ids, terms, known = [], [], set()
    for i, text in items.select(id_col, F.col(text_col).cast("string")).toLocalIterator():
        own = sorted(term_counts(text))
        if ids and (len(ids) >= most_items or len(known) + len(own) > most_terms):
            yield ids, terms
            ids, terms, known = [], [], set()
        ids.append(i)
        terms.append(own)
        known.update(own)
    if ids:
        yield ids, terms


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", most_items: int = 2048, most_terms: int = 1 << 17, postings: int = 1 << 21,
) -> DataFrame:
    """(<item>, rank, <id>, score): each item's ``k`` best documents with a score above 0, all if fewer; ties to the smaller id.

    NULL and empty texts have no terms: such documents count nowhere, such items get no rows.  Repeated rows are documents, or
    items, of their own; NULL ids come last among ties.  An empty table on either side gives no rows; other columns are not
    read.  Scores are 64-bit integers.  Ids of documents are whole numbers.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    kind = items.schema[item_col].dataType.simpleString()
    found = []
    for ids, terms in _blocks(items, item_col, item_text_col, most_items, most_terms):
        number = {t: i for i, t in enumerate(sorted(set().union(*terms)))}
        index = slim.mapInArrow(lambda b, number=number: _occurrences(b, number), "id long, n long, terms array<int>, tfs array<long>")
        index = staged(index, "term-occurrences")
        total_docs, total_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(number), np.int64)
        for t, c in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term of the block
            df[t] = c
        weight = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        asked = [(a := np.array([number[t] for t in own], np.int64), weight[a]) for own in terms]
        totals = (total_docs, max(1, total_terms))
        best = index.mapInArrow(
            lambda b, asked=asked, m=len(number), totals=totals: _best(b, asked, m, totals, k, postings), "item int, id long, score long"
        )
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(n, i) for n, i in enumerate(ids)], f"item int, name {kind}")  # at most ``most_items`` rows
        found.append(ranked.join(F.broadcast(names), "item").select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    if not found:
        return spark.createDataFrame([], f"`{item_col}` {kind}, rank int, `{id_col}` long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
