"""SimHash near-dedup with a bit-sliced comparison.

Fingerprints are made in Arrow batches; from then on only distinct 64-bit numbers move.  Two fingerprints that differ in at
most two bits agree on at least two of four 16-bit quarters, so each goes into six buckets (which quarters, their bits).
Buckets with one member are left out.  A bucket with more than ``split`` members is split by the same rule over the eight-bit
parts of its two other quarters; such a part has at most 2^16 members whatever the input, so no task holds more than that.

Inside a bucket the fingerprints stand in vertical blocks of 64: bit plane b of a block is one word with bit b of its 64
members.  A query flips planes and adds them into carry-save counters (ones, twos, more), 64 distances at a time; a block is
abandoned once all its members are over the radius.  A task emits a spanning forest of what it linked, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import packed, row_key, scratch, staged, word_pieces
from millrace.llm.components import components

RADIUS = 2
_QUARTERS = [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have bit 0, 1, .. 63 set."""
    full = len(hashes) // 255 * 255
    counts = np.zeros(64, np.int64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    if full:
        counts += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return counts + bits[full:].sum(axis=0, dtype=np.int64)


def _shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    n = len(words) - size + 1
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    cut = map(slice, starts[:n].tolist(), (ends[size - 1 :] - 1).tolist())
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cut), repeat(42)), np.uint64, n)


def fingerprint(text: str | None, size: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a text; zero if it has no words.  Long texts are read piece by piece."""
    counts, total, tail = np.zeros(64, np.int64), 0, []
    for piece in word_pieces((text or "").encode("utf-8", "surrogatepass").lower()):  # bytes: A-Z only
        words = tail + piece.split()
        if len(words) >= size:
            hashes = _shingle_hashes(words, size)
            counts += _bit_counts(hashes)
            total += len(hashes)
        tail = words[-(size - 1) :] if size > 1 else []
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(tail), 42) if tail else 0
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(t.as_py(), size) for t in batch.column(2)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(prints.view(np.int64))], names=["id", "k", "fp"])


class _Forest:
    """Components over 0 .. n-1, with the edges that joined them."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            new = x != y
            if not new.any():
                return
            a, b, x, y = a[new], b[new], x[new], y[new]
            high = np.maximum(x, y)
            _, first = np.unique(high, return_index=True)  # each root is hung below one smaller root at most
            self.edges.append((a[first], b[first]))
            parent = np.arange(len(self.label))
            parent[high[first]] = np.minimum(x, y)[first]
            while not np.array_equal(up := parent[parent], parent):
                parent = up
            self.label = parent[self.label]


def _planes(block: np.ndarray) -> np.ndarray:
    """(64, blocks) bit planes of fingerprint words (blocks, 64)."""
    bits = np.unpackbits(block.view(np.uint8).reshape(len(block), 64, 8), axis=2, bitorder="little")  # block, member, bit
    return np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view(np.uint64)[:, :, 0]


def _beyond(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose vertical counter is above ``radius``, or ran over."""
    above, equal = over.copy(), np.full(len(over), _ALL)
    for i in reversed(range(len(counter))):
        if radius >> i & 1:
            equal &= counter[i]
        else:
            above |= equal & counter[i]
            equal &= ~counter[i]
    return above


def _compare(prints: np.ndarray, bucket: np.ndarray, radius: int = RADIUS, forest: _Forest | None = None) -> _Forest:
    """Link all fingerprints of the same bucket at ``radius`` or fewer differing bits; buckets are runs of equal numbers.

    ``prints`` has one 64-bit word per fingerprint or several (a row each).  Links are added to ``forest``.
    """
    words = prints.reshape(len(prints), -1)
    n = len(words)
    forest = forest or _Forest(n)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[first, n])
    blocks_of = -(-sizes // 64)
    block0 = np.cumsum(blocks_of) - blocks_of
    run = np.repeat(np.arange(len(first)), sizes)
    place = np.arange(n) - first[run]
    at_block = block0[run] + place // 64
    members = np.full((int(blocks_of.sum()), 64), -1, np.int64)
    members[at_block, place % 64] = np.arange(n)
    filled = np.packbits(members >= 0, axis=1, bitorder="little").view(np.uint64)[:, 0]
    planes = [_planes(np.where(members >= 0, w[np.maximum(members, 0)], np.uint64(0))) for w in words.T]
    # query x block: each member meets its own block and those before it
    each = at_block - block0[run] + 1
    begin, done, chunk = np.cumsum(each) - each, 0, 1 << 10
    while done < n:
        stop = max(done + 1, int(np.searchsorted(begin, begin[done] + chunk)))
        many = each[done:stop]
        query = np.repeat(np.arange(done, stop), many)
        block = block0[run[query]] + np.arange(len(query)) - np.repeat(np.cumsum(many) - many, many)
        done, chunk = stop, min(2 * chunk, 1 << 15)
        low, high = block.min(), block.max() + 1
        label = np.where(members[low:high] >= 0, forest.label[members[low:high]], -1)
        apart = (label != label[:, :1]) & (label >= 0)  # blocks that are one component already, the query's, have no news
        news = apart.any(axis=1)[block - low] | (label[block - low, 0] != forest.label[query])
        query, block = query[news], block[news]
        counter = [np.zeros(len(query), np.uint64) for _ in range((radius + 1).bit_length())]
        over = ~filled[block]
        for b in range(64 * len(planes)):
            if not len(query):
                break
            flip = (-((words[query, b // 64] >> np.uint64(b % 64)) & np.uint64(1)).view(np.int64)).view(np.uint64)
            carry = planes[b // 64][b % 64, block] ^ flip
            for c in counter:
                carry, c[:] = c & carry, c ^ carry
            over |= carry
            if b % 8 == 7 and not (live := _beyond(counter, over, radius) != _ALL).all():
                query, block, over, *counter = (x[live] for x in (query, block, over, *counter))
        if not len(query):
            continue
        near = ~_beyond(counter, over, radius)
        hit = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        pair, lane = np.nonzero(hit)
        forest.add(query[pair], members[block[pair], lane])
    return forest


def _whole_buckets(batches: Iterator[pa.RecordBatch], keys: int, full: int = 1 << 16) -> Iterator[list[np.ndarray]]:
    """Columns of about ``full`` rows or more, sorted by their first ``keys`` columns, that cut no bucket in two."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if len(held[0]) >= full:
            same = np.ones(len(held[0]), bool)
            for c in held[:keys]:
                same &= c == c[-1]
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield [c[:cut] for c in held]
                held = [c[cut:] for c in held]
    if held is not None and len(held[0]):
        yield held


def _bucket_numbers(keys: list[np.ndarray]) -> np.ndarray:
    change = np.zeros(len(keys[0]), bool)
    for c in keys:
        change[1:] |= c[1:] != c[:-1]
    return np.cumsum(change)


def _edge_rows(forest: _Forest, ids: np.ndarray) -> pa.RecordBatch:
    a, b = (np.concatenate([e[i] for e in forest.edges]) if forest.edges else np.zeros(0, np.int64) for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (t, key, s, sub, fp) to edges (a, b)."""
    for cols in _whole_buckets(batches, 4):
        yield _edge_rows(_compare(cols[4].view(np.uint64), _bucket_numbers(cols[:4])), cols[4])


def _part(fp: Column, i: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, i * bits).bitwiseAND(F.lit((1 << bits) - 1))


def _buckets(split: int, prints: DataFrame) -> DataFrame:
    """(t, key, s, sub, fp): every bucket with two or more members, large ones split."""
    fp = F.col("fp")
    key = [F.shiftleft(_part(fp, i, 16), 16).bitwiseOR(_part(fp, j, 16)) for i, j in _QUARTERS]
    one = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), k.alias("key")) for t, k in enumerate(key)]))
    wide = prints.select("fp", one.alias("x")).select("fp", "x.*")
    sizes = staged(wide.groupBy("t", "key").count().filter("count > 1"), "bucket-sizes")
    met = wide.join(sizes, ["t", "key"])
    small = met.filter(F.col("count") <= split).select("t", "key", F.lit(-1).alias("s"), F.lit(0).cast("long").alias("sub"), "fp")
    rest = [[x for x in range(4) if x not in q] for q in _QUARTERS]
    eighths = F.array(*[
        F.array(*[_part(fp, 2 * quarter + half, 8) for quarter in others for half in (0, 1)]) for others in rest
    ])
    four = F.get(eighths, F.col("t"))
    subs = F.array(*[
        F.struct(F.lit(s).alias("s"), F.shiftleft(four[i], 8).bitwiseOR(four[j]).alias("sub")) for s, (i, j) in enumerate(_QUARTERS)
    ])
    large = met.filter(F.col("count") > split).select("t", "key", F.explode(subs).alias("x"), "fp").select("t", "key", "x.s", "x.sub", "fp")
    return small.unionByName(large)


def _rooted(rows: DataFrame, id_col: str, text_col: str, size: int, split: int) -> DataFrame:
    """(id, k, fp, root) of every row: k is a hash of the text, root the least fingerprint of its component."""
    docs = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    docs = docs.select("id", F.xxhash64("t").alias("k"), "t")
    kind = docs.schema["id"].dataType.simpleString()
    prints = staged(docs.mapInArrow(lambda b: _fingerprints(b, size), f"id {kind}, k long, fp long"), "fingerprints")
    distinct = staged(prints.select("fp").distinct(), "distinct-fingerprints")
    order = ["t", "key", "s", "sub"]
    edges = _buckets(split, distinct).repartition(*order).sortWithinPartitions(*order, "fp").mapInArrow(_linked, "a long, b long")
    roots = staged(components(staged(edges, "near-links")), "near-roots")
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left")
    return staged(rooted.select("id", "k", "fp", F.coalesce("root", "fp").alias("root")), "near-rooted")


def near_groups(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, split: int = 4096) -> DataFrame:
    """One row per input row: id, fingerprint (16 hexadecimal digits), component_id.

    Fingerprints link at two or fewer differing bits; ``component_id`` is the least id that can be reached (NULL ids do not
    count; NULL if there is no other).  NULL text has no words, and texts without words have fingerprint zero, linked like
    any other.  Repeated rows come back as often as they were; an empty table gives no rows; other columns are not read.
    """
    rooted = _rooted(rows, id_col, text_col, size, split)
    least = staged(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "near-least")
    return rooted.join(least, "root").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_copies(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, split: int = 4096) -> DataFrame:
    """``rows`` with all its columns, one row of each component: the one with the least id.

    NULL ids come last.  If several rows of a component have that id, the text with the least hash decides; of rows that agree
    in id and text one stays.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("x")
    with scratch(rows.sparkSession):
        kept = _rooted(rows, id_col, text_col, size, split).groupBy("root").agg(first).select(row_key(F.col("x.id"), F.col("x.k")).alias("_key"))
        kept = staged(kept, "kept-rows", outer=True)
    own = row_key(F.col(id_col), F.xxhash64(F.col(text_col).cast("string"))).alias("_key")
    return rows.select(own, packed(rows)).join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
