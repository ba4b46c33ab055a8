"""Near copies by similarity: SimHash comparison in candidate blocks, then an exact search for what it left.

Two bits of 64 find texts that are all but equal.  For a Jaccard similarity of 0.8 over five-word shingles this module works
in two steps.  The first only makes groups small: wider fingerprints (256 bits) are compared at wider radii, bit-sliced as in
``simhash``, in bands of min-wise shingle hashes; a task's spanning forest joins texts by their closest pairs, and edges whose
exact similarity, from the whole texts, is below the limit go.  The second finds every pair of the limit or more that the
first has not put into one component, so the first may miss any.

It rests on prefixes: with all shingles in one order, two sets of n shingles or more at similarity s share one of their first
n - ceil(s n) + 1.  Shingles that are frequent in a sample of the texts come last in that order, so prefixes are rare
shingles; any order is exact, the sample only saves work.  Texts that share such a shingle and are in different components
are candidates if three bounds allow the limit: of their lengths, of the shared shingle's places, and of parity bits of the
sets, which differ in no more bits than the sets do in shingles.  There are about as many parity bits as shingles (256 to
16,384); two sets are compared by the fewer, the longer row folded.  The candidates are checked on the whole texts.

Shingles that only one text has among its first are left out early: their counts become a bitmap of fixed size, and only what
meets it is kept.  Texts with the same shingles are one class throughout.  A bucket larger than ``tile`` is cut into tiles,
and each pair of tiles is compared on its own; inside, only pairs of different components are looked at.

Whole texts are never shuffled for this: the tasks that read them keep those a bitmap of row hashes asks for and pass on their
shingle sets.  What is staged on the way is removed when its result is stored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bitmap, in_bitmap, packed, row_key, scratch, staged, word_pieces
from millrace.llm.components import components
from millrace.llm.simhash import _bit_counts, _bucket_numbers, _compare, _edge_rows, _shingle_hashes, _whole_buckets

BANDS, BAND_ROWS = 12, 4
WORDS = 4  # 64-bit words of a wide fingerprint
PARITY = (256, 1024, 4096, 16384)  # bits
#: Of 256 bits, two long texts at Jaccard similarity 0.8 differ in 39 +- 6, short ones in more.  Pairs beyond are left to the second step.
RADII = (16, 28, 40, 56)
#: Shingle frequencies come from about so many texts; at most so many shingles count as frequent.
SAMPLE, MOST_FREQUENT = 20_000, 1 << 20
_RANDOM = np.random.default_rng(20_240_601)
_TURNS = _RANDOM.integers(0, 2**63, BANDS * BAND_ROWS, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _RANDOM.integers(0, 2**63, WORDS, np.int64).astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; A-Z in lower case; the whole sequence if there are fewer words."""
    found, tail = [], []
    for piece in word_pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        words = tail + piece.split()
        if len(words) >= size:
            found.append(np.unique(_shingle_hashes(words, size)))
        tail = words[-(size - 1) :] if size > 1 else []
    if not found:
        return _shingle_hashes(tail, len(tail)) if tail else np.zeros(0, np.uint64)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def _sketch(h: np.ndarray, draw: int) -> tuple[int, int, list[int], list[int]]:
    """(class, check of the class, wide fingerprint, band keys) of a set of shingles."""
    node, check = np.frombuffer(hashlib.blake2b(h.tobytes(), digest_size=16, salt=bytes([draw])).digest(), "<i8").tolist()
    if not len(h):
        return node, check, [0] * WORDS, []
    least = np.full(len(_TURNS), 2**64 - 1, np.uint64)
    counts = np.zeros((WORDS, 64), np.int64)
    for at in range(0, len(h), 1 << 14):
        part = h[at : at + (1 << 14)]
        least = np.minimum(least, np.array([(part * t).min() for t in _TURNS]))
        for w in range(WORDS):
            counts[w] += _bit_counts(_mix(part ^ _SALTS[w]))
    prints = np.packbits(2 * counts > len(h), axis=1, bitorder="little").view(np.int64)[:, 0]
    keys = np.zeros(BANDS, np.uint64)
    for r in range(BAND_ROWS):
        keys = _mix(keys + least[r::BAND_ROWS])
    return node, check, prints.tolist(), keys.view(np.int64).tolist()


def _prefix(h: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], similarity: float) -> list[int]:
    """The first shingles, rare ones first, of which a set at ``similarity`` must share one."""
    rank = np.zeros(len(h), np.int64)
    if len(frequent[0]):
        at = np.minimum(np.searchsorted(frequent[0], h), len(frequent[0]) - 1)
        rank = np.where(frequent[0][at] == h, frequent[1][at], 0)
    many = len(h) - math.ceil(similarity * len(h) - 1e-9) + 1
    return h[np.lexsort((_mix(h), rank))[:many]].view(np.int64).tolist()


def _parity(h: np.ndarray) -> bytes:
    """For each cell whether an odd number of the shingles falls into it; as many cells as shingles, about."""
    bits = next((b for b in PARITY if b >= len(h)), PARITY[-1])
    cells = np.bincount((_mix(h) >> np.uint64(65 - bits.bit_length())).astype(np.int64), minlength=bits) & 1
    return np.packbits(cells.astype(np.uint8), bitorder="little").tobytes()


def _folded(parity: np.ndarray, bits: int) -> np.ndarray:
    """Rows of parity bytes brought down to ``bits`` cells: four neighbours become one."""
    while parity.shape[1] * 8 > bits:
        cells = np.unpackbits(parity, axis=1, bitorder="little").reshape(len(parity), -1, 4)
        parity = np.packbits(cells.sum(axis=2, dtype=np.uint8) & 1, axis=1, bitorder="little")
    return parity


def _sketches(batches: Iterator[pa.RecordBatch], size: int, frequent: tuple[np.ndarray, np.ndarray], similarity: float, draw: int) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    types = (pa.int64(), pa.int64(), longs, longs, longs, pa.binary(), pa.int64())
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            held = [shingles(t.as_py(), size) for t in batch.column(2)]
            found = [(*_sketch(h, draw), _prefix(h, frequent, similarity), _parity(h), len(h)) for h in held]
            names = ["id", "k", "node", "check", "fp", "keys", "prefix", "parity", "n"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array([f[i] for f in found], t) for i, t in enumerate(types)]], names=names)


def _shared_prefixes(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sketches with ``prefix`` replaced by the places and keys that meet the bitmap; no parity where none does."""
    for batch in batches:
        prefix, parity = batch.column(6), batch.column(7)
        flat, ends = prefix.flatten().to_numpy(), prefix.offsets.to_numpy()
        ends = ends - ends[0]
        hit = in_bitmap(bits, flat)
        counts = np.r_[0, np.cumsum(hit)][ends]
        place = (np.arange(len(flat)) - np.repeat(ends[:-1], np.diff(ends)))[hit]
        offsets = pa.array(counts.astype(np.int32))
        none = pa.array(np.diff(counts) == 0)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (place, flat[hit])]
        slim = pc.if_else(none, pa.scalar(b"", pa.binary()), parity)
        yield pa.RecordBatch.from_arrays([*batch.columns[:6], *lists, slim, batch.column(8)], names=[*batch.schema.names[:6], "places", "shared", "parity", "n"])


def _each_shingle(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for t in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(shingles(t.as_py(), size).view(np.int64))], names=["s"])


def _frequent(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that are in three sampled texts or more, and in how many."""
    share = max(1, docs.count() // SAMPLE)
    every = docs.filter(F.pmod("k", F.lit(share)) == 0).select("t").mapInArrow(lambda b: _each_shingle(b, size), "s long")
    counts = staged(every.groupBy("s").agg(F.count("*").alias("c")).filter("c > 2"), "frequent-shingles")
    least, total = 3, 0
    for c, n in sorted(((r["c"], r["n"]) for r in counts.groupBy("c").agg(F.count("*").alias("n")).collect()), reverse=True):
        total += n
        if total > MOST_FREQUENT:
            least = c + 1
            break
    top = counts.filter(F.col("c") >= least).toArrow()
    s, c = top["s"].to_numpy().view(np.uint64), top["c"].to_numpy()
    order = np.argsort(s)
    return s[order], c[order]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (band, key, sub, node, f0, ..) to edges (a, b)."""
    for cols in _whole_buckets(batches, 3):
        prints = np.ascontiguousarray(np.array(cols[4:]).T).view(np.uint64)
        bucket, forest = _bucket_numbers(cols[:3]), None
        for radius in RADII:
            forest = _compare(prints, bucket, radius, forest)
        yield _edge_rows(forest, cols[3])


def _sets(batches: Iterator[pa.RecordBatch], size: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(hash, key, text) to (key, shingles) of the rows whose hash meets the bitmap."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            batch = batch.filter(pa.array(in_bitmap(bits, batch.column(0).to_numpy())))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([shingles(t.as_py(), size).tobytes() for t in batch.column(2)], pa.binary())], names=["_key", "held"])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _verified(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [
            jaccard(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) >= similarity
            for x, y in zip(batch.column(2), batch.column(3))
        ]
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def _crossing(batches: Iterator[pa.RecordBatch], similarity: float, chunk: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Sorted (key, sub, root, own, mixed, node, n, pos, parity) to candidates (a, b) of different roots.

    Pairs are made and tested a ``chunk`` at a time, so memory follows the rows of some buckets and not their pairs."""
    share = (1 - similarity) / (1 + similarity)  # of both lengths, how many shingles two sets at the limit differ in at most
    for cols in _whole_buckets(batches, 2, 1 << 14):
        own, mixed, node, n, pos, parity = cols[3:]
        level = np.array([len(x) * 8 for x in parity])
        rows = {b: (np.flatnonzero(level == b), np.array([np.frombuffer(x, np.uint8) for x in parity[level == b]])) for b in PARITY if (level == b).any()}
        cells = {}  # of each number of bits: places among the rows with at least so many, and these rows
        for bits in rows:
            kept = [(i, _folded(p, bits)) for w, (i, p) in rows.items() if w >= bits]
            at = np.zeros(len(level), np.int32)
            at[np.concatenate([i for i, _ in kept])] = np.arange(sum(len(i) for i, _ in kept))
            cells[bits] = at, np.concatenate([p for _, p in kept]).view(np.uint64)
        bucket, run = _bucket_numbers(cols[:2]), _bucket_numbers(cols[:3])
        after = np.searchsorted(run, run, side="right")  # pairs within a root are passed over
        many = np.searchsorted(bucket, bucket, side="right") - after
        begin, done = np.cumsum(many) - many, 0
        while done < len(many):
            stop = max(done + 1, int(np.searchsorted(begin, begin[done] + chunk)))
            part = many[done:stop]
            a = np.repeat(np.arange(done, stop), part)
            b = after[a] + np.arange(len(a)) - np.repeat(np.cumsum(part) - part, part)
            done = stop
            bound = share * (n[a] + n[b]) + 1e-6
            may = ((mixed[a] == 0) | (own[a] != own[b])) & (np.abs(n[a] - n[b]) <= bound) & (pos[a] + pos[b] <= bound)
            a, b, bound = a[may], b[may], bound[may]
            least = np.minimum(level[a], level[b])
            for bits, (at, held) in cells.items():
                here = np.flatnonzero(least == bits)
                some = (1 << 22) // bits  # pairs whose cells take half a megabyte a side
                for first in range(0, len(here), some):
                    h = here[first : first + some]
                    u, v = a[h], b[h]
                    may = np.bitwise_count(held[at[u]] ^ held[at[v]]).sum(axis=1, dtype=np.int64) <= bound[h]
                    if may.any():
                        s, t = node[u[may]], node[v[may]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(s, t)), pa.array(np.maximum(s, t))], names=["a", "b"])


def _tiled(met: DataFrame, tile: int) -> DataFrame:
    """Rows with ``node`` and their bucket's ``count``, dealt to pairs of tiles ``sub``; ``mixed`` if it is two tiles."""
    tiles = F.ceil(F.col("count") / tile).cast("int")
    own, other = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    met = met.withColumn("tiles", tiles).withColumn("own", own).withColumn("other", other)
    met = met.withColumn("mixed", (F.col("own") != F.col("other")).cast("int"))
    return met.withColumn("sub", F.least("own", "other") * F.col("tiles") + F.greatest("own", "other")).drop("count", "tiles", "other")


def _links(edges: DataFrame, reps: DataFrame, docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """Those of ``edges`` whose texts have the similarity."""
    with scratch(docs.sparkSession):
        needed = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        asked = reps.join(needed, "node", "left_semi").select("node", row_key(F.col("rep.id"), F.col("rep.k")).alias("_key"))
        asked = staged(asked.withColumn("h", F.xxhash64("_key")), "similar-representatives")
        bits = docs.sparkSession.sparkContext.broadcast(bitmap(asked.select("h")))
        key = row_key(F.col("id"), F.col("k")).alias("_key")
        sets = docs.select(F.xxhash64(key).alias("h"), key, "t").mapInArrow(lambda b: _sets(b, size, bits.value), "_key string, held binary")
        sets = staged(sets.join(asked.select("node", "_key"), "_key").select("node", "held").dropDuplicates(["node"]), "shingle-sets")
        pairs = edges.join(sets.select(F.col("node").alias("a"), F.col("held").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("held").alias("y")), "b")
        return staged(pairs.select("a", "b", "x", "y").mapInArrow(lambda b: _verified(b, similarity), "a long, b long"), "similar-links", outer=True)


def _close(classes: DataFrame, tile: int) -> DataFrame:
    """Edges (a, b) of a spanning forest of each band's blocks, by closest fingerprints."""
    with scratch(classes.sparkSession):
        wide = classes.select("node", F.posexplode("keys").alias("band", "key"))
        sizes = staged(wide.groupBy("band", "key").count().filter("count > 1"), "band-sizes")
        prints = classes.select("node", *[F.col("fp")[w].alias(f"f{w}") for w in range(WORDS)])
        met = _tiled(wide.join(sizes, ["band", "key"]), tile).join(prints, "node")
        order = ["band", "key", "sub"]
        edges = (
            met.select(*order, "node", *[f"f{w}" for w in range(WORDS)]).repartition(*order).sortWithinPartitions(*order, "node")
            .mapInArrow(_linked, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        )
        return staged(edges.distinct(), "similar-candidates", outer=True)


def _left(classes: DataFrame, roots: DataFrame, similarity: float, tile: int) -> DataFrame:
    """All pairs (a, b) of different roots that may have the similarity."""
    with scratch(classes.sparkSession):
        placed = classes.filter(F.size("shared") > 0).join(roots, "node", "left")
        placed = staged(placed.select("node", F.coalesce("root", "node").alias("root"), "n", "places", "shared", "parity"), "similar-placed")
        wide = placed.select("node", "root", F.explode(F.arrays_zip("places", "shared")).alias("x")).select("node", "root", F.col("x.places").alias("pos"), F.col("x.shared").alias("key"))
        sizes = wide.groupBy("key").agg(F.count("*").alias("count"), F.min("root").alias("low"), F.max("root").alias("high"))
        sizes = staged(sizes.filter("low < high").select("key", "count"), "prefix-sizes")
        met = _tiled(wide.join(sizes, "key"), tile).join(placed.select("node", "n", "parity"), "node")
        order = ["key", "sub"]
        pairs = (
            met.select(*order, "root", "own", "mixed", "node", "n", "pos", "parity")
            .repartition(*order).sortWithinPartitions(*order, "root", "node").mapInArrow(lambda b: _crossing(b, similarity), "a long, b long")
        )
        return staged(pairs.distinct(), "similar-left", outer=True)


def _classes(docs: DataFrame, size: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """((id, k, node) of every row, one row per class).  Different classes have different numbers, or these are drawn anew."""
    spark = docs.sparkSession
    with scratch(spark):
        frequent = spark.sparkContext.broadcast(_frequent(docs, size))  # at most MOST_FREQUENT shingles
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, k long, node long, check long, fp array<long>, keys array<long>"
    for draw in range(16):
        with scratch(spark):
            sketch = lambda b, draw=draw: _sketches(b, size, frequent.value, similarity, draw)
            found = staged(docs.mapInArrow(sketch, f"{schema}, prefix array<long>, parity binary, n long"), "sketches")
            often = found.select(F.explode("prefix").alias("s")).groupBy("s").count().filter("count > 1").select("s")
            bits = spark.sparkContext.broadcast(bitmap(often, 27))
            slim = found.mapInArrow(lambda b, bits=bits: _shared_prefixes(b, bits.value), f"{schema}, places array<long>, shared array<long>, parity binary, n long")
            first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("rep")
            kept = [F.max(c).alias(c) for c in ("fp", "keys", "places", "shared", "parity", "n")]
            classes = slim.groupBy("node").agg(first, *kept, F.min("check").alias("low"), F.max("check").alias("high"))
            classes = staged(classes, "shingle-classes", outer=True)
            members = staged(found.select("id", "k", "node"), "shingle-members", outer=True)
        if classes.filter("low < high").isEmpty():
            return members, classes.drop("low", "high")
    raise RuntimeError("no draw gives different classes different numbers")


def _rooted(rows: DataFrame, id_col: str, text_col: str, size: int, similarity: float, tile: int) -> DataFrame:
    """(id, k, root) of every row."""
    docs = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    docs = docs.select("id", F.xxhash64("t").alias("k"), "t")
    with scratch(rows.sparkSession):
        members, classes = _classes(docs, size, similarity)
        good = _links(_close(classes, tile), classes, docs, size, similarity)
        roots = staged(components(good), "similar-roots")
        more = _links(_left(classes, roots, similarity, min(tile, 1 << 11)), classes, docs, size, similarity)
        if not more.isEmpty():
            roots = staged(components(good.unionByName(more)), "similar-roots")
        rooted = members.join(roots, "node", "left")
        return staged(rooted.select("id", "k", F.coalesce("root", "node").alias("root")), "similar-rooted", outer=True)


def similar_groups(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8, tile: int = 1 << 14
) -> DataFrame:
    """One row per input row: id, component_id, the least id that can be reached over links of ``similarity`` or more.

    The groups are exact: every link used is, and no pair at the limit is left out.  Texts without words, NULL included, are
    one group.  NULL ids do not count; repeated rows come back as often; an empty table gives no rows; other columns are not read.
    """
    rooted = _rooted(rows, id_col, text_col, size, similarity, tile)
    least = staged(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "similar-least")
    return rooted.join(least, "root").select(F.col("id").alias(id_col), "component_id")


def kept_similar(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8, tile: int = 1 << 14
) -> DataFrame:
    """The row keys of what ``drop_similar`` keeps, staged; nothing else of the work is left behind."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("x")
    with scratch(rows.sparkSession):
        kept = _rooted(rows, id_col, text_col, size, similarity, tile).groupBy("root").agg(first)
        return staged(kept.select(row_key(F.col("x.id"), F.col("x.k")).alias("_key")), "kept-rows", outer=True)


def rows_of_keys(rows: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rows`` with all its columns, one row for each row key of ``kept`` (id and text hash)."""
    own = row_key(F.col(id_col), F.xxhash64(F.col(text_col).cast("string"))).alias("_key")
    return rows.select(own, packed(rows)).join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")


def drop_similar(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8, tile: int = 1 << 14
) -> DataFrame:
    """``rows`` with all its columns, one row of each group: the one with the least id (NULL last), then least text hash."""
    return rows_of_keys(rows, kept_similar(rows, id_col, text_col, size, similarity, tile), id_col, text_col)
