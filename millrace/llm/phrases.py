"""Phrase collocations by best-first branch-and-bound growth over prefix counts.

Words are 64-bit numbers drawn from language and word, proven to be different for different words (or drawn anew), so a phrase
is a tuple of numbers and its count is exact.  Words and pairs are counted in full.  From then on phrases are grown from the
front: whatever begins with a phrase x of a first word v occurs at most f(x) times, and cutting it after v bounds its score by
2000000 f(x) / (f(v) + f(x)).  A round visits each language's phrases with the highest bounds: it counts all their extensions
by one word, to the right (growth) and to the left (both tell whether a longer phrase absorbs it).  The ``limit``-th score of
what has been visited and survives is the language's threshold; rounds go on while a bound, or the possible score of a phrase
whose parts are not all counted yet, is not below it.  Ties are visited too.

A round is one pass over the texts.  It carries bitmaps of a fixed size in place of the visited phrases: a phrase that meets a
set bit by chance is counted for nothing, which changes no count.  Tasks add up a piece of text before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, UPPER, staged, text_of, word_pieces
from millrace.llm.substrings import _mix, _spans_hash

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BREAK, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK[list(b" \t")] = True
_APART = _BREAK | _BLANK
_BASES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xCA5A826395121157, 0xA24BAED4963EE407))
_KEYS = ["size", "w1", "w2", "w3", "w4"]
_PIECE = 1 << 19  # bytes of text a task looks at together


class _Words:
    """The words of a stretch of text in one language: numbers, piece numbers, places."""

    def __init__(self, data: bytes, salt: int, draw: int, pieces_before: int):
        self.data = data
        raw = np.frombuffer(data, np.uint8)
        edge = np.diff(np.r_[True, _APART[raw], True].astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        breaks = np.r_[0, np.cumsum(_BREAK[raw])] + pieces_before
        self.piece, self.pieces = breaks[self.starts], int(breaks[-1])
        self.values = raw.astype(np.uint64) + np.uint64(1)
        self.ids = self.hashes(draw, salt) if len(self.starts) else np.zeros(0, np.uint64)

    def hashes(self, draw: int, salt: int) -> np.ndarray:
        base = _BASES[draw % len(_BASES)] + np.uint64(8 * (draw // len(_BASES)))
        return _mix(_mix(_spans_hash(self.values, self.starts, self.ends, base)) ^ np.uint64(salt))


def _stretches(batches: Iterator[pa.RecordBatch], draw: int) -> Iterator[tuple[str, bool, _Words]]:
    """(lang, t) to (language, whether it goes on from the stretch before, words).  Texts end pieces."""
    for batch in batches:
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            texts.setdefault(lang, []).append(text.as_py().encode("utf-8", "surrogatepass").translate(_FOLD))
        for lang, own in texts.items():
            salt = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
            at, pieces = 0, 0
            while at < len(own):
                upto, size = at, 0
                while upto < len(own) and (size < _PIECE or upto == at):
                    size += len(own[upto])
                    upto += 1
                goes_on = False
                for part in word_pieces(b"\n".join(own[at:upto]), _PIECE):
                    words = _Words(part, salt, draw, pieces)
                    yield lang, goes_on, words
                    goes_on, pieces = True, words.pieces
                at, pieces = upto, pieces + 1


def _grouped(cols: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and how often they occur (a row may come back in two parts)."""
    key = cols[0]
    for c in cols[1:]:
        key = _mix(key * _BASES[0] + c)
    order = np.argsort(key)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[order][1:] != c[order][:-1]
    first = np.flatnonzero(new)
    return [c[order[first]] for c in cols], np.diff(np.r_[first, len(order)])


def _count_words(batches: Iterator[pa.RecordBatch], draw: int) -> Iterator[pa.RecordBatch]:
    for lang, _, w in _stretches(batches, draw):
        if not len(w.ids):
            continue
        other = w.hashes(draw + 1, 0)  # words that share their number are told apart here and found below
        order = np.argsort(w.ids, kind="stable")
        a, b = w.ids[order], other[order]
        if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
            order = np.lexsort((other, w.ids))
            a, b = w.ids[order], other[order]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        at = order[first]
        words = [w.data[s:e].decode("utf-8", "replace") for s, e in zip(w.starts[at].tolist(), w.ends[at].tolist())]
        cols = [pa.array([lang] * len(at)), pa.array(a[first].view(np.int64)), pa.array(words), pa.array(np.diff(np.r_[first, len(a)]))]
        yield pa.RecordBatch.from_arrays(cols, names=["lang", "id", "word", "f"])


def _key(cols: list[np.ndarray]) -> np.ndarray:
    key = cols[0]
    for c in cols[1:]:
        key = _mix(key * _BASES[1] + c)
    return key


def _met(bits: np.ndarray | None, key: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set."""
    if bits is None:
        return np.zeros(len(key), bool)
    place = key >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray | None:
    """A bitmap of 2^bits bits of the rows of numbers; None if there are no rows.  Its size does not depend on the rows."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = _key([c.to_numpy().view(np.uint64) for c in b.columns]) >> np.uint64(64 - bits)
            word = np.left_shift(np.uint64(1), place & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(word)], names=["slot", "word"])

    found = keys.mapInArrow(places, "slot long, word long").groupBy("slot").agg(F.bit_or("word").alias("word")).toArrow()
    if not found.num_rows:
        return None
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["slot"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def _rows(size: int, cols: list[np.ndarray]) -> pa.RecordBatch | None:
    if not len(cols[0]):
        return None
    own, count = _grouped(cols)
    if size == 2:
        return pa.RecordBatch.from_arrays([*[pa.array(c.view(np.int64)) for c in own], pa.array(count)], names=["w1", "w2", "a"])
    own += [np.zeros(len(count), np.uint64)] * (4 - size)
    arrays = [pa.array(np.full(len(count), size, np.int32)), *[pa.array(c.view(np.int64)) for c in own], pa.array(count)]
    return pa.RecordBatch.from_arrays(arrays, names=[*_KEYS, "a"])


def _count_phrases(
    batches: Iterator[pa.RecordBatch], draw: int, live: np.ndarray, pairs: bool, grow2: np.ndarray | None, grow3: np.ndarray | None, exact3: np.ndarray | None
) -> Iterator[pa.RecordBatch]:
    """Counts of all pairs of live words, or of what extends the phrases of the bitmaps and of the triples asked for."""
    old_ids, old_piece = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for _, goes_on, words in _stretches(batches, draw):
        held = len(old_ids) if goes_on else 0
        ids, piece = (np.concatenate([old_ids, words.ids]), np.concatenate([old_piece, words.piece])) if held else (words.ids, words.piece)
        old_ids, old_piece = ids[-3:], piece[-3:]
        if len(ids) < 2:
            continue
        ok = _met(live, ids)
        ok2 = ok[:-1] & ok[1:] & (piece[:-1] == piece[1:])

        def new(mask: np.ndarray, size: int, held: int = held) -> np.ndarray:
            mask[: max(0, held - size + 1)] = False  # counted with the stretch before
            return np.flatnonzero(mask)

        if pairs:
            i = new(ok2, 2)
            if (out := _rows(2, [ids[i], ids[i + 1]])) is not None:
                yield out
            continue
        ok3 = ok2[:-1] & ok2[1:]
        at2, at3 = np.flatnonzero(ok2), np.flatnonzero(ok3)
        in2, in3, want = np.zeros(len(ok2), bool), np.zeros(len(ok3), bool), np.zeros(len(ok3), bool)
        in2[at2] = _met(grow2, _key([ids[at2], ids[at2 + 1]]))
        if grow3 is not None or exact3 is not None:
            key = _key([ids[at3], ids[at3 + 1], ids[at3 + 2]])
            in3[at3], want[at3] = _met(grow3, key), _met(exact3, key)
        i = new(ok3 & (in2[:-1] | in2[1:] | want), 3)
        if (out := _rows(3, [ids[i + j] for j in range(3)])) is not None:
            yield out
        i = new(ok3[:-1] & ok3[1:] & (in3[:-1] | in3[1:]), 4)
        if (out := _rows(4, [ids[i + j] for j in range(4)])) is not None:
            yield out


def _big(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def _score(a: str, l: str, r: str) -> Column:
    """floor(2000000 a / (l + r)) of SQL expressions, in decimals wide enough for any product of 64-bit counts."""
    wide = lambda x: f"CAST({x} AS DECIMAL(20,0))"
    return F.expr(f"(2000000BD * {wide(a)}) div ({wide(l)} + {wide(r)})")


def _named(pairs: DataFrame, a: str, b: str, **names: str) -> DataFrame:
    """The pairs' table with its key called ``a``, ``b`` and its other columns renamed."""
    return pairs.select(F.col("w1").alias(a), F.col("w2").alias(b), *[F.col(old).alias(new) for new, old in names.items()])


def _nodes(pairs: DataFrame, known: DataFrame, seen: DataFrame) -> DataFrame:
    """Every phrase counted so far: its cuts, score (at most, unless ``exact``), bound of what it begins, fate."""
    zero = F.lit(0).cast("long")
    cut = lambda l, r: F.struct(_score("a", l, r).alias("score"), F.expr(l).alias("l"), F.expr(r).alias("r"))
    two = pairs.select(
        "lang", F.lit(2).alias("size"), "w1", "w2", zero.alias("w3"), zero.alias("w4"), "a", "f1", F.array(cut("f1", "f2")).alias("cuts"), F.lit(True).alias("exact"),
    )
    threes, fours = known.filter("size = 3"), known.filter("size = 4")
    three = threes.join(_named(pairs, "w1", "w2", lang="lang", f1="f1", head="a"), ["w1", "w2"]).join(_named(pairs, "w2", "w3", rest="a", last="f2"), ["w2", "w3"])
    three = three.select(
        "lang", "size", "w1", "w2", "w3", "w4", "a", "f1",
        F.array(cut("f1", "rest"), cut("head", "last")).alias("cuts"), F.lit(True).alias("exact"),
    )
    four = fours.join(_named(pairs, "w1", "w2", lang="lang", f1="f1", head="a"), ["w1", "w2"]).join(_named(pairs, "w3", "w4", rest="a", last="f2"), ["w3", "w4"])
    part = lambda ws, name: threes.select(*[F.col(f"w{i + 1}").alias(w) for i, w in enumerate(ws)], F.col("a").alias(name))
    four = four.join(part(["w1", "w2", "w3"], "head3"), ["w1", "w2", "w3"], "left").join(part(["w2", "w3", "w4"], "rest3"), ["w2", "w3", "w4"], "left")
    four = four.select(
        "lang", "size", "w1", "w2", "w3", "w4", "a", "f1",
        F.array(cut("f1", "coalesce(rest3, a)"), cut("head", "rest"), cut("coalesce(head3, a)", "last")).alias("cuts"),
        (F.col("head3").isNotNull() & F.col("rest3").isNotNull()).alias("exact"), F.col("head3").isNull().alias("no_head"), F.col("rest3").isNull().alias("no_rest"),
    )
    every = two.unionByName(three).unionByName(four, allowMissingColumns=True)
    inner = [
        known.filter(F.col("size") == s).select(F.lit(s - 1).alias("size"), *[(F.col(f"w{i + d}") if i < s else zero).alias(f"w{i}") for i in range(1, 5)], F.col("a").alias("longest"))
        for s in (3, 4) for d in (0, 1)
    ]
    longest = reduce(DataFrame.unionByName, inner).groupBy(*_KEYS).agg(F.max("longest").alias("longest"))
    every = every.join(longest, _KEYS, "left").join(seen.withColumn("visited", F.lit(True)), _KEYS, "left")
    best = F.array_min(F.transform("cuts", lambda c, i: F.struct(c["score"].alias("score"), i.alias("k"), c["l"].alias("l"), c["r"].alias("r"))))
    every = every.withColumn("best", best).withColumn("bound", F.when(F.col("size") < 4, _score("a", "f1", "a")))
    absorbed = F.coalesce(_big("longest") * 100 >= _big("a") * 80, F.lit(False))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return every.select(
        "lang", *_KEYS, "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"), "bound", "exact",
        flag("no_head"), flag("no_rest"), absorbed.alias("absorbed"), (F.coalesce("visited", F.lit(False)) | (F.col("size") == 4)).alias("settled"),
    )


def _highest(rows: DataFrame, by: str, most: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.col(by).desc(), *_KEYS)
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= most)


def collocations(
    rows: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, limit: int = 2000, first_visits: int = 1 << 15, bits: int = 24
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``limit`` phrases of two to four words.

    Texts are split at ``.,;:!?`` and line ends into pieces, these at blanks and tabs into words, A-Z in lower case.  Phrases
    that occur ``least`` times are candidates; the lowest-scoring cut counts, ties to the shortest first part; a candidate
    inside a longer one with at least 80 % of its occurrences is dropped.  Order: score, then a, both descending, then phrase.
    NULL languages are ``und``, NULL texts empty; every row counts, repeated ones too; languages without candidates have no
    rows, nor has an empty table; other columns are not read.  A language's first round visits ``first_visits`` phrases, each
    later one twice as many.
    """
    slim = rows.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("t"))
    for draw in range(16):
        counted = slim.mapInArrow(lambda b, draw=draw: _count_words(b, draw), "lang string, id long, word string, f long")
        words = staged(counted.groupBy("lang", "id", "word").agg(F.sum("f").alias("f")), "words")
        if words.groupBy("id").count().filter("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("no draw gives different words different numbers")
    totals = staged(words.groupBy("lang").agg(F.sum("f").alias("n")), "language-words")
    often = staged(words.filter(F.col("f") >= least), "frequent-words")
    live = _bitmap(often.select("id"), bits)
    if live is None:
        return slim.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    shared = slim.sparkSession.sparkContext.broadcast

    def count(keys: list[str], *maps: np.ndarray | None) -> DataFrame:
        held = shared((live, *(maps or (None, None, None))))
        schema = ", ".join(f"{k} {'int' if k == 'size' else 'long'}" for k in [*keys, "a"])
        found = slim.mapInArrow(lambda b: _count_phrases(b, draw, held.value[0], len(keys) == 2, *held.value[1:]), schema)
        return found.groupBy(*keys).agg(F.sum("a").alias("a")).filter(F.col("a") >= least)

    f_of = lambda w, f: often.select(F.col("id").alias(w), F.col("f").alias(f))
    pairs = count(["w1", "w2"]).join(f_of("w2", "f2"), "w2").join(often.select(F.col("id").alias("w1"), F.col("f").alias("f1"), "lang"), "w1")
    pairs = staged(pairs, "pairs")
    spark = slim.sparkSession
    known = spark.createDataFrame([], "size int, w1 long, w2 long, w3 long, w4 long, a long")
    seen, visits = known.drop("a"), first_visits
    while True:
        nodes = staged(_nodes(pairs, known, seen), "phrases")
        good = nodes.filter("exact and settled and not absorbed")
        tau = _highest(good, "score", limit).groupBy("lang").agg(F.min("score").alias("tau"), F.count("*").alias("c")).filter(F.col("c") == limit)
        tau = staged(tau.select("lang", "tau"), "thresholds")
        nodes = nodes.join(tau, "lang", "left").withColumn("tau", F.coalesce("tau", F.lit(0).cast("long")))
        visit = staged(_highest(nodes.filter("size < 4 and not settled and bound >= tau"), "bound", visits).select(*_KEYS), "visits")
        open_ = nodes.filter("not exact and score >= tau")
        ask = staged(
            open_.filter("no_head").select("w1", "w2", "w3").unionByName(open_.filter("no_rest").select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("w4").alias("w3"))).distinct(), "triples",
        )
        maps = [
            _bitmap(visit.filter("size = 2").select("w1", "w2"), bits), _bitmap(visit.filter("size = 3").select("w1", "w2", "w3"), bits), _bitmap(ask, bits),
        ]
        if all(m is None for m in maps):
            break
        known = staged(known.unionByName(count(_KEYS, *maps)).dropDuplicates(_KEYS), "known-phrases")
        seen = staged(seen.unionByName(visit), "visited")
        visits *= 2
    spelt = nodes.filter("exact and settled and not absorbed and score >= tau").select("lang", *_KEYS, "a", "l", "r", "score")
    for i in range(1, 5):
        spelt = spelt.join(often.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"t{i}")), f"w{i}", "left")
    spelt = spelt.withColumn("phrase", F.concat_ws(" ", F.slice(F.array("t1", "t2", "t3", "t4"), F.lit(1), F.col("size"))))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = spelt.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= limit)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
