"""SentencePiece coding against the library; phrase mining and ranked search against plain Python."""

import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from millrace.llm import lexical, phrases, pieces
from millrace.llm.queries import QUERIES, piece_model
from tests.llm.conftest import DOCS


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# --- pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.read_model(piece_model()))


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


def test_codec_is_the_library(codec, library):
    rng = random.Random(7)
    letters = "aabcdeehilnorstu    ▁\n\t.,;:'\"()<>0123é漢字😀ßñ\x00́ Åж한"
    texts = ["", " ", "  ", "▁", "<s></s><unk><0x0A>", " " * 70, "a" * 500, "the" * 90, "\n \n"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(4000)]
    texts += ["".join(codec.pieces[rng.randrange(259, 32000)] for _ in range(rng.randrange(1, 8))) for _ in range(4000)]
    for t in texts:
        got = ids_of(codec, t)
        assert got == library.encode(t, add_bos=True, add_eos=True), t
        assert codec.decode(got) == library.decode(got), t


def test_decoding_any_ids_is_the_library(codec, library):
    rng = random.Random(8)
    for _ in range(4000):
        ids = [rng.randrange(32000) if rng.random() < 0.6 else rng.randrange(259) for _ in range(rng.randrange(8))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_memories_change_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(pieces, "_CACHED", 3)
    monkeypatch.setattr(pieces, "_PAIRS", 3)
    fresh = pieces.Codec(pieces.read_model(piece_model()))
    text = "some words, and some others: Wörter 漢字 and some words again"
    assert ids_of(fresh, text) == ids_of(codec, text) == library.encode(text, add_bos=True, add_eos=True)
    assert len(fresh) <= 3 and len(fresh.old) <= 3 and len(fresh.pairs) <= 3


def test_neighbours_decide(codec):
    """A sequence of tokens is an encoding exactly if every two neighbours are the encoding of theirs."""
    tokens = codec.tokens("▁internationalisation")
    assert all(codec._merges_to(a, b) for a, b in zip(tokens, tokens[1:])) and "".join(tokens) == "▁internationalisation"
    assert not codec._merges_to("▁t", "he") and codec._merges_to("", "▁the")


def test_pieces_on_odd_rows(odd, none, library):
    path = piece_model()
    coded = pieces.encode(odd, path, keep=("lang", "name"))
    assert coded.columns == ["doc_id", "lang", "name", "n_tokens", "token_ids"]
    want = Counter((i, tuple(library.encode(t or "", add_bos=True, add_eos=True))) for i, t, *_ in DOCS)
    got = coded.collect()
    assert Counter((r["doc_id"], tuple(r["token_ids"])) for r in got) == want and all(r["n_tokens"] == len(r["token_ids"]) for r in got)
    assert Counter(tuple(r) for r in pieces.decode(coded, path).collect()) == Counter((i, t or "") for i, t, *_ in DOCS)
    bare = pieces.encode(odd.filter("doc_id = 4"), path, ends=False).first()
    assert bare["n_tokens"] == 0 and bare["token_ids"] == []
    assert pieces.decode(odd.select("doc_id", F.lit(None).cast("array<int>").alias("token_ids")), path).filter("text IS NOT NULL").count() == 0
    assert pieces.encode(none, path).count() == pieces.round_trip(none, path).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(odd, path, keep=("n_tokens",))


def digests(rows, library):
    out = []
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        out.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def test_op11_is_the_library(spark, odd, sf_dir, library):
    assert sorted(map(tuple, pieces.round_trip(odd, piece_model()).collect()), key=str) == digests([(i, t) for i, t, *_ in DOCS], library)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op11_sentencepiece"](spark, sf_dir).collect()), key=str) == digests(docs, library)


# --- phrases


def mined(rows, least, limit):
    """rows (lang, text) to the result, by counting everything."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for size in range(1, 5):
                f[lang].update(w[i : i + size] for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 80 * a and inside[p]:
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), a, counts[p[:k]], counts[p[k:]]))
        for rank, (s, _, p, a, l, r) in enumerate(sorted(scored)[:limit], 1):
            out.append((lang, rank, p.decode(), a, l, r, n[lang], -s))
    return sorted(out)


def some_texts(seed, docs, words=12):
    rng = random.Random(seed)
    fixed = ["red apple pie", "new york city hall", "a b", "once Upon a time", "é ß"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randrange(1, 60)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else f"w{int(rng.expovariate(0.4)) % words}")
            if rng.random() < 0.1:
                parts[-1] += rng.choice([",", ".", "\n", "!?", "\t", "\r\n"])
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), " ".join(parts)))
    return rows


@pytest.mark.parametrize("least,limit,visits", [(2, 2000, 1 << 15), (3, 5, 4), (5, 20, 1), (2, 1, 2)])
def test_phrases_are_those_of_counting_everything(spark, least, limit, visits):
    rows = some_texts(least, 60)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = phrases.collocations(df, least=least, limit=limit, first_visits=visits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == mined(rows, least, limit)


def test_phrases_with_a_tiny_bitmap_are_the_same(spark):
    rows = some_texts(11, 40)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, phrases.collocations(df, least=3, limit=7, first_visits=3, bits=7).collect())) == mined(rows, 3, 7)


def test_phrases_on_odd_rows(odd, none, spark):
    rows = [(lang, t) for _, t, lang, _ in DOCS]
    assert sorted(map(tuple, phrases.collocations(odd, least=2, limit=50).collect())) == mined(rows, 2, 50)
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(odd, least=10**6).count() == 0


def test_a_text_in_many_stretches_is_counted_once(monkeypatch):
    text = " ".join(["one two three four five six"] * 50) + ". seven eight one two"
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], names=["lang", "t"])
    live = np.full(1 << 4, 255, np.uint8)

    def counts(pairs):
        total = Counter()
        for b in phrases._count_phrases(iter([batch]), 0, live, pairs, live, live, None):
            for *key, a in zip(*(c.to_pylist() for c in b.columns)):
                total[tuple(key)] += a
        return total

    whole = counts(True), counts(False)
    monkeypatch.setattr(phrases, "_PIECE", 40)
    assert (counts(True), counts(False)) == whole and sum(whole[0].values()) == 6 * 50 - 1 + 3


# --- search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def searched(docs, items, k):
    bags = [(i, Counter(TERM.findall(low(t)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        terms = set(TERM.findall(low(text)))
        scored = []
        for i, b in bags:
            m = 100 - 50 + 50 * b.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * m)) for t in terms if t in b
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if none else i, -s))
    return sorted(out, key=str)


ITEMS = [(1, "hello WORLD common line"), (2, None), (3, ""), (4, "shared1 shared59 passage word3é"), (4, "own line 3 own"), (None, "id here no"), (5, "nowhere to befound"), (6, "漢字 😀 the key")]


@pytest.mark.parametrize("k,postings,most_items", [(50, 1 << 21, 2048), (3, 1, 2048), (2, 5, 1), (1, 40, 3)])
def test_search_is_that_of_scoring_everything(spark, odd, k, postings, most_items):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = lexical.ranked_search(odd, items, k=k, postings=postings, most_items=most_items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == searched([(i, t) for i, t, *_ in DOCS], ITEMS, k)


def test_search_of_many_ties_and_skewed_lengths(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(f"t{int(rng.expovariate(0.2))}" for _ in range(rng.choice([1, 5, 40, 300])))) for i in range(400)]
    docs += [(1000 + i, "t1 t2 t3") for i in range(90)]
    items = [(i, " ".join(f"t{rng.randrange(25)}" for _ in range(8))) for i in range(12)] + [(99, "t1 t2 t3")]
    got = lexical.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), k=20, postings=3000)
    assert sorted(map(tuple, got.collect()), key=str) == searched(docs, items, 20)


def test_search_stops_before_the_end():
    """A document that is best everywhere ends the search: the others stay unread."""
    n = 5000
    impacts = np.arange(n, 0, -1) * 100
    impacts[0] *= 10
    lists = lexical.ImpactLists(np.full(n, 2), np.tile([0, 1], n).astype(np.int32), np.repeat(impacts, 2), 2)
    read = []
    direct = lists._direct
    lists._direct = lambda docs, *rest: read.append(len(docs)) or direct(docs, *rest)
    docs, scores = lists.search(np.array([0, 1]), np.array([1, 1]), 1, 1)
    assert docs[scores.argmax()] == 0 and sum(read) < 100


def test_search_of_nothing(odd, none, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.ranked_search(none, items).count() == 0
    assert lexical.ranked_search(odd, items.limit(0)).count() == 0
    clash = odd.withColumn("item", F.lit(1)).withColumn("score", F.lit("x")).withColumn("terms", F.lit("x"))
    assert lexical.ranked_search(clash, items.withColumn("rank", F.lit(0)), k=2).count() > 0
