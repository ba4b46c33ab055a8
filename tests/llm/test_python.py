"""SimHash, top-k, substrings, BPE and language ID on odd rows, against brute force."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, components, langid, simhash, substrings, topk
from millrace.llm.queries import QUERIES, vocabulary
from tests.llm.conftest import DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def fingerprint(t):
    w = WORD.findall(low(t))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))


def near(docs):
    """(id, fingerprint, component) by comparing all pairs."""
    prints = np.array([fingerprint(t) for _, t in docs], np.uint64)
    label = np.arange(len(docs))
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    while True:
        new = np.array([label[c].min() for c in close])
        if (new == label).all():
            break
        label = new
    least = {}
    for (i, _), x in zip(docs, label):
        if i is not None:
            least[x] = min(i, least.get(x, i))
    return sorted([(i, f"{p:016x}", least.get(x)) for (i, _), p, x in zip(docs, prints, label)], key=str)


def test_fingerprint_of_long_text_in_pieces(monkeypatch):
    text = DOCS[6][1][:3000] + "  \x0b tail"
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "word_pieces", lambda d: (d[i:j] for i, j in zip((0, *cuts(d)), (*cuts(d), len(d)))))
    assert simhash.fingerprint(text) == whole == fingerprint(text)


def cuts(data):
    return tuple(i for i in range(1, len(data)) if data[i : i + 1].isspace() and i % 7 == 0)


def test_near_groups_on_odd_rows(odd, none):
    assert rows(simhash.near_groups(odd)) == near([(i, t) for i, t, *_ in DOCS])
    assert simhash.near_groups(none).count() == 0 and simhash.drop_near_copies(none).count() == 0


def test_drop_near_copies(odd):
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    want = Counter(c for _, _, c in {(None, p, c) for _, p, c in near([(i, t) for i, t, *_ in DOCS])})
    assert Counter(r["doc_id"] for r in kept.collect()) == want


@pytest.mark.parametrize("name", ["op2_simhash_near_dedup"])
def test_simhash_query(spark, sf_dir, name):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES[name](spark, sf_dir)) == near(docs)


@pytest.mark.parametrize("split", [4096, 3])
def test_links_of_crowded_fingerprints(spark, split):
    rng = np.random.default_rng(split)
    base = rng.integers(0, 2**63, 6).astype(np.uint64)
    prints = np.unique(np.concatenate([base] + [base ^ sum(np.uint64(1) << rng.integers(0, 64, 6).astype(np.uint64) for _ in range(2)) for _ in range(60)]))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    order = ["t", "key", "s", "sub"]
    edges = simhash._buckets(split, df).repartition(*order).sortWithinPartitions(*order, "fp").mapInArrow(simhash._linked, "a long, b long")
    pairs = {tuple(r) for r in edges.collect()}
    assert all((a ^ b & (1 << 64) - 1).bit_count() <= 2 or ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in pairs)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(list(pairs), "a long, b long")).collect()}
    values = prints.view(np.int64)
    close = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    label = values.copy()
    while not (label == (new := np.array([label[c].min() for c in close]))).all():
        label = new
    assert {int(v): got.get(int(v), int(v)) for v in values} == {int(v): int(x) for v, x in zip(values, label)}


def test_components_of_chain_star_loop_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_top_k_with_ties_gaps_and_broken_vectors(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vecs = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 64]) for i in range(200)]
    vecs += [(200, [1.0, 2.0]), (220, []), (240, None), (260, [float("nan")] * 6), (280, [0.1, None]), (300, [float("inf")]), (None, [1.0])]
    vecs += [(301, vecs[40][1]), (302, vecs[40][1]), vecs[40], vecs[40], vecs[41], vecs[41], vecs[41], (60, vecs[61][1]), (320, [0.03, 0.0, 0.0, 0.0, 0.0, -0.5]), (321, [1e6, -1e6])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash")).withColumn("v", F.lit(1))
    clean = []
    for i, v in vecs:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            clean.append((i, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    want = []
    for at, (q, w) in enumerate(clean):  # every row counts, repeated ones too
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(w, v)), c) for n, (c, v) in enumerate(clean) if n != at)[:20]
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores)]
    assert rows(topk.top_k(df)) == sorted(want, key=str)
    assert rows(topk.top_k(df, group_rows=7, tile_cells=10)) == sorted(want, key=str)
    assert topk.top_k(df.filter("vec_id = 0")).count() == 0 and topk.top_k(df.limit(0)).count() == 0


def removed(docs, size):
    words = [WORD.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "bits", "chunk"), [(35, 26, 1 << 19), (2, 26, 10), (2, 7, 1000), (1, 10, 50)])
def test_substrings(odd, none, size, bits, chunk):
    small = odd if size == 35 else odd.filter("doc_id IS NULL OR doc_id NOT IN (6, 7)")
    docs = [(i, t) for i, t, *_ in DOCS if size == 35 or i not in (6, 7)]
    assert rows(substrings.dedup_substrings(small, size=size, bits=bits, chunk_words=chunk)) == removed(docs, size)
    assert substrings.dedup_substrings(none, size=size).count() == 0


def test_windows_that_share_their_first_hash_are_told_apart(spark, monkeypatch):
    """The second hash decides: with a first one of four values almost every window looks repeated."""
    real = substrings.window_hashes
    monkeypatch.setattr(substrings, "window_hashes", lambda words, size: (real(words, size)[0] % np.uint64(4), real(words, size)[1]))
    texts = ["a b c d e f", "x y z", "q b c d r", "same same same"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4), pa.int64()), pa.array(range(4), pa.int64()), pa.array(texts)], names=["k1", "k2", "t"])
    every = np.full(1 << 3, 255, np.uint8)
    seen = Counter()
    for b in substrings._again(iter([batch]), 2, 5, every):
        for h, c, at in zip(*(b.column(x).to_pylist() for x in ("h", "c", "at"))):
            seen[h, c] += len(at)
    assert sorted(n for n in seen.values() if n > 1) == [2, 2, 2]  # "b c", "c d" and "same same"


def test_many_windows_in_few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rng = np.random.default_rng(6)
        docs = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 2000))) for i in range(60)]
        docs += [(100 + i, f"own{i} " + docs[0][1][:3000]) for i in range(40)]  # a passage that many share
        df = spark.createDataFrame(docs, "doc_id long, text string")
        assert rows(substrings.dedup_substrings(df, size=4, chunk_words=1000)) == removed(docs, 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


HARD = [
    "<|endoftext|>a <|endoftext|>  b", "it's WE'LL 'S don't ", "a b c　 \x85\x1c\x1f \n\n x", "é ‍ 👩‍👩‍👧 ²½Ⅷ٣", "\x00\x01�", " " * 50 + "x", "aaaa" * 300,
]


def test_bpe_equals_the_library(spark, odd, none, library):
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    docs = odd.select("doc_id", "text", F.lit("clash").alias("ids"), F.lit("x").alias("_text2")).unionByName(extra, allowMissingColumns=True)
    want = []
    for i, t in [(i, t) for i, t, *_ in DOCS] + [(1000 + i, t) for i, t in enumerate(HARD)]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert rows(bpe.round_trip(docs, vocabulary())) == sorted(want, key=str)
    encoded = bpe.encode(docs, vocabulary())
    back = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, vocabulary()).collect() if r["doc_id"] is not None}
    assert back == {i: t or "" for i, t in [(d[0], d[1]) for d in DOCS if d[0] is not None] + [(1000 + i, t) for i, t in enumerate(HARD)]}
    assert bpe.encode(none, vocabulary()).count() == 0 and bpe.decode(encoded.limit(0), vocabulary()).count() == 0


def test_bpe_pieces_and_cache_change_nothing(library, monkeypatch):
    codec = bpe.Codec(open(vocabulary()).read())
    texts = [t for _, t, *_ in DOCS if t and len(t) < 10_000] + HARD
    monkeypatch.setattr(bpe, "_PIECE", 7)
    monkeypatch.setattr(bpe, "_CACHED", 3)
    for t in texts:
        assert np.frombuffer(b"".join(codec.encode(t)), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(codec) <= 3


@pytest.mark.parametrize("name", ["op6_bpe"])
def test_bpe_query(spark, sf_dir, name, library):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in QUERIES[name](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())


def test_language_query_on_held_out_documents(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op8_language_id"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r["held_out"]} == {d["doc_id"] for d in held}
    right = [got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held]
    assert np.mean(right) >= 0.98 and np.mean([r["rejected"] for r in got.values()]) <= 0.01
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_learns_from_text_and_label_alone(odd, none):
    model = langid.train(odd)
    assert model.langs == ["de", "en", "es", "fr"] or set(model.langs) <= {"de", "en", "es", "fr"}
    got = {r["doc_id"]: r for r in langid.identify(odd, model).collect() if r["doc_id"] is not None}
    for i in (3, 4, 5, 11):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[1]["lang_pred"] in model.langs and got[100]["lang_pred"] == "es"
    assert rows(langid.identify(odd.drop("lang").withColumn("lang", F.lit("xx")), model)) == rows(langid.identify(odd, model))
    kept = langid.drop_rejected(odd, model)
    assert kept.columns == odd.columns and not {3, 4, 5, 11} & {r["doc_id"] for r in kept.collect()}
    empty = langid.train(none)
    assert empty.langs == [] and langid.identify(none, empty).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}


def test_features_in_pieces_and_sample_bound(odd, monkeypatch):
    s = langid.Settings(per_lang=2, most_rows=5)
    langs, x, y = langid._sample(langid._docs(odd, "doc_id", "text", "lang"), s)
    assert len(x) == len(y) <= 5 and np.allclose(x.sum(axis=1)[x.sum(axis=1) > 0], 1, atol=1e-5) and langs
    text = "Hello  World, été 12 " * 40
    whole = langid.features(text, 512)
    assert whole.sum() == pytest.approx(1, abs=1e-5)
    assert np.array_equal(whole, langid.features(text.upper().replace("ÉTÉ", "été"), 512))
