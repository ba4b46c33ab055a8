"""The pipeline's stages against plain Python, each on its own input."""

import os
import re
import struct
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import langid, mixing, similar
from millrace.llm.queries import vocabulary
from millrace.session import shared_root
from tests.llm.conftest import DOCS
from tests.llm.test_native import low, mixed
from tests.llm.test_python import near

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shingles(t, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def similar_groups(docs, limit=0.8):
    """Least id of each group, all pairs that share a shingle compared."""
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s or {None}:
            holders[x].append(n)
    label = list(range(len(docs)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in {(v[i], v[j]) for v in holders.values() for j in range(len(v)) for i in range(j)}:
        both = len(sets[a] & sets[b])
        if sets[a] == sets[b] or both / (len(sets[a]) + len(sets[b]) - both) >= limit:
            x, y = sorted((root(a), root(b)))
            label[y] = x
    least = {}
    for n, (i, _) in enumerate(docs):
        if i is not None:
            least[root(n)] = min(i, least.get(root(n), i))
    return sorted([(i, least.get(root(n))) for n, (i, _) in enumerate(docs)], key=str)


def pairs(df):
    return sorted([tuple(r) for r in df.select("doc_id", "text").collect()], key=str)


def test_similar_groups_on_odd_rows(odd, none):
    assert sorted(map(tuple, similar.similar_groups(odd).collect()), key=str) == similar_groups([(i, t) for i, t, *_ in DOCS])
    kept = similar.drop_similar(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in similar_groups([(i, t) for i, t, *_ in DOCS])}
    assert similar.similar_groups(none).count() == 0 and similar.drop_similar(none).count() == 0


@pytest.mark.parametrize("tile", [1 << 14, 7])
def test_a_large_group_of_near_copies_is_one_group(spark, tile):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(60):
        words = list(base)
        for at in rng.integers(0, 300, 3):
            words[at] = f"x{rng.integers(1e6)}"
        docs.append((i, " ".join(words)))
    docs += [(100 + i, " ".join(f"v{rng.integers(1e6)}" for _ in range(50))) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, similar.similar_groups(df, tile=tile).collect()), key=str) == similar_groups(docs)


@pytest.mark.parametrize("tile", [1 << 14, 50])
def test_a_star_of_copies_linked_only_to_their_base_is_one_group(spark, tile):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]
    docs = [(0, " ".join(base))]
    for i in range(1, 401):  # six edits each: about 0.82 to the base, 0.67 to each other
        words = list(base)
        for at in rng.choice(58, 6, replace=False) * 5 + rng.integers(0, 5):
            words[at] = f"x{rng.integers(1e9)}"
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, similar.similar_groups(df, tile=tile).collect()), key=str) == similar_groups(docs)


def test_short_texts_at_the_limit_are_all_linked(spark):
    """Four shingles against five, the similarity exactly 0.8: their fingerprints differ too much in one pair of eleven."""
    docs = []
    for i in range(300):
        text = " ".join(f"u{i}x{j}" for j in range(8))
        docs += [(2 * i, text), (2 * i + 1, f"{text} more{i}")]
    want = similar_groups(docs)
    assert len({c for _, c in want}) == 300
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, similar.similar_groups(df).collect()), key=str) == want


@pytest.mark.parametrize("words,copies", [(300, 200), (2000, 400)])
def test_a_star_of_copies_sends_few_pairs_to_be_verified(spark, words, copies):
    """Each copy is at about 0.82 to the base and 0.67 to the others: parity as wide as the set tells these apart."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(words)]
    docs = [(0, " ".join(base))]
    edits = words // 50
    for i in range(1, copies + 1):
        own = list(base)
        for at in rng.choice(words // 5 - 2, edits, replace=False) * 5 + rng.integers(0, 5):
            own[at] = f"x{rng.integers(1e9)}"
        docs.append((i, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("k"), F.col("text").alias("t"))
    _, classes = similar._classes(df, 5, 0.8)
    roots = spark.createDataFrame([], "node long, root long")
    assert copies <= similar._left(classes, roots, 0.8, 1 << 11).count() <= 4 * copies


def test_parity_differs_in_no_more_bits_than_the_sets_do():
    rng = np.random.default_rng(2)
    for n in (3, 200, 900, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 9 :], rng.integers(0, 2**63, n // 7).astype(np.uint64)]))
        x, y = (np.frombuffer(similar._parity(h), np.uint8)[None, :] for h in (a, b))
        least = 8 * min(x.shape[1], y.shape[1])
        apart = int(np.bitwise_count(similar._folded(x, least) ^ similar._folded(y, least)).sum())
        assert apart <= len(np.setxor1d(a, b)) and apart >= 0.5 * len(np.setxor1d(a, b))
        assert np.array_equal(similar._folded(x, 256)[0], np.packbits(np.bincount((similar._mix(a) >> np.uint64(56)).astype(int), minlength=256) & 1, bitorder="little").astype(np.uint8))


def test_what_is_staged_is_removed(spark, odd):
    before = {os.path.join(d, n) for d, names, _ in os.walk(shared_root(spark)) for n in names}
    kept = similar.drop_similar(odd)
    new = {os.path.join(d, n) for d, names, _ in os.walk(shared_root(spark)) for n in names} - before
    assert {os.path.basename(n).rsplit("-", 1)[0] for n in new if os.path.basename(os.path.dirname(n)) == "millrace"} == {"kept-rows"}
    assert kept.count() > 0


def test_sketch_of_pieces_and_short_texts():
    assert len(similar.shingles("", 5)) == 0 and len(similar.shingles("a b", 5)) == 1 and len(similar.shingles(None, 5)) == 0
    text = " ".join(f"w{i}" for i in range(400_000))
    assert len(similar.shingles(text, 5)) == 400_000 - 4


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, sf_dir), name)
        seen[name] = (docs, out)
        docs = out
    return seen


def test_stages(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "source_mixing", "bpe"]
    for name, (docs, out) in stages.items():
        if name != "bpe":
            assert out.columns == docs.columns == COLUMNS


def test_language_stage_keeps_what_the_model_accepts(stages):
    docs, out = stages["language_id"]
    model = langid.train(docs)
    assert pairs(out) == sorted([(r["doc_id"], r["text"]) for r in docs.collect() if not model.predict(r["text"])[2]], key=str)
    assert out.count() >= 0.98 * docs.count()


def test_exact_stage(stages):
    docs, out = stages["exact_dedup"]
    keep = {}
    for i, t in pairs(docs):
        keep[low(t)] = max(i, keep.get(low(t), i))
    assert pairs(out) == sorted([(i, t) for i, t in pairs(docs) if keep[low(t)] == i], key=str)


def test_near_stage(stages):
    docs, out = stages["near_dedup"]
    rows = dict(pairs(docs))
    first = {c for _, _, c in near(list(rows.items()))}
    kept = {c for _, c in similar_groups([(i, rows[i]) for i in first])}
    assert {i for i, _ in pairs(out)} == kept and out.count() == len(kept)


def test_mixing_stage(stages):
    docs, out = stages["source_mixing"]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    want = {i: copies for i, _, _, _, _, _, copies in mixed(rows, mixing.Target(repeats=1.25))}
    assert Counter(r["doc_id"] for r in out.select("doc_id").collect()) == Counter(want) and min(want.values()) >= 1


def test_bpe_stage(stages):
    docs, out = stages["bpe"]
    library = Tokenizer.from_file(vocabulary())
    want = Counter((i, struct.pack(f"<{len(e.ids)}I", *e.ids)) for i, t in pairs(docs) for e in [library.encode(t or "", add_special_tokens=False)])
    got = out.select("doc_id", "token_ids", "n_tokens", "lang", "source").collect()
    assert Counter((r["doc_id"], struct.pack(f"<{len(r['token_ids'])}I", *r["token_ids"])) for r in got) == want
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in got)


def test_run_is_its_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    want = stages["bpe"][1]
    assert got.columns == want.columns
    assert got.select("doc_id", "n_tokens").exceptAll(want.select("doc_id", "n_tokens")).count() == 0 and got.count() == want.count()


def test_stages_take_odd_rows(spark, odd, none, sf_dir):
    for docs in (odd.withColumn("n_chars", F.length("text")), none):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), "odd")
        assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]


def test_pairs_of_a_large_bucket_are_not_held_together():
    rng, many = np.random.default_rng(3), 3000
    n = rng.integers(200, 256, many)
    parity = [similar._parity(rng.integers(0, 2**63, int(k)).astype(np.uint64)) for k in n]
    parity[1], n[1] = parity[0], n[0]
    cols = [np.zeros(many, int), np.zeros(many, int), np.arange(many), np.zeros(many, np.int32), np.zeros(many, np.int32), np.arange(many), n, np.zeros(many, int)]
    batch = pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(parity, pa.binary())], names="key sub root own mixed node n pos parity".split())
    tracemalloc.start()
    try:
        found = [(a.as_py(), b.as_py()) for made in similar._crossing(iter([batch]), 0.8) for a, b in zip(*made.columns)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (0, 1) in found and peak < 60e6  # 4.5 million pairs
