import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions.udfs import chat_udf, text_udf
from millrace.operators import retrieval, vector_index
from millrace.operators.retrieval import SEPARATORS, _Rows, chunk, encode, fit_encoder, generate, knn, knn_lsh, passage_prompts, split_spans, split_text, stuff_prompt
from millrace.operators.vector_index import build_index, load_index, search_index
from millrace.sources.readers import html_text


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)).astype("float32")
    x[100:110] = x[0]  # equal vectors: ties go to the lower id
    return x, spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id bigint, vector array<float>").repartition(5)


def brute(x, q, k, metric):
    x, q = x.astype(float), q.astype(float)
    if metric == "cosine":
        x, q = x / np.linalg.norm(x, axis=1, keepdims=True), q / np.linalg.norm(q)
        d = ((x - q) ** 2).sum(axis=1) / 2
    else:
        d = np.sqrt(((x - q) ** 2).sum(axis=1))
    order = sorted(range(len(x)), key=lambda i: (d[i], i))[:k]
    return [(i, d[i]) for i in order]


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("group_rows,max_bytes", [(1 << 16, 16 << 20), (90, 16 << 20), (100, 0)])
def test_knn_is_exact(spark, vectors, metric, group_rows, max_bytes):
    x, corpus = vectors
    queries = corpus.filter("id < 60").withColumnRenamed("id", "query_id")
    got = {}
    for r in knn(queries, corpus, 4, metric, group_rows=group_rows, max_bytes=max_bytes).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["id"], r["distance"])
    assert set(got) == set(range(60))
    for q, hits in got.items():
        want = brute(x, x[q], 4, metric)
        assert [hits[i + 1][0] for i in range(4)] == [w[0] for w in want]
        assert np.allclose([hits[i + 1][1] for i in range(4)], [w[1] for w in want], atol=1e-9)


def test_knn_small_and_empty(spark, vectors):
    _, corpus = vectors
    queries = corpus.filter("id = 7").withColumnRenamed("id", "query_id")
    assert knn(queries, corpus.filter("id < 2"), 5).count() == 2
    assert knn(queries.limit(0), corpus, 5).count() == 0
    for max_bytes in (0, 16 << 20):
        assert knn(queries, corpus.limit(0), 5, max_bytes=max_bytes).count() == 0 and knn(queries.limit(0), corpus, 5, max_bytes=max_bytes).count() == 0
    with pytest.raises(ValueError):
        knn(queries, corpus, 5, "dot").count()
    named = corpus.withColumn("id", F.concat(F.lit("n"), F.col("id").cast("string")))
    assert knn(queries, named, 1).first()["id"] == "n7"


def test_lsh_recall(spark, vectors):
    _, corpus = vectors
    queries = corpus.filter("id < 40").withColumnRenamed("id", "query_id")
    exact = {(r["query_id"], r["id"]) for r in knn(queries, corpus, 3).collect()}
    found = {(r["query_id"], r["id"]) for r in knn_lsh(queries, corpus, 3, bucket_length=1.0, tables=6).collect()}
    assert len(exact & found) / len(exact) >= 0.9
    thin = knn_lsh(queries, corpus, 3, bucket_length=1e-6, tables=1)  # no neighbour shares a bucket
    assert {(r["query_id"], r["id"]) for r in thin.collect()} == exact
    assert knn_lsh(queries.limit(0), corpus, 3).count() == 0


def test_crowded_buckets_are_measured_in_groups(spark, vectors):
    _, corpus = vectors
    queries = corpus.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    exact = {(r["query_id"], r["id"], r["rank"]) for r in knn(queries, corpus, 3).collect()}
    one = knn_lsh(queries, corpus, 3, bucket_length=1e9, tables=12, salts=1, group_rows=7)  # two buckets a table
    assert {(r["query_id"], r["id"], r["rank"]) for r in one.collect()} == exact


@pytest.mark.parametrize("size", [1e-9, 1.0, 1e9, 1e18])
def test_candidates_are_few_and_hold_the_nearest(size):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5000, 12)) * size
    x[100:140] = x[7]  # copies
    q = np.concatenate([x[:30], rng.normal(size=(30, 12)) * size])
    qi, ri = _Rows(list(range(len(x))), list(x), "l2").bound(q, 5)
    found, dist = set(zip(qi.tolist(), ri.tolist())), ((q[:, None] - x[None]) ** 2).sum(axis=2)
    for i, row in enumerate(np.sort(dist, axis=1)[:, 4]):
        assert {(i, j) for j in np.flatnonzero(dist[i] <= row).tolist()} <= found
    assert len(found) < 20 * len(q)


def test_pieces_are_passed_on_before_a_batch_is_done(monkeypatch):
    monkeypatch.setattr(retrieval, "PIECE_CHARS", 1000)
    texts = ["word " * 300, "", "short", "x" * 2500]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6, 7, 8]), pa.array(texts)], names=["id", "text"])
    made = list(retrieval._pieces(iter([batch]), 100, 10, SEPARATORS))
    assert len(made) >= 4 and max(sum(map(len, b.column(3).to_pylist())) for b in made) < 1100
    rows = [r for b in made for r in b.to_pylist()]
    for id_, text in zip((5, 6, 7, 8), texts):
        own = [(r["chunk_no"], r["start"], r["text"]) for r in rows if r["id"] == id_]
        assert own == [(n, a, text[a:b]) for n, (a, b) in enumerate(split_spans(text, 100, 10))]


def test_blocks_of_wide_vectors_have_fewer_rows(monkeypatch):
    monkeypatch.setattr(retrieval, "BLOCK_NUMBERS", 64)
    seen, rows = [], retrieval._Rows
    monkeypatch.setattr(retrieval, "_Rows", lambda ids, *a: seen.append(len(ids)) or rows(ids, *a))
    x = np.random.default_rng(1).normal(size=(40, 16))
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, a + 4)), pa.array(x[a : a + 4].tolist())], names=["id", "v"]) for a in range(0, 40, 4)]
    list(retrieval._search("l2", 2, pa.int64(), pa.int64(), lambda: [(0, x[3])])(iter(batches)))
    assert seen == [4] * 10


def test_many_queries_need_no_driver_and_little_memory(spark, vectors):
    _, corpus = vectors
    asked = spark.range(100_000).select(F.col("id").alias("query_id"), F.array(*[(F.col("id") % (7 + i)).cast("double") for i in range(8)]).alias("vector"))
    got = knn(asked, corpus, 2, max_bytes=0)
    assert got.count() == 200_000
    few = knn(asked.filter("query_id < 50"), corpus, 2)
    assert got.filter("query_id < 50").exceptAll(few).count() == 0


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(30, 16)) * 2
    x = (middles[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 16))).astype("float32")
    x[500:520] = x[0]
    return x, spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id bigint, vector array<float>").repartition(4)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_index_keeps_its_recall(spark, clustered, folder, metric):
    x, corpus = clustered
    build_index(corpus, folder, metric=metric, k=20, trials=100)
    index = load_index(spark, folder)
    assert index.rows.sum() == 3000 and 0 <= index.reach <= 1
    queries = corpus.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    found = search_index(queries, index, 20).collect()
    want = {q: brute(x, x[q], 20, metric) for q in range(0, 3000, 20)}
    hit = {(r["query_id"], r["id"]): r["distance"] for r in found}
    assert len(found) == len(hit) == 20 * 150
    right = [(q, i, d) for q, w in want.items() for i, d in w if (q, i) in hit]
    assert len(right) >= 0.9 * 20 * 150
    assert np.allclose([hit[q, i] for q, i, _ in right], [d for _, _, d in right], atol=1e-6)


def test_index_with_full_reach_is_exact(spark, clustered, folder):
    x, corpus = clustered
    index = build_index(corpus, folder, cells=9, codes=4, parts=3, sample=500, trials=10)
    index.reach = 1.0
    queries = corpus.filter("id % 100 = 0").withColumnRenamed("id", "query_id")
    found = {}
    for r in search_index(queries, index, 5, probes=1, part_rows=70).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["id"]
    assert {q: [f[i] for i in range(1, 6)] for q, f in found.items()} == {q: [i for i, _ in brute(x, x[q], 5, "l2")] for q in range(0, 3000, 100)}


@pytest.mark.parametrize("tight", [True, False])
def test_tiles_of_a_cell_lose_no_pair(tight):
    """Queries meet a cell in tiles: by its codes where these exclude most rows, otherwise by products with the vectors."""
    rng = np.random.default_rng(5)
    spots = rng.normal(size=(40, 6))
    x = (spots[rng.integers(0, 40, 900)] + 0.01 * rng.normal(size=(900, 6)) if tight else rng.normal(size=(900, 6))).astype(np.float32).astype(float)
    centre, books = np.zeros((1, 6)), spots.reshape(40, 2, 3).transpose(1, 0, 2)[:, : 40 if tight else 2]
    code = np.array([vector_index._nearest(x[:, 3 * p : 3 * p + 3], books[p])[0] for p in (0, 1)]).T.astype(np.uint8)
    error = np.sqrt(((books[np.arange(2), code].reshape(900, 6) - x) ** 2).sum(axis=1))
    index = vector_index.VectorIndex("", "l2", centre, np.array([9.0]), np.array([900]), books, 1.0, "id", "v")
    ids = rng.permutation(900).tolist()
    none = pa.nulls(900)
    held = pa.RecordBatch.from_arrays([none, none, none, none, pa.array(ids), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error), pa.array(x.tolist(), pa.list_(pa.float32()))], names=list("abcdefgh"))
    part = vector_index._Part(index, 0, ids, [held])
    queries = np.r_[x[:300], x[:1] + 1e20]
    gaps = np.sqrt(((queries[:, None] - part.rows.x[None]) ** 2).sum(axis=2))
    most = np.sort(gaps, axis=1)[:, 3]
    qi, ri = part.pairs(queries, most, 4)
    assert part.useful == tight and len(qi) < 0.2 * gaps.size
    assert set(zip(*np.nonzero(gaps <= most[:, None]))) <= set(zip(qi, ri))
    most[:300:3] = np.inf  # nothing is known of these yet: their four nearest
    qi, ri = part.pairs(queries, most, 4)
    assert set(zip(*np.nonzero(gaps <= np.sort(gaps, axis=1)[:, 3:4]))) <= set(zip(qi, ri))


def test_parts_of_cells_are_dealt_evenly():
    rows = np.array([5000, 0, 3, 900, 950, 1000, 1020, 10, 980, 990, 1, 1010])
    dealt = vector_index._dealt(rows, 1000, 4)
    assert [len(d) for d in dealt] == [5, 1, 1, 1, 1, 1, 2, 1, 1, 1, 1, 2]
    loads = np.zeros(4)
    for n, tasks in zip(rows, dealt):
        np.add.at(loads, tasks, n / len(tasks))
    assert loads.max() < 1.1 * loads.mean()
    assert vector_index._dealt(np.array([7]), 1000, 24) == [[0]]


def test_index_of_few_rows_and_gaps(spark, folder):
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, None), (4, [5.0, 5.0])]
    corpus = spark.createDataFrame(rows, "id int, vector array<float>")
    index = build_index(corpus, folder)
    asked = spark.createDataFrame([("q", [0.0, 0.9]), ("none", None)], "query_id string, vector array<float>")
    assert [(r["query_id"], r["id"], r["rank"]) for r in search_index(asked, index, 10).orderBy("rank").collect()] == [("q", 1, 1), ("q", 2, 2), ("q", 4, 3)]
    assert search_index(asked.limit(0), index, 3).count() == 0
    with pytest.raises(FileNotFoundError):
        load_index(spark, f"{folder}/nowhere")
    with pytest.raises(ValueError):
        build_index(corpus.limit(0), f"{folder}/empty")


def check_split(text, size, overlap):
    pieces = split_spans(text, size, overlap)
    done = 0
    for n, (a, b) in enumerate(pieces):
        assert a < b <= a + size and a <= done < b  # no gap, nothing twice but the overlap
        assert n == 0 or done - a <= overlap
        done = b
    assert done == len(text)
    ends = [{m.end() for m in re.finditer(p, text)} for p in SEPARATORS]
    for (a, b), (_, c) in zip(pieces, pieces[1:]):
        # a cut inside a word only where no boundary of any kind lies in the part that was too long
        if not any(b in e for e in ends):
            assert not any(max(a, b - size) < m < b and (b - m) >= size for m in ends[3])
    return pieces


def test_split_at_the_best_boundaries():
    text = "One two. Three four.\n\nFive six seven. Eight.\nNine ten\n\nx"
    assert [text[a:b] for a, b in check_split(text, 24, 0)] == ["One two. Three four.\n\n", "Five six seven. Eight.\n", "Nine ten\n\nx"]
    assert [text[a:b] for a, b in check_split(text, 14, 0)][:3] == ["One two. ", "Three four.\n\n", "Five six "]
    words = "aa bb cc dd ee ff"
    assert [words[a:b] for a, b in check_split(words, 9, 3)] == ["aa bb cc ", "cc dd ee ", "ee ff"]
    assert [b - a for a, b in check_split("z" * 25, 10, 0)] == [10, 10, 5]
    assert split_spans("", 10, 2) == []


def test_split_of_random_texts():
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(["word", "é", " ", " ", ". ", "\n", "\n\n", "longerword"]) for _ in range(rng.randrange(1, 200)))
        size = rng.randrange(2, 60)
        check_split(text, size, rng.randrange(0, size))


def test_split_text_on_rows(spark):
    long = "Sentence number one. " * 5000
    df = spark.createDataFrame([(1, long), (2, None), (3, ""), (4, "short"), (4, "short")], "k int, t string").withColumn("start", F.lit("clash"))
    got = split_text(df, "k", "t", 500, 50)
    assert got.columns == ["k", "chunk_no", "start", "text"]
    rows = got.filter("k = 1").orderBy("chunk_no").collect()
    assert [(r["start"], r["start"] + len(r["text"])) for r in rows] == split_spans(long, 500, 50)
    assert got.filter("k = 4").count() == 2 and got.filter("k IN (2, 3)").count() == 0
    with pytest.raises(ValueError):
        split_text(df, "k", "t", 5, 5)


@pytest.mark.parametrize("size,overlap", [(10, 3), (5, 0), (1000, 100)])
def test_chunks_reassemble(spark, size, overlap):
    texts = ["", "é1" * 4000, "a", "é" * 23, "0123456789", "x" * 10 + "y" * 7, "abcdefghijklmnopqrstuvwxyz" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    parts = {}
    for r in chunk(df, "k", "t", size, overlap).collect():
        parts.setdefault(r["k"], {})[r["chunk_no"]] = r["text"]
    assert 0 not in parts
    for k, t in enumerate(texts[1:], 1):
        got = [parts[k][i] for i in range(len(parts[k]))]
        assert got[0] + "".join(p[overlap:] for p in got[1:]) == t
        assert all(len(p) <= size for p in got) and all(len(p) > overlap for p in got[1:])
    with pytest.raises(ValueError):
        chunk(df, "k", "t", 5, 5)


def test_encoder(spark):
    df = spark.createDataFrame([(1, "apples and pears"), (2, "pears"), (3, "")], "k int, t string")
    got = {r["k"]: np.array(r["vector"]) for r in encode(df, "t", fit_encoder(df, "t", 64)).collect()}
    assert np.linalg.norm(got[1]) == pytest.approx(1, abs=1e-6) and not got[3].any() and len(got[2]) == 64
    own = encode(df, "t", lambda c: F.array(F.length(c).cast("float")), "v").orderBy("k").collect()
    assert [r["v"] for r in own] == [[16.0], [5.0], [0.0]]


def test_prompts(spark):
    docs = ["Paris is the capital of France. It is large.", "Rome is the capital of Italy. It is old.", "Bread needs flour. And water."]
    corpus = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "id int, text string")
    enc = fit_encoder(corpus, "text", 512)
    questions = spark.createDataFrame([(1, "capital of Italy"), (2, "flour for bread")], "question_id int, question string")
    made = {r["question_id"]: r["prompt"] for r in passage_prompts(questions, encode(corpus, "text", enc), enc, 2, "{context}\n\nQuestion: {question}").collect()}
    assert made[1].startswith(docs[1] + "\n\n" + docs[0]) and made[1].endswith("Question: capital of Italy")
    assert made[2].startswith(docs[2])


def test_stuff_prompt_orders_by_rank(spark):
    hits = spark.createDataFrame([(1, "q", 2, "second"), (1, "q", 1, "first")], "k int, question string, rank int, text string")
    assert stuff_prompt(hits, "k", "question", "{context}|{question}").first()["prompt"] == "first\n\nsecond|q"


def test_own_functions_keep_null(spark):
    def first(texts):
        return [t.split(".")[0] for t in texts]

    def closing(chats):
        return [f"{len(c)}: {c[-1]['content']}" for c in chats]

    df = spark.createDataFrame([(1, "One. Two."), (2, None)], "k int, t string")
    assert [r["generated_text"] for r in generate(df, "t", text_udf(first)).orderBy("k").collect()] == ["One", None]
    chats = spark.createDataFrame([([("user", "Hi. There")],), (None,)], "m array<struct<role:string,content:string>>")
    assert [r[0] for r in chats.select(chat_udf(closing)("m")).collect()] == ["1: Hi. There", None]


def test_html(spark):
    page = "<html><style>p{}</style><script>x<1</script><p>A &amp; B</p><!-- no --><b>C</b></html>"
    assert spark.createDataFrame([(page,)], "h string").select(html_text("h")).first()[0] == "A & B C"
