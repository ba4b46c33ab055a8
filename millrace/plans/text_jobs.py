"""Queries over chunks, vectors, search, prompts, batch generation and text classification."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import sql_bucket, sql_hash32
from millrace.functions.udfs import chat_udf, text_udf
from millrace.operators.aggregates import to_messages
from millrace.operators.latent import fit_latent, idf_weights, tfidf, token_slots
from millrace.operators.retrieval import (
    chunk,
    encode,
    fit_encoder,
    generate,
    knn,
    knn_lsh,
    load_vectors,
    save_vectors,
    passage_prompts,
    split_text,
    stuff_prompt,
)
from millrace.operators.splits import split
from millrace.operators.vector_index import build_index, load_index, search_index
from millrace.operators.textmodel import classify_text, fit_text_classifier, label_text
from millrace.plans.modeling import better_than_base
from millrace.plans.registry import query, table
from millrace.plans.relational import rounded
from millrace.session import cut_lineage, shared_dir
from millrace.sources.readers import load_documents

SIZE, OVERLAP = 1000, 100
SENTENCE = "^[^.!?]*[.!?]?"


@query(
    "chunk_documents",
    f"""SELECT doc_id, i::int AS chunk_no, substring(text, (i * {SIZE - OVERLAP} + 1)::bigint, {SIZE}) AS text FROM (
        SELECT doc_id, text, unnest(range(greatest(ceil((length(text) - {OVERLAP}) / {float(SIZE - OVERLAP)}), 1)::bigint)) AS i
        FROM documents WHERE length(text) > 0)""",
)
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk(table(spark, sf_dir, "documents"), "doc_id", "text", SIZE, OVERLAP)


@query("vector_roundtrip", "SELECT vec_id AS id, label, array_to_string(list_transform(embedding, lambda x: round(x::double * 100000)::bigint::varchar), ',') AS vector FROM embeddings")
def vector_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "vectors")
    save_vectors(vectors(spark, sf_dir), path)
    text = F.transform("vector", lambda x: F.round(x.cast("double") * 100000).cast("bigint").cast("string"))
    return load_vectors(spark, path).select("id", "label", F.array_join(text, ",").alias("vector"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def asking(corpus: DataFrame) -> DataFrame:
    """The queries of every search: all rows whose id is divisible by 20."""
    return corpus.filter("id % 20 = 0").select(F.col("id").alias("query_id"), "vector")


_ASKED_SQL = "WITH q AS (SELECT vec_id AS query_id, embedding::double[] AS qv FROM embeddings WHERE vec_id % 20 = 0)"


def _knn_sql(distance: str, k: int) -> str:
    return f"""SELECT query_id, vec_id AS id, round({distance}, 5) AS distance, row_number() OVER (PARTITION BY query_id
        ORDER BY {distance}, vec_id)::int AS rank FROM q, (SELECT vec_id, embedding::double[] AS v FROM embeddings)
        QUALIFY rank <= {k}"""


@query(
    "knn_exact",
    f"""{_ASKED_SQL} SELECT 'l2' AS metric, * FROM ({_knn_sql('list_distance(qv, v)', 4)}) UNION ALL
          SELECT 'cosine', * FROM ({_knn_sql('list_cosine_distance(qv, v)', 5)})""",
)
def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest rows of every query row, itself among them, by both metrics."""
    corpus = vectors(spark, sf_dir)
    l2 = knn(asking(corpus), corpus, 4, "l2").withColumn("metric", F.lit("l2"))
    cosine = knn(asking(corpus), corpus, 5, "cosine").withColumn("metric", F.lit("cosine"))
    # the cosine distance of a vector to itself is zero up to rounding, of either sign
    return rounded(l2.unionByName(cosine), distance=5).withColumn("distance", F.col("distance") + F.lit(0.0))


def _recalled(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``(query_id, n, recalled)``: rows found for each query, and whether nine tenths of all exact neighbours are among them."""
    found, exact = cut_lineage(found), exact.select("query_id", "id", F.lit(1).alias("hit"))
    share = exact.join(found.select("query_id", "id", F.lit(1).alias("got")), ["query_id", "id"], "left").agg(F.sum("got") / F.count(F.lit(1))).first()[0]
    return found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).withColumn("recalled", F.lit((share or 0.0) >= 0.9))


def _recalled_sql(k: int) -> str:
    return f"SELECT vec_id AS query_id, least({k}, (SELECT count(*) FROM embeddings))::bigint AS n, true AS recalled FROM embeddings WHERE vec_id % 20 = 0"


@query("knn_lsh", _recalled_sql(4))
def knn_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four rows by projection buckets for every query row, measured against the exact search."""
    corpus = vectors(spark, sf_dir)
    return _recalled(knn_lsh(asking(corpus), corpus, 4, bucket_length=0.5, tables=6), knn(asking(corpus), corpus, 4))


@query("vector_index_search", _recalled_sql(20))
def vector_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of all rows, stored and loaded again, asked for the twenty neighbours of every query row."""
    corpus, path = vectors(spark, sf_dir), shared_dir(spark, "vector-index")
    build_index(corpus, path, k=20)
    return _recalled(search_index(asking(corpus), load_index(spark, path), 20), knn(asking(corpus), corpus, 20))


@query("split_documents", "SELECT doc_id, md5(text) AS restored, length(text)::bigint AS n_chars, true AS fits FROM documents WHERE length(text) > 0")
def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents split at text boundaries; put together again the pieces are the documents, and none is too long."""
    made = split_text(table(spark, sf_dir, "documents"), "doc_id", "text", SIZE, OVERLAP)
    piece = F.struct("chunk_no", "start", "text")
    whole = F.aggregate(
        F.array_sort(F.collect_list(piece)), F.lit(""), lambda t, p: F.concat(t, F.substring(p["text"], F.length(t) - p["start"] + 1, F.length(p["text"])))
    )
    found = made.groupBy("doc_id").agg(whole.alias("t"), (F.max(F.length("text")) <= SIZE).alias("fits"))
    return found.select("doc_id", F.md5(F.col("t").cast("binary")).alias("restored"), F.length("t").cast("long").alias("n_chars"), "fits")


@query(
    "tfidf_encode",
    r"""SELECT doc_id, CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0 ELSE 0.0 END::double AS length FROM documents""",
)
def tfidf_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of every encoded document: one, or zero for a text without tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = encode(docs, "text", fit_encoder(docs, "text"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return made.select("doc_id", F.round(F.sqrt(square), 4).alias("length"))


SLOTS = 1024
_SLOTS_SQL = f"""
  WITH t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')) AS token FROM documents),
  c AS (SELECT doc_id, {sql_hash32('token', 'slot')} % {SLOTS} AS slot, count(*) AS tf FROM t GROUP BY ALL),
  i AS (SELECT slot, ln((SELECT count(*) + 1 FROM documents) / (count(*) + 1)::double) AS idf FROM c GROUP BY 1),
  w AS (SELECT doc_id, tf * idf AS w FROM c JOIN i USING (slot))
"""


@query(
    "tfidf_weights",
    _SLOTS_SQL + "SELECT doc_id, count(*) AS n_slots, round(sum(w) / sqrt(sum(w * w)), 6) AS total, round(max(w) / sqrt(sum(w * w)), 6) AS most FROM w GROUP BY 1",
)
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights of every document's unit-length row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = tfidf(docs, "doc_id", "text", idf_weights(docs, "text", SLOTS))
    found = rows.groupBy("doc_id").agg(F.count("*").alias("n_slots"), F.sum("weight").alias("total"), F.max("weight").alias("most"))
    return rounded(found, total=6, most=6)


@query("latent_encode", r"SELECT doc_id, regexp_matches(text, '[\p{L}\p{N}]') AS placed, true AS fits FROM documents")
def latent_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sixteen latent numbers: at the origin exactly if they have no token, never longer than their unit row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fit_latent(docs, "text", SLOTS, rank=16).encode(docs, "text")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return made.select("doc_id", (length > 1e-6).alias("placed"), (length <= 1 + 1e-5).alias("fits"))


PROMPT = "Answer from these passages alone and say so if they hold no answer.\n\n{context}\n\nQuestion: {question}\n\nAnswer:\n"


@query(
    "prompt_build",
    f"""WITH r AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC)::int AS rank FROM conversations
          WHERE role <> 'system'),
        c AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context FROM r WHERE rank <= 3 GROUP BY 1),
        q AS (SELECT conv_id, first(text ORDER BY turn) AS question FROM conversations WHERE role = 'user' GROUP BY 1)
        SELECT conv_id, question, '{PROMPT.split('{context}')[0]}' || context ||
          chr(10) || chr(10) || 'Question: ' || question || chr(10) || chr(10) || 'Answer:' || chr(10) AS prompt
        FROM c JOIN q USING (conv_id)""",
)
def prompt_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three last turns of each conversation as context for its first user question."""
    turns = table(spark, sf_dir, "conversations")
    first = turns.filter("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("question"))
    # the order of a conversation is its turn number, so the last turns are those above max(turn) - 3
    spoken = turns.filter("role <> 'system'")
    last = spoken.groupBy("conv_id").agg(F.max("turn").alias("top"))
    hits = (
        spoken.join(last, "conv_id").filter(F.col("turn") > F.col("top") - 3)
        .select("conv_id", (F.col("top") - F.col("turn") + 1).alias("rank"), "text")
        .join(first, "conv_id")
    )
    return stuff_prompt(hits, "conv_id", "question", PROMPT)


def longest_sentence(texts: list[str]) -> list[str]:
    """An extractive answer: the longest stretch without a full stop, exclamation or question mark, the first of equals."""
    return [max(re.findall(r"[^.!?]+", t), key=len, default="") for t in texts]


def last_words(chats: list[list[dict]]) -> list[str]:
    """How many messages each role has, and the first sentence of the last message."""
    out = []
    for chat in chats:
        said = Counter(m["role"] for m in chat)
        counts = ", ".join(f"{r}: {n}" for r, n in sorted(said.items()))
        out.append(f"{counts}; {re.match(SENTENCE, chat[-1]['content'] or '').group(0)}")
    return out


@query(
    "batch_generate",
    """SELECT doc_id, coalesce((SELECT s FROM (SELECT unnest(regexp_extract_all(text, '[^.!?]+')) AS s,
         generate_subscripts(regexp_extract_all(text, '[^.!?]+'), 1) AS i) ORDER BY length(s) DESC, i LIMIT 1), CASE WHEN text IS NOT NULL THEN '' END) AS generated_text
       FROM documents""",
)
def batch_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch function of texts as a column function, over every document."""
    return generate(table(spark, sf_dir, "documents"), "text", text_udf(longest_sentence)).select("doc_id", "generated_text")


@query(
    "batch_chat",
    """WITH r AS (SELECT conv_id, turn // 64 AS segment, role, count(*) AS n FROM conversations GROUP BY ALL),
       c AS (SELECT conv_id, segment, string_agg(role || ': ' || n, ', ' ORDER BY role) AS counts FROM r GROUP BY ALL),
       l AS (SELECT conv_id, turn // 64 AS segment, regexp_extract(arg_max(text, turn), '^[^.!?]*[.!?]?') AS last FROM conversations GROUP BY ALL)
       SELECT conv_id, segment, counts || '; ' || last AS generated_text FROM c JOIN l USING (conv_id, segment)""",
)
def batch_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch function of chats as a column function, over the messages of every conversation, stored in segments of 64 turns."""
    chats = to_messages(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", per_segment=64)
    return chats.select("conv_id", "segment", chat_udf(last_words)("messages").alias("generated_text"))


@query("batch_qa", "SELECT item_id AS question_id, text AS question, true AS framed FROM benchmark")
def batch_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieval question answering up to the prompt: pages and documents -> chunks, stored -> vectors,
    stored; every benchmark text is a question, and its two nearest chunks are the passages of its prompt."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    pages = load_documents(table(spark, sf_dir, "pages"), "page_id", "html")
    pages = pages.withColumn("doc_id", F.concat(F.lit("p"), F.col("doc_id").cast("string")))
    pieces = chunk(docs.unionByName(pages), "doc_id", "text", SIZE, OVERLAP)
    pieces = pieces.select(F.concat_ws(":", "doc_id", F.col("chunk_no").cast("string")).alias("id"), "text")
    chunks = shared_dir(spark, "qa-chunks")
    pieces.write.parquet(chunks)  # fitting and encoding both read the chunks
    pieces = spark.read.parquet(chunks)
    encoder = fit_encoder(pieces, "text")
    path = shared_dir(spark, "qa-vectors")
    save_vectors(encode(pieces, "text", encoder), path)
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    made = passage_prompts(questions, load_vectors(spark, path), encoder, 2, PROMPT)
    start, end = PROMPT.split("{context}")
    frame = F.startswith("prompt", F.lit(start)) & F.endswith("prompt", F.concat(F.lit(end.split("{question}")[0]), "question", F.lit(end.split("{question}")[1])))
    longer = F.length("prompt") > len(start) + len(end) + F.length("question")  # passages were found
    return made.select("question_id", "question", (frame & longer).alias("framed"))


BITS = 64


def presence(text: Column) -> Column:
    """Which of 64 token slots a text has, as a vector that any SQL engine can repeat."""
    every = F.sequence(F.lit(0), F.lit(BITS - 1))
    # the slots are bound to a name, or they would be computed for every bit
    return F.transform(F.array(token_slots(text, BITS)), lambda s: F.transform(every, lambda i: F.array_contains(s, i).cast("float")))[0]


def _slots_sql(text: str) -> str:
    words = f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
    return f"list_distinct(list_transform({words}, lambda x: {sql_hash32('x', 'slot')} % {BITS}))"


_BITS_SQL = f"list_transform(range({BITS}), lambda i: list_contains(s, i)::int::double)"


@query(
    "qa_passages",
    f"""WITH c AS (SELECT 'd' || doc_id || ':' || i AS id, substring(text, (i * {SIZE - OVERLAP} + 1)::bigint, {SIZE}) AS text FROM (
          SELECT doc_id, text, unnest(range(greatest(ceil((length(text) - {OVERLAP}) / {float(SIZE - OVERLAP)}), 1)::bigint)) AS i
          FROM documents WHERE length(text) > 0)),
        cs AS MATERIALIZED (SELECT id, text, {_slots_sql('text')} AS s FROM c),
        v AS MATERIALIZED (SELECT id, text, {_BITS_SQL} AS v FROM cs),
        qs AS MATERIALIZED (SELECT item_id, {_slots_sql('text')} AS s FROM benchmark),
        q AS MATERIALIZED (SELECT item_id, {_BITS_SQL} AS qv FROM qs),
        d AS (SELECT item_id, id, text, round(pow(list_distance(qv, v), 2))::int AS apart FROM q, v)
        SELECT item_id AS question_id, row_number() OVER (PARTITION BY item_id ORDER BY apart, id)::int AS rank, id, apart, md5(text) AS passage
        FROM d QUALIFY rank <= 2""",
)
def qa_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of every benchmark question: chunks, vectors, stored, searched; ids, ranks and texts."""
    pieces = chunk(table(spark, sf_dir, "documents"), "doc_id", "text", SIZE, OVERLAP)
    pieces = pieces.select(F.concat(F.lit("d"), "doc_id", F.lit(":"), "chunk_no").alias("id"), "text")
    path = shared_dir(spark, "qa-passages")
    save_vectors(encode(pieces, "text", presence), path)
    corpus = load_vectors(spark, path)
    asked = encode(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), "text"), "text", presence)
    hits = knn(asked, corpus, 2, query_id="question_id")
    apart = F.round(F.col("distance") * F.col("distance")).cast("int").alias("apart")
    return corpus.select("id", "text").join(hits, "id").select("question_id", "rank", "id", apart, F.md5(F.col("text").cast("binary")).alias("passage"))


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label their text explains: whether they are in English."""
    docs = table(spark, sf_dir, "documents").filter(F.col("lang").isNotNull())
    return docs.select("doc_id", "text", (F.col("lang") == "en").cast("int").alias("label"))


@query(
    "text_classifier",
    f"""SELECT count(*) AS n, round(greatest(avg((lang = 'en')::int), 1 - avg((lang = 'en')::int)), 6) AS base, true AS good FROM documents
        WHERE lang IS NOT NULL AND {sql_bucket('doc_id', 42, 10000)} >= 8000""",
)
def text_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy on held-out whole texts is at least 0.2 above that of the larger class."""
    train, test = split(labelled_text(spark, sf_dir), "doc_id", [0.8, 0.2])
    return better_than_base(classify_text(test, fit_text_classifier(train, "text", "label"), "text"), "label", "prediction", 0.2)


@query("text_labels", "SELECT doc_id, true AS labelled, true AS good FROM documents WHERE lang IS NOT NULL")
def text_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document labelled by a classifier trained on four fifths of them; nineteen of twenty labels are right."""
    docs = labelled_text(spark, sf_dir)
    train, _ = split(docs, "doc_id", [0.8, 0.2])
    made = cut_lineage(label_text(docs, fit_text_classifier(train, "text", "label"), "text").select("doc_id", "label", "sentiment"))
    right = made.agg(F.avg(((F.col("sentiment") == "Positive") == (F.col("label") == 1)).cast("double"))).first()[0]
    return made.select("doc_id", F.col("sentiment").isin("Positive", "Negative").alias("labelled"), F.lit((right or 0.0) >= 0.95).alias("good"))
