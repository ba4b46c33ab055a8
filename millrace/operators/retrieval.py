"""Chunking, encoding, nearest-neighbour search and batch question answering over tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, BucketedRandomProjectionLSH, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.functions.columns import fill_template
from millrace.operators.features import tokenize
from millrace.session import cut_lineage, shared_dir, sized_broadcast, spread

CHUNKS_PER_SPAN = 256
PIECE_CHARS = 1 << 21  # characters of pieces a task holds at once, besides the batch it was given
BLOCK_NUMBERS = 1 << 21  # numbers in the vectors a task holds at once: 16 MB as doubles
TILE_CELLS = 1 << 21  # distances a task holds at once: 8 MB as floats


def chunk(df: DataFrame, id_: str, text: str, size: int = 1000, overlap: int = 100) -> DataFrame:
    """``(id, chunk_no, text)``: windows of ``size`` characters that share ``overlap`` with the next, to
    the end of the text; empty texts give no chunk.  A projection."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    n = F.greatest(F.ceil((F.length(text) - overlap) / step), F.lit(1)).cast("int")
    # finding a position scans a string from its start: cutting spans first and chunks from the spans
    # keeps very long texts from costs that grow with the square of their length
    spans = F.sequence(F.lit(0), F.ceil(n / CHUNKS_PER_SPAN).cast("int") - 1)

    def cut(b):
        span = F.substring(F.col(text), b * (CHUNKS_PER_SPAN * step) + 1, F.lit(CHUNKS_PER_SPAN * step + overlap))
        inner = F.sequence(F.lit(0), F.least(F.lit(CHUNKS_PER_SPAN), n - b * CHUNKS_PER_SPAN) - 1)
        return F.flatten(F.transform(F.array(span), lambda s: F.transform(inner, lambda i: F.substring(s, i * step + 1, F.lit(size)))))

    pieces = F.flatten(F.transform(spans, cut))
    return df.filter(F.length(text) > 0).select(id_, text).select(id_, F.posexplode(pieces).alias("chunk_no", "text"))


#: Where a text may be cut, the best places first: after a blank line, a line, a sentence, a blank.
SEPARATORS = (r"\n\s*\n", r"\n", r"[.!?]+\s+", r"\s+")


def split_spans(text: str, size: int, overlap: int, separators: tuple[str, ...] = SEPARATORS) -> list[tuple[int, int]]:
    """The pieces of a text as (start, end): each as long as fits ``size``, cut at the best separators there are.

    A stretch longer than ``size`` is split after every match of the first separator, its parts that are still too long by
    the next one, and so on, in the end anywhere.  The parts are then merged in order up to ``size``; a piece begins with the
    last parts of the one before, up to ``overlap`` characters, if they fit together with what follows.
    """
    parts = [(0, len(text))]
    for pattern in map(re.compile, separators):
        finer = []
        for a, b in parts:
            cuts = [m.end() for m in pattern.finditer(text, a, b)] if b - a > size else []
            edges = [a, *(c for c in cuts if c < b), b]
            finer += zip(edges, edges[1:])
        parts = finer
    parts = [(at, min(at + size, b)) for a, b in parts for at in range(a, b, size)]
    pieces, first = [], 0
    for i, (_, end) in enumerate(parts):
        if end - parts[first][0] > size:
            pieces.append((parts[first][0], parts[i - 1][1]))
            while parts[i - 1][1] - parts[first][0] > overlap or (first < i and end - parts[first][0] > size):
                first += 1
                if first == i:
                    break
    if parts:
        pieces.append((parts[first][0], parts[-1][1]))
    return pieces


def split_text(df: DataFrame, id_: str, text: str, size: int = 1000, overlap: int = 100, separators: tuple[str, ...] = SEPARATORS) -> DataFrame:
    """``(id, chunk_no, start, text)``: pieces of whole texts cut at text boundaries, see ``split_spans``.

    ``start`` counts characters from 0; put together from there on, the pieces are the text again.  NULL and empty texts give
    no piece.  A projection in Arrow batches, linear in the length of a text."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")

    rows = df.filter(F.length(text) > 0).select(id_, F.col(text).cast("string").alias(text))
    schema = f"`{id_}` {rows.schema[id_].dataType.simpleString()}, chunk_no int, start long, text string"
    return rows.mapInArrow(lambda b: _pieces(b, size, overlap, separators), schema)


def _pieces(batches: Iterator[pa.RecordBatch], size: int, overlap: int, separators: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, chunk_no, start, text); pieces are passed on whenever ``PIECE_CHARS`` characters of them are held."""
    for batch in batches:
        held, row, number, start, pieces = 0, [], [], [], []

        def made() -> pa.RecordBatch:
            cols = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(pieces, pa.string())]
            return pa.RecordBatch.from_arrays(cols, names=[batch.schema.names[0], "chunk_no", "start", "text"])

        for i, text in enumerate(batch.column(1)):
            t = text.as_py()
            for n, (a, b) in enumerate(split_spans(t, size, overlap, separators)):
                row.append(i)
                number.append(n)
                start.append(a)
                pieces.append(t[a:b])
                held += b - a
                if held >= PIECE_CHARS:
                    yield made()
                    held, row, number, start, pieces = 0, [], [], [], []
        if row:
            yield made()


def fit_encoder(df: DataFrame, text: str, dims: int = 256) -> PipelineModel:
    """TF-IDF over hashed tokens, scaled to unit length; fitting is one aggregation of size ``dims``."""
    counts = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=dims)
    stages = [counts, IDF(inputCol="tf", outputCol="tfidf"), Normalizer(inputCol="tfidf", outputCol="unit")]
    return Pipeline(stages=stages).fit(tokenize(spread(df), text, "tokens"))


def encode(df: DataFrame, text: str, encoder: PipelineModel | Callable, out: str = "vector") -> DataFrame:
    """Add ``array<float>``: by a fitted encoder, or by any column function of the text."""
    if not isinstance(encoder, PipelineModel):
        return df.withColumn(out, encoder(F.col(text)))
    made = encoder.transform(tokenize(df, text, "tokens"))
    return made.withColumn(out, vector_to_array("unit", "float32")).drop("tokens", "tf", "tfidf", "unit")


def save_vectors(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_vectors(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _top_k(q: np.ndarray, d: np.ndarray, ids: np.ndarray, k: int):
    order = np.lexsort((ids, d, q))
    q, d, ids = q[order], d[order], ids[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    keep = rank < k
    return q[keep], d[keep], ids[keep]


class _Rows:
    """The corpus rows of one group."""

    def __init__(self, ids: list, vectors: list[np.ndarray], metric: str):
        order = sorted(range(len(ids)), key=ids.__getitem__)
        self.ids = np.empty(len(ids), object)
        self.ids[:] = [ids[i] for i in order]
        self.x = _scaled(np.array([vectors[i] for i in order], dtype=float), metric)
        norms = (self.x**2).sum(axis=1)
        self.far = float(np.sqrt(norms.max()))
        # single precision finds candidates where its range suffices
        self.kind = np.float32 if self.far == 0 or 1e-15 < self.far < 1e15 else np.float64
        self.near = np.column_stack([self.x, norms]).astype(self.kind)  # times (-2q, 1): squared distance less that of q from 0

    def _products(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squared distances less those of the queries from 0, rounded; the queries' lengths, and by how much rounding may be off."""
        size = np.sqrt((queries**2).sum(axis=1))
        kind, near = self.kind, self.near
        if size.max(initial=0.0) >= 1e15 and kind == np.float32:
            kind, near = np.float64, np.column_stack([self.x, (self.x**2).sum(axis=1)])
        cells = np.column_stack([-2 * queries, np.ones(len(queries))]).astype(kind) @ near.T
        return cells, size, 8 * float(np.finfo(kind).eps) * (self.x.shape[1] + 8) * self.far * (size + self.far)

    def within(self, queries: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all pairs that may be at most ``most`` of the query apart, from rounded products."""
        cells, size, slack = self._products(queries)
        limit = (most - size) * (most + size) + slack + 1e-14 * (most**2 + size**2)
        return np.nonzero(cells <= np.nextafter(limit.astype(cells.dtype), cells.dtype.type(np.inf))[:, None])

    def bound(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all pairs that may be among a query's ``k`` nearest, from rounded products.

        Rows stand in short columns, and only the least distance of each column is ranked: the k-th of them bounds the k-th
        nearest row, so the other rows of a column are looked at only if its least distance is within the bound."""
        n = len(self.x)
        deep = max(1, min(64, n // (4 * k)))
        wide = n // deep
        cells, _, slack = self._products(queries)
        tall = cells[:, : deep * wide].reshape(len(queries), deep, wide)
        least = np.concatenate([tall.min(axis=1), cells[:, deep * wide :]], axis=1)  # the last rows are columns of their own
        at = min(k, least.shape[1]) - 1
        limit = np.partition(least, at, axis=1)[:, at].astype(float) + slack
        qi, column = np.nonzero(least <= limit[:, None])
        alone = column >= wide
        qa, ra = qi[alone], column[alone] - wide + deep * wide
        qi, column = qi[~alone], column[~alone]
        pair, depth = np.nonzero(tall[qi, :, column] <= limit[qi][:, None])
        return np.r_[qi[pair], qa], np.r_[depth * wide + column[pair], ra]


def _square_gap(a: np.ndarray, b: np.ndarray, ai: np.ndarray, bi: np.ndarray) -> np.ndarray:
    """Squared distances of rows ``ai`` of ``a`` from rows ``bi`` of ``b``, some pairs at a time."""
    out, step = np.empty(len(ai)), max(1, BLOCK_NUMBERS // max(1, a.shape[1]))
    for at in range(0, len(ai), step):
        gap = a[ai[at : at + step]] - b[bi[at : at + step]]
        out[at : at + step] = (gap * gap).sum(axis=1)
    return out


def _scaled(x: np.ndarray, metric: str) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) if metric == "cosine" else x


def _search(metric: str, k: int, id_type: pa.DataType, q_type: pa.DataType, here: Callable[[], list] | None = None, block_rows: int = 1 << 16):
    """Arrow batches ``(grp, query, id, qid, v)`` sorted by group, corpus rows first -> the k best
    ``(qid, id, distance)`` of every query in every group.  Queries are measured tile by tile.

    With ``here``, which gives the queries, the batches are ``(id, v)`` of the corpus and every ``block_rows`` are a group."""

    def measured(rows: _Rows, tile: list) -> pa.RecordBatch:
        queries = _scaled(np.array([v for _, v in tile], dtype=float), metric)
        qi, ri = rows.bound(queries, k)  # products find the candidates, rounding allowed for; their distances are then taken exactly
        dist = _square_gap(queries, rows.x, qi, ri)
        qi, dist, ri = _top_k(qi, dist / 2 if metric == "cosine" else np.sqrt(dist), ri, k)  # rows stand by id
        return pa.RecordBatch.from_arrays(
            [pa.array([tile[i][0] for i in qi], q_type), pa.array(list(rows.ids[ri]), id_type), pa.array(dist)],
            names=["_qid", "_id", "distance"],
        )

    def run(batches):
        group, rows, ids, vectors, tile = None, None, [], [], []
        for batch in batches:
            flat, ends = batch.column(4).flatten().to_numpy(zero_copy_only=False), batch.column(4).offsets.to_numpy()
            ends = ends - ends[0]
            for i, (g, asks, id_, qid) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                if g != group:
                    if tile and rows is not None:
                        yield measured(rows, tile)
                    group, rows, ids, vectors, tile = g, None, [], [], []
                v = flat[ends[i] : ends[i + 1]]
                if not asks:
                    ids.append(id_)
                    vectors.append(v)
                    continue
                if rows is None and ids:
                    rows, vectors = _Rows(ids, vectors, metric), []
                if rows is not None:
                    tile.append((qid, v))
                    if len(tile) * len(ids) >= TILE_CELLS:
                        yield measured(rows, tile)
                        tile = []
        if tile and rows is not None:
            yield measured(rows, tile)

    def scan(batches):
        ids, vectors = [], []

        def block() -> Iterator[pa.RecordBatch]:
            rows, queries = _Rows(ids, vectors, metric), here()
            step = max(1, TILE_CELLS // len(ids))
            for at in range(0, len(queries), step):
                yield measured(rows, queries[at : at + step])

        for batch in batches:
            flat, ends = batch.column(1).flatten().to_numpy(zero_copy_only=False), batch.column(1).offsets.to_numpy()
            if not batch.num_rows:
                continue
            ids += batch.column(0).to_pylist()
            vectors += np.split(flat, (ends - ends[0])[1:-1])
            if len(ids) >= block_rows or len(ids) * len(vectors[0]) >= BLOCK_NUMBERS:
                yield from block()
                ids, vectors = [], []
        if ids:
            yield from block()

    return scan if here else run


def _ranked(found: DataFrame, k: int, query_id: str, corpus_id: str) -> DataFrame:
    w = Window.partitionBy("_qid").orderBy("distance", "_id")
    return (
        found.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(F.col("_qid").alias(query_id), F.col("_id").alias(corpus_id), "distance", "rank")
    )


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str = "l2",
    query_id: str = "query_id",
    corpus_id: str = "id",
    vector: str = "vector",
    group_rows: int = 1 << 16,
    max_bytes: int = 16 << 20,
) -> DataFrame:
    """Exact ``k`` nearest corpus rows of every query: ``(query_id, id, distance, rank)``, ties by id.

    Queries proven to take at most ``max_bytes`` are sent to the tasks that scan the corpus, whose rows do not move.  More
    queries meet the corpus in groups: its rows are dealt by a digest of their id, about ``group_rows`` to a group, and every
    query goes to every group.  Either way a task holds the vectors of one group and streams the queries past in tiles of
    ``TILE_CELLS`` distances, so memory depends on neither table's size.  k rows per query and group meet in the ranking.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    queries = queries.select(F.col(query_id).alias("_qid"), F.col(vector).cast("array<double>").alias("_v")).filter("_v IS NOT NULL")
    shape = queries.agg(F.max(F.size("_v")).alias("d"), F.min(F.size("_v")).alias("lo")).first()
    if shape["d"] != shape["lo"]:
        raise ValueError("query vectors differ in length")
    base = corpus.select(F.col(corpus_id).alias("_id"), F.col(vector).cast("array<double>").alias("_v")).filter("_v IS NOT NULL")
    id_type, q_type = base.schema["_id"].dataType, queries.schema["_qid"].dataType
    found = f"_qid {q_type.simpleString()}, _id {id_type.simpleString()}, distance double"
    kinds = (to_arrow_type(id_type), to_arrow_type(q_type))
    spark, path = queries.sparkSession, shared_dir(queries.sparkSession, "queries")
    queries.write.parquet(path)
    queries = spark.read.schema(queries.schema).parquet(path)
    if int(str(queries._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= max_bytes // 4:  # compressed on disk
        few = queries.toArrow()
        vectors = [np.asarray(v.values, dtype=float) for v in few.column("_v")]
        sent = spark.sparkContext.broadcast(list(zip(few.column("_qid").to_pylist(), vectors)))
        return _ranked(base.mapInArrow(_search(metric, k, *kinds, lambda: sent.value, group_rows), found), k, query_id, corpus_id)
    group_rows = max(1, min(group_rows, 2 * BLOCK_NUMBERS // max(1, shape["d"] or 1)))
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-base.count() // group_rows))
    rows = base.select(
        F.pmod(F.xxhash64("_id"), F.lit(groups)).cast("int").alias("_g"), F.lit(False).alias("_asks"), "_id", F.lit(None).cast(q_type).alias("_qid"), "_v"
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_g"), F.lit(True).alias("_asks"), F.lit(None).cast(id_type).alias("_id"), "_qid", "_v"
    )
    met = rows.unionByName(asked).repartitionById(groups, F.col("_g")).sortWithinPartitions("_g", "_asks")
    return _ranked(met.mapInArrow(_search(metric, k, *kinds), found), k, query_id, corpus_id)


def knn_lsh(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    bucket_length: float = 1.0,
    tables: int = 4,
    seed: int = 42,
    query_id: str = "query_id",
    corpus_id: str = "id",
    vector: str = "vector",
    salts: int = 8,
    group_rows: int = 1 << 16,
) -> DataFrame:
    """Approximate search: a query is measured against the corpus rows that share a random-projection
    bucket with it.  Corpus rows of a bucket are dealt to ``salts`` parts (more if a part would get more than
    ``group_rows``) and its queries copied to each, so a crowded bucket is several groups; a task measures the tiles of a
    group as ``knn`` does, and k rows per query and group meet in the ranking, so no pair is a row.  Queries whose buckets
    hold fewer than ``k`` rows are answered exactly by ``knn``, so every query gets k rows if the corpus has them."""
    lsh = BucketedRandomProjectionLSH(inputCol="_vec", outputCol="_hash", bucketLength=bucket_length, numHashTables=tables, seed=seed)
    with_vec = lambda df: df.withColumn("_vec", array_to_vector(F.col("_v")))
    q = with_vec(queries.select(F.col(query_id).alias("_qid"), F.col(vector).cast("array<double>").alias("_v")).filter("_v IS NOT NULL"))
    c = with_vec(corpus.select(F.col(corpus_id).alias("_id"), F.col(vector).cast("array<double>").alias("_v")).filter("_v IS NOT NULL"))
    if q.isEmpty():
        return knn(queries, corpus, k, "l2", query_id, corpus_id, vector)
    model = lsh.fit(q)
    salts = max(salts, -(-c.count() // group_rows))
    id_type, q_type = c.schema["_id"].dataType, q.schema["_qid"].dataType

    def buckets(df: DataFrame, salt) -> DataFrame:
        places = F.transform("_hash", lambda h, i: F.concat_ws(":", i, vector_to_array(h)[0].cast("bigint")))
        placed = model.transform(df).withColumn("_b", F.explode(places)).withColumn("_salt", salt)
        return placed.withColumn("_g", F.concat_ws(":", "_b", "_salt"))

    rows = buckets(c, F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int"))
    rows = rows.select("_g", F.lit(False).alias("_asks"), "_id", F.lit(None).cast(q_type).alias("_qid"), "_v")
    asked = buckets(q, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    asked = asked.select("_g", F.lit(True).alias("_asks"), F.lit(None).cast(id_type).alias("_id"), "_qid", "_v")
    met = rows.unionByName(asked).repartition("_g").sortWithinPartitions("_g", "_asks")
    found = f"_qid {q_type.simpleString()}, _id {id_type.simpleString()}, distance double"
    hits = met.mapInArrow(_search("l2", k, to_arrow_type(id_type), to_arrow_type(q_type)), found)
    near = cut_lineage(_ranked(hits.distinct(), k, query_id, corpus_id))
    full = near.groupBy(query_id).count().filter(F.col("count") >= k)
    rest = queries.join(full, query_id, "left_anti")
    return near.join(full.select(query_id), query_id, "left_semi").unionByName(knn(rest, corpus, k, "l2", query_id, corpus_id, vector))


def stuff_prompt(hits: DataFrame, question_id: str, question: str, template: str, text: str = "text", out: str = "prompt") -> DataFrame:
    """One prompt per question: its k passages in rank order joined by blank lines, put into ``template``
    (slots ``{context}`` and ``{question}``)."""
    item = F.struct(F.col("rank").alias("r"), F.col(text).alias("t"))
    packed = hits.groupBy(question_id, question).agg(F.array_sort(F.collect_list(item)).alias("_l"))  # k items each
    packed = packed.withColumn("context", F.concat_ws("\n\n", F.transform("_l", lambda x: x["t"])))
    return fill_template(packed, template, {"context": "context", "question": question}, out).drop("_l", "context")


def generate(df: DataFrame, text: str, generator: Callable, out: str = "generated_text") -> DataFrame:
    """Add what ``generator``, a column function, makes of the text; ``text_udf`` and ``chat_udf`` wrap a
    batch function of your own model as one."""
    return df.withColumn(out, generator(F.col(text)))


def passage_prompts(
    questions: DataFrame,
    corpus: DataFrame,
    encoder: PipelineModel | Callable,
    k: int,
    template: str,
    question_id: str = "question_id",
    question: str = "question",
    metric: str = "l2",
) -> DataFrame:
    """Prompts for a table of questions: encode, search, assemble, as one job: ``(question_id, question,
    prompt)``.  Apply ``generate`` with your model to the prompts.

    ``corpus`` holds ``(id, text, vector)``; search reads ids and vectors.  The hits, k per question, are
    stored, and sent to the scan of the texts if they are proven small."""
    asked = encode(questions.select(question_id, question), question, encoder)
    hits = sized_broadcast(knn(asked, corpus, k, metric, query_id=question_id))
    passages = corpus.select("id", "text").join(hits, "id").join(questions.select(question_id, question), question_id)
    return stuff_prompt(passages, question_id, question, template).select(question_id, question, "prompt")
