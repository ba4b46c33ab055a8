"""Approximate nearest neighbours from stored inverted lists, with a recall that is kept.

Cells come from k-means over a bounded sample of the rows; every row is assigned to its nearest cell and stored there with its
vector, a product-quantised code of its residual and the code's error.  Queries meet the lists of their nearest cells in tiles:
matrix products with what the codes stand for, or with the vectors where codes exclude little, leave the rows that may be among the
k best, errors and rounding allowed for; these are measured exactly, so nothing is lost.  Then each query goes on to every further cell whose nearest possible member, by the
cell's distance less ``reach`` times its radius, is closer than the k-th row found.  With a reach of 1 that is an exact search;
building the index measures on sample queries which reach is needed for the recall wanted.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.operators.retrieval import BLOCK_NUMBERS, TILE_CELLS, _ranked, _Rows, _scaled, _square_gap, _top_k, knn
from millrace.session import cut_lineage, spread

TASK_ROWS = 1 << 12  # rows of the lists a task meets, about, once there are more than the session's shuffle partitions take
TRIED, LEFT = 64, 8  # a part's codes are used if they leave at most one in LEFT pairs of its first TRIED queries


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """k-means of a sample; centres that lose all their rows start again at the rows farthest from theirs."""
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own, gap = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        many = np.bincount(own, minlength=k)
        centres[many > 0] = sums[many > 0] / many[many > 0, None]
        lost = np.flatnonzero(many == 0)
        centres[lost] = x[np.argsort(-gap, kind="stable")[: len(lost)]]
    return centres


def _square_gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)[None, :], 0.0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre, its distance) of every row, some rows at a time."""
    own, gap = np.zeros(len(x), np.int64), np.zeros(len(x))
    for a in range(0, len(x), 4096):
        d = _square_gaps(x[a : a + 4096], centres)
        own[a : a + 4096] = d.argmin(axis=1)
        gap[a : a + 4096] = np.sqrt(d.min(axis=1))
    return own, gap


@dataclass
class VectorIndex:
    """The parts of an index that do not grow with the rows; its lists lie below ``path``."""

    path: str
    metric: str
    centres: np.ndarray  # of the cells
    radius: np.ndarray  # distance of each cell's farthest row
    rows: np.ndarray  # in each cell
    books: np.ndarray  # (parts, codes, width): centres of the residuals' parts
    reach: float
    id: str
    vector: str

    def save(self, spark: SparkSession) -> None:
        cells = [(i, c.tolist(), float(r), int(n)) for i, (c, r, n) in enumerate(zip(self.centres, self.radius, self.rows))]
        spark.createDataFrame(cells, "cell int, centre array<double>, radius double, rows long").coalesce(1).write.parquet(f"{self.path}/cells")
        codes = [(p, i, c.tolist()) for p, book in enumerate(self.books) for i, c in enumerate(book)]
        spark.createDataFrame(codes, "part int, code int, centre array<double>").coalesce(1).write.parquet(f"{self.path}/codes")
        settings = [(self.metric, float(self.reach), self.id, self.vector)]
        spark.createDataFrame(settings, "metric string, reach double, id string, vector string").coalesce(1).write.parquet(f"{self.path}/settings")


def load_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index built earlier, by any session that reaches its folder."""
    try:
        settings = spark.read.parquet(f"{path}/settings").first()
    except AnalysisException as e:
        raise FileNotFoundError(f"no index in {path}") from e
    cells = sorted(spark.read.parquet(f"{path}/cells").collect(), key=lambda r: r["cell"])  # bounded when the index was built
    codes = sorted(spark.read.parquet(f"{path}/codes").collect(), key=lambda r: (r["part"], r["code"]))
    parts = 1 + max(r["part"] for r in codes)
    books = np.array([r["centre"] for r in codes]).reshape(parts, len(codes) // parts, -1)
    column = lambda name: np.array([r[name] for r in cells])
    return VectorIndex(path, settings["metric"], column("centre"), column("radius"), column("rows"), books, settings["reach"], settings["id"], settings["vector"])


def _matrix(column: pa.Array, metric: str) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return _scaled(flat.reshape(len(column), -1), metric) if len(column) else flat.reshape(0, 0)


def build_index(
    corpus: DataFrame, path: str, id_: str = "id", vector: str = "vector", metric: str = "l2", recall: float = 0.95, k: int = 20,
    cells: int | None = None, parts: int = 8, codes: int = 64, sample: int = 20_000, trials: int = 200, seed: int = 42,
) -> VectorIndex:
    """Index every row with a vector and store the index below ``path``.

    Cells and codes are fitted on at most ``sample`` rows, chosen by a digest of their id, which alone go through the driver;
    ``trials`` of these, searched exactly, decide the reach at which ``recall`` of their ``k`` neighbours are found.  ``cells``
    is the square root of the rows if not given, and at most a tenth of the sample.  Vectors are of one length.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    spark = corpus.sparkSession
    base = corpus.select(F.col(id_).alias("_id"), F.col(vector).cast("array<float>").alias("_v")).filter("_v IS NOT NULL")
    shape = base.agg(F.count("*").alias("n"), F.max(F.size("_v")).alias("d"), F.min(F.size("_v")).alias("lo")).first()
    if not shape["n"] or shape["d"] != shape["lo"]:
        raise ValueError("no vectors, or vectors that differ in length")
    chosen = base.orderBy(F.xxhash64("_id"), "_id").limit(sample).toArrow()
    x = _matrix(chosen.column("_v").combine_chunks(), metric)
    rng = np.random.default_rng(seed)
    n_cells = max(1, min(cells or int(np.sqrt(shape["n"])), max(1, len(x) // 10)))
    centres = _means(x, n_cells, rng)
    width = -(-x.shape[1] // parts)
    pad = parts * width - x.shape[1]
    rest = np.pad(x - centres[_nearest(x, centres)[0]], ((0, 0), (0, pad)))
    books = np.array([_means(rest[:, p * width : (p + 1) * width], min(codes, len(x)), rng) for p in range(parts)])
    shared = spark.sparkContext.broadcast((centres, books))
    id_type = base.schema["_id"].dataType

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, books = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            rows = _matrix(b.column(1), metric)
            own, gap = _nearest(rows, centres)
            rest = np.pad(rows - centres[own], ((0, 0), (0, pad)))
            code, square = np.zeros((len(rows), parts), np.uint8), np.zeros(len(rows))
            for p in range(parts):
                c, d = _nearest(rest[:, p * width : (p + 1) * width], books[p])
                code[:, p], square = c, square + d**2
            cols = [pa.array(own.astype(np.int32)), b.column(0), pa.array(gap), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(np.sqrt(square)), b.column(1)]
            yield pa.RecordBatch.from_arrays(cols, names=["cell", "_id", "gap", "code", "error", "_v"])

    # a file of few row groups would be few tasks
    made = spread(base).mapInArrow(assign, f"cell int, _id {id_type.simpleString()}, gap double, code binary, error double, _v array<float>")
    # sorted by cell, so that a few queries read a few row groups; a crowded cell is several parts
    made.repartitionByRange("cell", F.xxhash64("_id")).sortWithinPartitions("cell").write.parquet(f"{path}/lists")
    lists = spark.read.parquet(f"{path}/lists")
    rows, radius = np.zeros(n_cells, np.int64), np.zeros(n_cells)
    for r in lists.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("far")).collect():  # one row per cell
        rows[r["cell"]], radius[r["cell"]] = r["n"], r["far"]
    index = VectorIndex(path, metric, centres, radius, rows, books, 1.0, id_, vector)
    index.reach = _reach(index, base, lists, chosen.slice(0, trials), recall, k)
    index.save(spark)
    return index


def _reach(index: VectorIndex, base: DataFrame, lists: DataFrame, asked: pa.Table, recall: float, k: int) -> float:
    """The share of a cell's radius that has to be allowed for, so that ``recall`` of the trial queries' neighbours are found."""
    spark = base.sparkSession
    trials = spark.createDataFrame(list(zip(range(asked.num_rows), asked.column("_v").to_pylist())), "query_id long, vector array<float>")
    exact = knn(trials, base.select(F.col("_id").alias("id"), F.col("_v").alias("vector")), k, index.metric)
    found = exact.join(lists.select(F.col("_id").alias("id"), "cell"), "id").select("query_id", "cell", "distance").toArrow()  # trials x k rows
    if not found.num_rows:
        return 1.0
    trial, cell, distance = (found.column(c).to_numpy() for c in range(3))
    x = _matrix(asked.column("_v").combine_chunks(), index.metric)
    gap = np.sqrt(_square_gaps(x, index.centres))[trial, cell]
    distance = np.sqrt(2 * distance) if index.metric == "cosine" else distance
    farthest = np.zeros(asked.num_rows)
    np.maximum.at(farthest, trial, distance)
    far = farthest[trial]
    needed = (gap - far) / np.maximum(index.radius[cell], 1e-12)
    return float(np.clip(np.quantile(needed, recall) + 1e-6, 0.0, 1.0))


class _Part:
    """The rows of one cell's part: their vectors and what their codes stand for."""

    def __init__(self, index: VectorIndex, cell: int, ids: list, held: list[pa.RecordBatch]):
        vectors = np.concatenate([_matrix(p.column(7), "l2") for p in held])
        self.rows = _Rows(ids, list(vectors), index.metric)
        self.index, self.cell, self.held, self.order = index, cell, held, sorted(range(len(ids)), key=ids.__getitem__)
        self.coded, self.tried = None, False

    def _by_codes(self, queries: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that the codes, their errors allowed for, leave within ``most``; rounding allowed for, too."""
        if self.coded is None:
            codes = np.concatenate([np.array([np.frombuffer(c, np.uint8) for c in p.column(5).to_pylist()]) for p in self.held])[self.order]
            books = self.index.books
            rest = books[np.arange(len(books)), codes].reshape(len(codes), -1)[:, : queries.shape[1]]
            self.coded = self.index.centres[self.cell] + rest
            self.errors = np.concatenate([p.column(6).to_numpy() for p in self.held])[self.order]
        slack = 1e-6 * (np.sqrt((queries**2).sum(axis=1)) + self.rows.far)
        return np.nonzero(np.sqrt(_square_gaps(queries, self.coded)) - self.errors <= (most + slack)[:, None])

    def pairs(self, queries: np.ndarray, most: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all pairs that may be among the query's ``k`` nearest here and within ``most``, if that is finite.

        The codes decide while they leave few pairs of the part's first queries; where they exclude little, products with the
        vectors exclude more in the same time."""
        known = np.flatnonzero(np.isfinite(most))
        if len(known) < len(queries):
            open_ = np.flatnonzero(~np.isfinite(most))
            qi, ri = self.rows.bound(queries[open_], k)
            if not len(known):
                return open_[qi], ri
            more, there = self.pairs(queries[known], most[known], k)
            return np.r_[open_[qi], known[more]], np.r_[ri, there]
        most = most * (1 + 1e-9) + 1e-9
        if not self.tried:
            left = len(self._by_codes(queries[:TRIED], most[:TRIED])[0])
            self.tried, self.useful = True, left * LEFT <= len(queries[:TRIED]) * len(self.errors)
        return self._by_codes(queries, most) if self.useful else self.rows.within(queries, most)


def _measure(index: VectorIndex, k: int, id_type: pa.DataType, q_type: pa.DataType):
    """Sorted (task, cell, salt, asks, _id, code, error, _v, _qid, bound): a cell's part, then its queries, to their k best there.

    Queries are measured tile by tile; the pairs that may count are then measured exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, held, here = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, salt, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            new = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (salt[1:] != salt[:-1]) | (asks[1:] != asks[:-1])])
            for a, b in zip(new.tolist(), [*new[1:].tolist(), batch.num_rows]):
                part = batch.slice(a, b - a)
                if (cell[a], salt[a]) != place:
                    place, ids, held, here = (cell[a], salt[a]), [], [], None
                if not asks[a]:
                    ids += part.column(4).to_pylist()
                    held.append(part)
                    continue
                if not held:
                    continue
                if here is None:
                    here = _Part(index, place[0], ids, held)
                step = max(1, TILE_CELLS // len(ids))
                for at in range(0, part.num_rows, step):
                    tile = part.slice(at, step)
                    queries = _matrix(tile.column(7), index.metric)
                    most = tile.column(9).to_numpy(zero_copy_only=False).astype(float)
                    most[np.isnan(most)] = np.inf
                    qi, ri = here.pairs(queries, most, k)
                    qi, d, ri = _top_k(qi, np.sqrt(_square_gap(queries, here.rows.x, qi, ri)), ri, k)  # rows stand by id
                    yield pa.RecordBatch.from_arrays([tile.column(8).take(pa.array(qi)), pa.array(list(here.rows.ids[ri]), id_type), pa.array(d)], names=["_qid", "_id", "distance"])

    return run


def _dealt(rows: np.ndarray, part_rows: int, tasks: int) -> list[list[int]]:
    """The task of every part of every cell: a cell's rows are in parts of about ``part_rows``, and the tasks get about the same
    number of rows, the largest parts first."""
    dealt = [[0] * max(1, -(-int(n) // part_rows)) for n in rows]
    parts = [(int(rows[cell]) / len(salts), cell, salt) for cell, salts in enumerate(dealt) for salt in range(len(salts))]
    loads = [(0.0, task) for task in range(min(tasks, len(parts)))]
    for n, cell, salt in sorted(parts, reverse=True):
        load, dealt[cell][salt] = loads[0]
        heapq.heapreplace(loads, (load + n, dealt[cell][salt]))
    return dealt


def _probe(index: VectorIndex, asked: DataFrame, lists: DataFrame, k: int, part_rows: int) -> DataFrame:
    """``asked`` (_qid, _v, bound, cell) against the lists of their cells: (_qid, _id, distance)."""
    spark = lists.sparkSession
    id_type, q_type = lists.schema["_id"].dataType, asked.schema["_qid"].dataType
    dealt = _dealt(index.rows, part_rows, max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(index.rows.sum()) // TASK_ROWS))
    tasks = F.broadcast(spark.createDataFrame(list(enumerate(dealt)), "cell int, tasks array<int>"))  # a row per cell
    null = lambda kind: F.lit(None).cast(kind)
    rows = lists.join(tasks, "cell").withColumn("salt", F.pmod(F.xxhash64("_id"), F.size("tasks")).cast("int"))
    rows = rows.select(F.col("tasks")[F.col("salt")].alias("task"), "cell", "salt", F.lit(False).alias("asks"), "_id", "code", "error", "_v", null(q_type).alias("_qid"), null("double").alias("bound"))
    sent = asked.join(tasks, "cell").select("*", F.posexplode("tasks").alias("salt", "task"))
    sent = sent.select("task", "cell", "salt", F.lit(True).alias("asks"), null(id_type).alias("_id"), null("binary").alias("code"), null("double").alias("error"), "_v", "_qid", "bound")
    met = rows.unionByName(sent).repartitionById(1 + max(map(max, dealt)), F.col("task")).sortWithinPartitions("cell", "salt", "asks")
    return met.mapInArrow(_measure(index, k, to_arrow_type(id_type), to_arrow_type(q_type)), f"_qid {q_type.simpleString()}, _id {id_type.simpleString()}, distance double")


def search_index(queries: DataFrame, index: VectorIndex, k: int, query_id: str = "query_id", vector: str = "vector", probes: int = 4, part_rows: int = 1 << 16) -> DataFrame:
    """``(query_id, id, distance, rank)``: the ``k`` nearest rows of every query that the index finds, ties by id.

    Two passes over the lists: each query's ``probes`` nearest cells, then all further cells that may hold a closer row by the
    index's reach (all cells if it has not found k rows yet).  Only lists that are asked are read.
    """
    spark = queries.sparkSession
    lists = spark.read.parquet(f"{index.path}/lists")
    asked = queries.select(F.col(query_id).alias("_qid"), F.col(vector).cast("array<float>").alias("_v")).filter("_v IS NOT NULL")
    q_type = asked.schema["_qid"].dataType
    schema = f"_qid {q_type.simpleString()}, _v array<float>, bound double, cell int"
    probes = min(probes, len(index.centres))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, parts = index.centres.shape[::-1]
        step = max(1, BLOCK_NUMBERS // (width * parts))  # a query's vector goes to many cells
        for b in (b.slice(at, step) for b in batches for at in range(0, b.num_rows, step)):
            gaps = np.sqrt(_square_gaps(_matrix(b.column(1), index.metric), index.centres))
            first = np.zeros(gaps.shape, bool)
            first[np.arange(len(gaps))[:, None], np.argsort(gaps, axis=1, kind="stable")[:, :probes]] = True
            if b.num_columns == 2:
                q, c = np.nonzero(first)
                bound = pa.nulls(len(q), pa.float64())
            else:
                held = b.column(2).to_numpy(zero_copy_only=False).astype(float)  # NaN: fewer than k rows so far
                q, c = np.nonzero(~first & ~(gaps - index.reach * index.radius[None, :] >= held[:, None]))
                bound = b.column(2).take(pa.array(q))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(q)), b.column(1).take(pa.array(q)), bound, pa.array(c.astype(np.int32))], names=["_qid", "_v", "bound", "cell"])

    near = cut_lineage(_probe(index, spread(asked).mapInArrow(cells, schema), lists, k, part_rows))
    order = F.row_number().over(Window.partitionBy("_qid").orderBy("distance", "_id"))
    held = near.withColumn("n", order).filter(F.col("n") == k).select(F.col("_qid").alias("_held"), F.col("distance").alias("bound"))
    again = spread(asked.join(held, F.col("_qid") == F.col("_held"), "left").select("_qid", "_v", "bound")).mapInArrow(cells, schema)
    found = near.unionByName(_probe(index, again, lists, k, part_rows))
    if index.metric == "cosine":
        found = found.withColumn("distance", F.col("distance") * F.col("distance") / 2)
    return _ranked(found, k, query_id, index.id)

