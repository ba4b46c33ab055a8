"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

A text is read as bytes (A-Z in lower case, other ASCII that is no letter as blank); its runs of two, three and four bytes are
hashed into ``buckets`` embeddings, whose average feeds the softmax.  Counting is vectorised per text and piece, so long texts
need no more memory than short ones.

Training takes a documented, bounded sample: of each language at most ``per_lang`` documents (fewer if all together would pass
``most_rows``), chosen by a digest of their id; whole texts are counted by Spark tasks, and the driver gets one vector of
``buckets`` numbers each.  A fifth of the sample calibrates: a temperature for the probabilities, and the limit below which a
prediction is rejected, set so that at most ``lose`` of the right predictions fall below it, and never above ``most_limit``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged, word_pieces

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = [ord(c.lower()) if (c := chr(b)).isalpha() else 32 for b in range(128)]


@dataclass(frozen=True)
class Settings:
    buckets: int = 4096
    width: int = 16
    per_lang: int = 300
    most_rows: int = 4000
    epochs: int = 30
    rate: float = 0.5
    batch: int = 32
    seed: int = 7
    lose: float = 0.001
    most_limit: float = 0.4


@dataclass(frozen=True)
class Model:
    langs: list[str]
    weights: np.ndarray  # (buckets, langs): embeddings times the softmax matrix
    bias: np.ndarray
    temperature: float
    limit: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, rejected)."""
        if not self.langs or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        z = (features(text, len(self.weights)) @ self.weights + self.bias) / self.temperature
        p = np.exp(z - z.max())
        best = int(np.argmax(p))
        score = float(p[best] / p.sum())
        return self.langs[best], score, score < self.limit


def features(text: str, buckets: int) -> np.ndarray:
    """Share of each bucket among the text's subwords."""
    counts = np.zeros(buckets, np.int64)
    for piece in word_pieces(text.encode("utf-8", "surrogatepass")):
        b = _FOLD[np.frombuffer(b" " + piece.strip() + b" ", np.uint8)]
        h = b
        for n in (1, 2, 3):
            h = h[:-1] * np.uint32(0x01000193) ^ b[n:]
            counts += np.bincount((h * np.uint32(0x9E3779B1) >> np.uint32(8)) % np.uint32(buckets), minlength=buckets)
    return (counts / max(1, counts.sum())).astype(np.float32)


def _sample(docs: DataFrame, s: Settings) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the sample's features and the numbers of their languages; rows in the order of language and digest."""
    ids = docs.filter(F.col("lang").isNotNull() & ~F.col("held")).select("lang", "id").distinct()
    sizes = ids.groupBy("lang").agg(F.count("*").alias("many")).orderBy(F.col("many").desc(), "lang").limit(s.most_rows)
    sizes = staged(sizes, "language-sizes")  # at most most_rows rows, by the limit
    each = max(1, min(s.per_lang, s.most_rows // max(1, sizes.count())))
    # only about four times the sample meets in the window, however common a language is
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    ids = ids.join(F.broadcast(sizes), "lang").filter(share * F.col("many") < 4.0 * each + 100).select("lang", "id")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    picked = staged(ids.withColumn("n", place).filter(F.col("n") <= each).orderBy("n", "lang").limit(s.most_rows), "language-sample")
    # at most most_rows rows, by the limit
    chosen = docs.join(F.broadcast(picked.withColumnRenamed("id", "_id")), (F.col("id").eqNullSafe(F.col("_id"))) & (docs["lang"] == picked["lang"]), "left_semi")
    chosen = chosen.filter(F.col("t").isNotNull()).select("id", "lang", "t").dropDuplicates(["id", "lang"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py(), s.buckets).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary()), batch.column(3)], names=["lang", "x", "h"])

    rows = chosen.withColumn("h", F.xxhash64("id")).mapInArrow(run, "lang string, x binary, h long").collect()
    rows.sort(key=lambda r: (r["lang"], r["h"], r["x"]))
    names = sorted({r["lang"] for r in rows})
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows]) if rows else np.zeros((0, s.buckets), np.float32)
    return names, x, np.array([names.index(r["lang"]) for r in rows], int)


def fit(langs: list[str], x: np.ndarray, y: np.ndarray, s: Settings) -> Model:
    """Train on four fifths of the sample, calibrate on the rest."""
    if not langs:
        return Model([], np.zeros((s.buckets, 0)), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(y))
    check, train = (order[::5], np.setdiff1d(order, order[::5])) if len(y) >= 10 * len(langs) else (order, order)
    scale = np.sqrt(s.buckets).astype(np.float32)
    emb = rng.normal(0, 1 / s.width, (s.buckets, s.width)).astype(np.float32)
    out, bias = np.zeros((s.width, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    for epoch in range(s.epochs):
        rate = s.rate * (1 - epoch / s.epochs)
        mixed = rng.permutation(train)
        for at in range(0, len(mixed), s.batch):
            part = mixed[at : at + s.batch]
            mean = x[part] * scale
            hidden = mean @ emb
            z = hidden @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p /= len(part)
            back = p @ out.T
            out -= rate * (hidden.T @ p)
            bias -= rate * p.sum(axis=0)
            emb -= rate * (mean.T @ back)
    weights = (scale * emb @ out).astype(np.float64)
    z = x[check] @ weights + bias

    def chances(t: float) -> np.ndarray:
        p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return p / p.sum(axis=1, keepdims=True)

    right = np.arange(len(check))
    def loss(t: float) -> float:
        """Cross entropy against labels trusted to 99 %, so that a separable sample does not make the model certain."""
        p = np.log(chances(t) + 1e-12)
        return -(0.99 * p[right, y[check]] + 0.01 * p.mean(axis=1)).mean()

    temperature = min(np.geomspace(0.05, 10, 60), key=loss)
    p = chances(temperature)
    good = np.sort(p.max(axis=1)[p.argmax(axis=1) == y[check]])
    limit = min(s.most_limit, float(good[int(s.lose * len(good))])) if len(good) else s.most_limit
    return Model(langs, weights, bias.astype(np.float64), float(temperature), limit)


def _docs(rows: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    held = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1
    return rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("lang"), held.alias("held"))


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> Model:
    """Fit on labelled rows outside the held-out third (CRC-32 of the id modulo 3 is 1).  Without labelled rows the model knows no language."""
    return fit(*_sample(_docs(rows, id_col, text_col, lang_col), settings), settings)


def identify(rows: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, rejected.

    NULL text, text without a letter, and any text if the model knows no language, give ``und`` with score 0, rejected.  Only
    the text is read for a prediction.  Repeated rows come back as often; an empty table gives no rows.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers
    slim = _docs(rows, id_col, text_col, lang_col).select("id", "held", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(2)]
            cols = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["id", "held_out", "lang_pred", "score", "rejected"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)


def drop_rejected(rows: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``rows`` with all its columns, without those whose text the model rejects."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not shared.value.predict(t.as_py())[2] for t in batch.column(at)], pa.bool_()))

    return rows.mapInArrow(run, rows.schema)
