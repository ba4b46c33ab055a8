"""BPE encoding and decoding with a published byte-level vocabulary.

A pre-token's symbols stand in a doubly linked list; merge candidates wait in a priority queue by (rank, place), and entries
whose pair has changed meanwhile are stale and skipped.  Decoding concatenates vocabulary strings.  Texts are encoded in Arrow
batches without a shuffle; the vocabulary is read by the driver and broadcast (its size is that of the file), so executors
need no copy of it.  A bounded cache per worker remembers encoded pre-tokens; it is emptied when full and changes no result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how byte-level vocabularies of this kind split a text before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECE = 1 << 20
_CACHED = 600_000
_CODECS: dict[str, Codec] = {}


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec(dict):
    """Token ids of pre-tokens (as little-endian 32-bit bytes), encoded on first use."""

    def __init__(self, definition: str):
        super().__init__()
        model = json.loads(definition)
        vocab: dict[str, int] = model["model"]["vocab"]
        letters = _byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        self.first = [vocab[letters[b]] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.split = regex.compile(PRE_TOKEN).findall
        self.cut = regex.compile(r"(?<=\p{L}) (?=\p{L})")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def __missing__(self, token: str) -> bytes:
        ids = np.array(self.merge([self.first[b] for b in token.encode("utf-8")]), "<u4").tobytes()
        if len(self) >= _CACHED:
            self.clear()
        self[token] = ids
        return ids

    def merge(self, ids: list[int]) -> list[int]:
        """Merge by least rank, leftmost first."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        queue = [(m[0], i, m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            rank, i, merged = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= n or (m := merges.get((ids[i], ids[j]))) is None or m[0] != rank:
                continue  # stale: a neighbour was merged since
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((merged, ids[k])):
                    heapq.heappush(queue, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], merged))):
                heapq.heappush(queue, (m[0], h, m[1]))
        return [x for x in ids if x >= 0]

    def pieces(self, text: str) -> Iterator[str]:
        """Cut between a letter and a blank before a letter, where no pre-token spans the cut."""
        start = 0
        while len(text) - start > _PIECE and (m := self.cut.search(text, start + _PIECE)):
            yield text[start : m.start()]
            start = m.start()
        yield text[start:] if start else text

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian 32-bit bytes, piece by piece.  Special tokens in the text are recognised."""
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                yield np.array([self.special[part]], "<u4").tobytes()
                continue
            for piece in self.pieces(part):
                yield b"".join(map(self.__getitem__, self.split(piece)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(definition: str) -> Codec:
    """One codec per worker process and vocabulary."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(definition)
    return _CODECS[key]


def _definition(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    return (t.as_py() or "" for t in batch.column(batch.schema.get_field_index("_text")))


def encode(rows: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, the columns ``keep``, n_tokens, token_ids (array of int).

    NULL text is empty and has no tokens; repeated rows come back as often; an empty table gives no rows; columns that are not
    named are not read.  ``path`` is a vocabulary file as the driver sees it.
    """
    shared = _definition(rows, path)
    cols = [F.col(id_col).alias("id"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]]
    slim = rows.select(*cols, F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):  # ids take more room than the text
                batch = whole.slice(at, 256)
                c = codec(shared.value)
                ids = [b"".join(c.encode(t)) for t in _texts(batch)]
                counts = np.array([len(x) // 4 for x in ids], np.int64)
                values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts), lists], names=[*batch.schema.names[:-1], "n_tokens", "token_ids"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    names = [id_col, *keep, "n_tokens", "token_ids"]
    return slim.mapInArrow(run, f"{fields}, n_tokens long, token_ids array<int>").toDF(*names)


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """One row per input row: id, text.  NULL ids give NULL; bytes that are no UTF-8 become the replacement character."""
    shared = _definition(rows, path)
    slim = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = codec(shared.value)
            texts = [None if (x := v.as_py()) is None else c.decode(np.array(x, "<u4").tobytes()).decode("utf-8", "replace") for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, text string").toDF(id_col, "text")


def round_trip(rows: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode, and return per row: id, n_tokens, ids_sha256 (ids as little-endian 32-bit numbers), decoded_sha256.

    The same rules as ``encode`` and ``decode``, without moving ids and texts out of the tasks.
    """
    shared = _definition(rows, path)
    slim = rows.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = codec(shared.value)
            counts, ids_sha, text_sha = [], [], []
            for text in _texts(batch):
                ids = b"".join(c.encode(text))
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids).decode("utf-8", "replace").encode()).hexdigest())
            out = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
