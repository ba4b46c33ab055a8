"""SentencePiece encoding and decoding (merge type) by a table of last tokens.

Merging always takes the best-scored adjacent pair, the leftmost of equals, so what it does inside two neighbouring tokens does
not depend on the text around them.  Two facts follow: a sequence of tokens is the encoding of its text exactly if each two
neighbours are the encoding of theirs, and every prefix of a text has exactly one last token.  An automaton over the pieces
yields the tokens that end at a place; the one that is compatible with the last token of the prefix before it is the prefix's
own.  The ids are read off backwards from the end.  Compatibility is tested once per pair of tokens and remembered.

Texts are cut where no piece can reach across (before blanks, and between letters and other characters if the vocabulary keeps
these apart), so that short segments can be remembered too.  Both memories are bounded and change no result.
Texts are encoded in Arrow batches without a shuffle; the driver reads the model file and broadcasts its tables, whose size is
that of the file.
"""

from __future__ import annotations

import codecs
import hashlib
import pickle
import re
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the model format: the visible blank, and the kinds of pieces.
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_CACHED, _PAIRS, _LONGEST = 700_000, 1_000_000, 64
_CODECS: dict[str, Codec] = {}


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    """One replacement character for each byte that is no UTF-8."""
    return "�", error.start + 1


codecs.register_error("millrace-one-each", _one_each)


def read_model(path: str) -> bytes:
    """The tables of a merge-type model with byte fallback, an identity normaliser and a dummy prefix; any other raises."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, trained = model.normalizer_spec, model.trainer_spec
    if trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix:
        raise ValueError("not a merge-type model with byte fallback")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
        raise ValueError("the model normalises its texts")
    kinds = [p.type for p in model.pieces]
    if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("user-defined or unused pieces")
    special = (trained.bos_id, trained.eos_id, trained.unk_surface)
    return pickle.dumps(([p.piece for p in model.pieces], [p.score for p in model.pieces], kinds, special))


class Codec(dict):
    """Token ids of segments (as little-endian 32-bit bytes), encoded on first use."""

    def __init__(self, tables: bytes):
        super().__init__()
        self.pieces, scores, kinds, (begin, end, unknown) = pickle.loads(tables)
        self.begin, self.end = (np.array([x], "<u4").tobytes() for x in (begin, end))
        normal = [i for i, k in enumerate(kinds) if k == NORMAL]
        self.score = {self.pieces[i]: scores[i] for i in normal}
        self.ids = {self.pieces[i]: np.array([i], "<u4").tobytes() for i in normal}
        byte = {int(self.pieces[i][1:-1], 16): i for i, k in enumerate(kinds) if k == BYTE}
        self.byte_ids = [np.array([byte[b]], "<u4").tobytes() for b in range(256)]
        self.kinds = kinds
        text_of = {
            NORMAL: lambda p: p.replace(BLANK, " ").encode(), UNKNOWN: lambda p: unknown.encode(),
            CONTROL: lambda p: b"", BYTE: lambda p: bytes([int(p[1:-1], 16)]),
        }
        self.strings = [text_of[k](p) for p, k in zip(self.pieces, kinds)]
        self.ending = ahocorasick.Automaton()
        for piece in self.ids:
            self.ending.add_word(piece, (piece, len(piece)))
        self.ending.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.old: dict[str, bytes] = {}  # the segments before these
        self.segments = self._cuts()

    def _cuts(self):
        """A pattern of segments that no piece reaches across."""
        letter = re.compile(r"[^\W\d_]").match
        bound = {(a, b) for p in self.ids for a, b in zip(p, p[1:])}
        if any(b == BLANK != a for a, b in bound):
            return re.compile(r".+", re.DOTALL).findall
        apart = not any(bool(letter(a)) != bool(letter(b)) and a != BLANK for a, b in bound)
        inner = r"[^\W\d_]+|(?:[\d_]|[^\w▁])+" if apart else r"[^▁]+"
        return re.compile(rf"▁*(?:{inner})|▁+").findall

    def _merges_to(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` from single characters ends in these two tokens (one, if ``left`` is empty)."""
        parts, get, none = [*left, *right], self.score.get, -np.inf
        edge = len(left) - 1  # the pair that the border between the tokens splits
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == none:
                break
            i = scores.index(best)
            if i == edge:
                return False  # merged across
            edge -= i < edge
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], none)
        return len(parts) == (2 if left else 1)

    def compatible(self, pair: tuple[str, str]) -> bool:
        """Test a pair of tokens and remember the answer."""
        if len(self.pairs) >= _PAIRS:
            self.pairs.clear()
        found = self.pairs[pair] = self._merges_to(*pair)
        return found

    def tokens(self, text: str) -> list[str]:
        """The tokens of a segment: last token of every prefix, then backwards from the end."""
        n, known, done = len(text), self.pairs.get, -1
        last = ["", *text]  # by the prefix's length: a character that no token ends with stands for itself
        for end, (piece, size) in self.ending.iter(text):
            if end == done:
                continue
            pair = (last[end + 1 - size], piece)
            if (fits := known(pair)) is None:
                fits = self.compatible(pair)
            if fits:
                last[end + 1], done = piece, end
        found, at = [], n
        while at:
            found.append(last[at])
            at -= len(last[at])
        return found[::-1]

    def __missing__(self, segment: str) -> bytes:
        found = self.old.pop(segment, None)
        if found is None:
            found = b"".join([
                self.ids[t] if t in self.ids else b"".join(map(self.byte_ids.__getitem__, t.encode("utf-8", "surrogatepass")))
                for t in self.tokens(segment)
            ])
        if len(segment) <= _LONGEST:
            if len(self) >= _CACHED:  # what is met again comes back, the rest is forgotten
                self.old = dict(self)
                self.clear()
            self[segment] = found
        return found

    def encode(self, text: str, ends: bool = True) -> bytes:
        """Ids as little-endian 32-bit bytes, with the ids of begin and end unless ``ends`` is false."""
        marked = BLANK + text.replace(" ", BLANK) if text else ""
        body = b"".join(map(self.__getitem__, self.segments(marked)))
        return self.begin + body + self.end if ends else body

    def decode(self, ids: Sequence[int]) -> str:
        data = b"".join(map(self.strings.__getitem__, ids))
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        if first is not None and self.kinds[first] == NORMAL and self.pieces[first][0] == BLANK:
            data = data[1:]  # the dummy prefix
        try:
            return data.decode()
        except UnicodeDecodeError:
            return data.decode("utf-8", "millrace-one-each")


def codec(tables: bytes) -> Codec:
    """One codec per worker process and model."""
    key = hashlib.sha256(tables).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(tables)
    return _CODECS[key]


def _slim(rows: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    kept = [F.col(id_col).alias("id"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]]
    return rows.select(*kept, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))


def encode(rows: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), ends: bool = True) -> DataFrame:
    """One row per input row: id, the columns ``keep``, n_tokens, token_ids (array of int).

    NULL text is empty and has the ids of begin and end only (none without ``ends``); characters that are no piece become
    bytes; repeated rows come back as often; an empty table gives no rows; columns that are not named are not read, and ``keep``
    may not name a column that is produced.  ``path`` is a model file as the driver sees it.
    """
    if clash := {id_col, "n_tokens", "token_ids"} & set(keep):
        raise ValueError(f"keep names produced columns: {sorted(clash)}")
    shared = rows.sparkSession.sparkContext.broadcast(read_model(path))
    slim = _slim(rows, id_col, text_col, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):  # ids take more room than the text
                batch = whole.slice(at, 256)
                ids = [c.encode(t.as_py(), ends) for t in batch.column(batch.num_columns - 1)]
                counts = np.array([len(x) // 4 for x in ids], np.int64)
                values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts), lists], names=[*batch.schema.names[:-1], "n_tokens", "token_ids"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return slim.mapInArrow(run, f"{fields}, n_tokens long, token_ids array<int>").toDF(id_col, *keep, "n_tokens", "token_ids")


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """One row per input row: id, text.

    NULL ids give NULL text, no ids the empty text, an id outside the vocabulary an error; the blank that encoding puts first is
    taken away; each byte that is no UTF-8 becomes a replacement character.
    """
    shared = rows.sparkSession.sparkContext.broadcast(read_model(path))
    slim = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        for batch in batches:
            texts = [None if (x := v.as_py()) is None else c.decode(x) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return slim.mapInArrow(run, f"id {slim.schema['id'].dataType.simpleString()}, text string").toDF(id_col, "text")


def round_trip(rows: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode, and return per row: id, n_tokens, ids_sha256 (ids as little-endian 32-bit numbers), decoded_sha256.

    The same rules as ``encode`` and ``decode``, without moving ids and texts out of the tasks.
    """
    shared = rows.sparkSession.sparkContext.broadcast(read_model(path))
    slim = _slim(rows, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = c.encode(text.as_py())
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(np.frombuffer(ids, "<u4").tolist()).encode()).hexdigest())
            out = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
