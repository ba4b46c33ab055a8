"""Line dedup: count the documents of every normalised line, drop frequent lines, reassemble by position.

Lines travel as two 64-bit hashes; the text of a document is shuffled once, at the end, to meet its flags.  A line that a
third of the documents share is counted by partial aggregates, and the join that flags its places has an exchange on
both sides, so adaptive execution can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, ascii_lower, hash128, staged, text_of


def dedup_lines(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1
) -> DataFrame:
    """One row per input row: id, n_lines, n_dropped, kept_text.

    A text is split at newlines (NULL or empty: one empty line).  A line's key is the line, stripped and with A-Z in lower
    case.  Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines.
    A document is an id: rows that repeat an id count once for a key.  NULL is an id like any other.  If no line is left,
    the kept text is empty.  An empty table gives no rows; other columns are not read.
    """
    docs = rows.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).withColumn("k", F.xxhash64("t"))
    key = ascii_lower(F.btrim(F.col("line"), F.lit(SPACE)))
    lines = staged(
        docs.select("id", "k", F.posexplode(F.split("t", "\n", -1)).alias("pos", "line"))
        .select("id", "k", "pos", key.alias("key"))
        .select("id", "k", "pos", *hash128(F.col("key")), (F.char_length("key") >= min_chars).alias("counts")),
        "lines",
    )
    often = (
        lines.filter("counts").select("h1", "h2", "id").distinct().groupBy("h1", "h2").count().filter(F.col("count") >= min_docs)
        .select("h1", "h2", F.lit(True).alias("drop"))
    )
    flags = (
        lines.withColumn("h1", F.when(F.col("counts"), F.col("h1")))  # NULL joins nothing
        .join(staged(often, "frequent-lines"), ["h1", "h2"], "left")
        .groupBy("id", "k", "pos").agg(F.max(F.col("drop").isNotNull()).alias("drop"))  # repeated rows
        .groupBy("id", "k").agg(F.sort_array(F.collect_list(F.struct("pos", "drop"))).alias("found"), F.max("drop").alias("any"))
        .filter("any").select(F.col("id").alias("_id"), F.col("k").alias("_k"), F.col("found.drop").alias("drops"))
    )
    joined = docs.join(staged(flags, "line-flags"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")), "left")
    parts = F.split("t", "\n", -1)
    kept = F.filter(F.arrays_zip(parts.alias("line"), F.col("drops").alias("drop")), lambda x: ~x["drop"])
    return joined.select(
        F.col("id").alias(id_col),
        F.size(parts).cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(F.size(F.filter("drops", lambda d: d))).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), F.col("t")).otherwise(F.array_join(kept["line"], "\n")).alias("kept_text"),
    )
