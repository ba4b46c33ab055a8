"""The training-data pipeline: languages, exact copies, near copies, source mixture, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the last return the columns of
``docs``; the result has one row per document read by the mixture, with its token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import blocknames, bpe, langid, mixing, simhash, similar
from millrace.llm.common import scratch, staged
from millrace.llm.queries import vocabulary

#: No stage for near copies can be written as SQL: the hash of the fingerprints is none of SQL's.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the model rejects: no text, no letter, or a score below the calibrated limit.

    Repeated rows share their fate; an empty table stays empty.
    """
    return langid.drop_rejected(docs, langid.train(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest doc_id of texts that agree after lower-casing A-Z.

    NULL and empty texts are one group; a NULL doc_id is less than any other; of repeated rows one stays.
    """
    return blocknames.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the least doc_id of each group of near copies.

    First of the components of fingerprints at two bits of 64, then of texts at a similarity of 0.8 or more over five-word
    shingles, found by the same bit-sliced comparison of wider fingerprints.  Texts without words, NULL included, are one
    group; a NULL doc_id comes last; of rows that agree in doc_id and text one stays.
    """
    with scratch(spark):
        first = staged(simhash.drop_near_copies(docs), "near-copies-dropped")
        kept = staged(similar.kept_similar(first), "kept-rows", outer=True)
    return similar.rows_of_keys(docs, kept)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Flatten the sources as far as a quarter more reading of the smallest one allows; no document is left out.

    NULL is a source of its own; texts without words cost nothing and are read once; repeated rows are read together.
    """
    return mixing.mix(docs, mixing.Target(repeats=1.25))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids of every row; NULL and empty texts have no tokens."""
    return bpe.encode(docs, vocabulary(), keep=("lang", "source"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("bpe", bpe_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
