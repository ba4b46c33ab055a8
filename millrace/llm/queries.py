"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import blocknames, bpe, chat, langid, lexical, lines, mixing, phrases, pieces, secrets, simhash, substrings, topk
from millrace.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary() -> str:
    """The public byte-level vocabulary, as the driver sees it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model() -> str:
    """The public merge-type piece model, as the driver sees it."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = secrets.scan_secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return findings.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.spans_text("base_spans"), 256).alias("base_sha256"), secrets.spans_text("spans").alias("spans"),
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=20, every=20, scale=64)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup_substrings(documents(spark, sf_dir), size=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_counts(documents(spark, sf_dir), mixing.Target(entropy=0.5, budget=1.0))
    return mixed.withColumn("weight", F.round("weight", 6))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), vocabulary())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocknames.exact_groups(documents(spark, sf_dir)).drop("copy")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.train(docs))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(documents(spark, sf_dir), min_docs=10, min_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return turns.select("conv_id", "turn", "role", "new_role", "action", "inserted", "cost", F.sha2("fragment", 256).alias("fragment_sha256"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(documents(spark, sf_dir), piece_model())


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir), least=30, limit=2000)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_exact_topk": op3_exact_topk,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_bpe": op6_bpe,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_ranked_search": op13_ranked_search,
}
