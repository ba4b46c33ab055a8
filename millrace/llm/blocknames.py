"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of fixed size.  All distinct blocks are sorted (by hash partition, then by
their bytes) and numbered; equal blocks, and only they, share a number.  Then adjacent numbers are paired, the
distinct pairs are sorted and numbered in the same way, and so on, until one number is left of every document.
Texts are equal exactly when they end on the same level with the same number.

The bytes of the blocks are shuffled once, after equal ones were merged on the map side.  Between documents and
block numbers the join runs on two 64-bit hashes; that these tell all distinct blocks apart is checked on the whole
table, and new hash seeds are drawn if not, so identities stay free of collisions.  Joins have an exchange of their
own on both sides, which lets adaptive execution split a block that a third of the documents share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, packed, row_key, scratch, staged, text_of


def _hash(c: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), c).alias("a"), F.xxhash64(F.lit(2 * seed + 1), c).alias("b"))


def _slices(t: Column, size: int) -> Column:
    data = F.encode(t, "UTF-8")
    last = F.floor((F.greatest(F.octet_length(t), F.lit(1)) - 1) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _numbered(distinct: DataFrame, cols: list[str]) -> DataFrame:
    """Number rows in the order of their hash partition and, inside it, of ``cols``.  Both depend on the set of rows alone."""
    return distinct.sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id())


def _first_names(texts: DataFrame, block_bytes: int, seed: int) -> DataFrame:
    """(a, b, name) of every distinct block; seeds are drawn anew until no two blocks share (a, b)."""
    block = F.explode(_slices(F.col("t"), block_bytes)).alias("block")
    keyed = texts.select(block).select("block", _hash(F.col("block"), seed).alias("h")).select("h.a", "h.b", "block")
    return staged(_numbered(keyed.distinct(), ["a", "b", "block"]).select("a", "b", "name"), "block-names")


def identities(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 2048) -> DataFrame:
    """One row per distinct (id, normalised text): id, sha (binary), n (rows), level, name.

    ``level`` and ``name`` are the identity: equal exactly for equal normalised texts.  NULL text is the empty text, which
    is one empty block.  Rows that agree in id and normalised text are merged and counted in ``n``.
    """
    t = ascii_lower(text_of(text_col))
    texts = rows.select(F.col(id_col).alias("id"), t.alias("t"))
    for seed in range(1, 100):
        names = _first_names(texts, block_bytes, seed)
        if names.groupBy("a", "b").count().filter("count > 1").isEmpty():
            break
    level = staged(
        texts.select(
            "id",
            F.unhex(F.sha2("t", 256)).alias("sha"),
            F.transform(_slices(F.col("t"), block_bytes), lambda s: _hash(s, seed)).alias("items"),
        )
        .groupBy("id", "sha")
        .agg(F.count("*").alias("n"), F.first("items").alias("items")),
        "block-items",
    )
    done, depth = None, 0
    while True:
        items = level.select("id", "sha", "n", F.posexplode("items").alias("pos", "item")).select("id", "sha", "n", "pos", "item.*")
        if depth:
            names = staged(_numbered(items.select("a", "b").distinct(), ["a", "b"]), "pair-names")
        named = staged(
            items.join(names, ["a", "b"])
            .groupBy("id", "sha", "n")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("found"))
            .select("id", "sha", "n", F.col("found.name").alias("names")),
            "named",
        )
        whole = named.filter(F.size("names") == 1).select("id", "sha", "n", F.lit(depth).alias("level"), F.col("names")[0].alias("name"))
        done = whole if done is None else done.unionByName(whole)
        level = named.filter(F.size("names") > 1)
        if level.isEmpty():
            return done
        half = F.floor((F.size("names") - 1) / 2).cast("int")
        pair = lambda i: F.struct(
            F.get("names", 2 * i).alias("a"), F.coalesce(F.get("names", 2 * i + 1), F.lit(-1).cast("long")).alias("b")
        )
        level = level.select("id", "sha", "n", F.transform(F.sequence(F.lit(0), half), pair).alias("items"))
        depth += 1


def exact_groups(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 2048) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, copy.

    Texts are equal when they agree after lower-casing A-Z.  ``keep_id`` is the largest id of the group; a NULL id is
    smaller than any other, and a group of NULL ids has a NULL keep_id.  Of several rows with the kept id only the first
    copy (``copy`` 0) is kept.  An empty table gives no rows; other columns are not read.
    """
    rows_of = identities(rows, id_col, text_col, block_bytes)
    groups = staged(rows_of.groupBy("level", "name").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size")), "text-groups")
    return (
        rows_of.join(groups, ["level", "name"])
        .select("id", "keep_id", "group_size", F.lower(F.hex("sha")).alias("text_sha256"), F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("copy"))
        .select(
            F.col("id").alias(id_col), "keep_id", "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"), "text_sha256", "copy",
        )
    )


def drop_copies(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 2048) -> DataFrame:
    """``rows`` with all its columns, one row of each group of equal texts: the one with the largest id.

    If several rows carry that id and the same normalised text, one of them stays.
    """
    with scratch(rows.sparkSession):
        kept = exact_groups(rows, id_col, text_col, block_bytes).filter("kept")
        kept = staged(kept.select(row_key(F.col(id_col), F.col("text_sha256")).alias("_key")), "kept-rows", outer=True)
    own = row_key(F.col(id_col), F.sha2(ascii_lower(text_of(text_col)), 256)).alias("_key")
    return rows.select(own, packed(rows)).join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
