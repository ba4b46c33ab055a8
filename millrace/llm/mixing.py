"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Token shares of the sources are raised to an exponent between 0 (all alike) and 1 (as found) and normalised.  The exponent is
found by bisection, either to the largest that reaches a target entropy or to the smallest that keeps every source within a
number of repetitions.  A source with weight w gets w of the token budget: whole passes over its documents, and a last, partial
pass over blocks of documents in a pseudo-random permutation, up to the block at whose middle the budget is spent.

Plain SQL functions.  A document's cell is taken from a digest of its id, and everything is decided per cell.  There are as many
cells as the largest source has blocks, at least 4096, so a source with a third of the documents is thousands of groups
everywhere and a block holds ``block_docs`` documents at any size.  Permutations are summed up lane by lane (leading digits of the
sort key) before blocks are ordered within a lane.  The driver sees sums over all sources, three bisection steps per job.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import packed, staged, text_of

CELLS = 4096  # at least so many
STEPS = 21  # the exponent is a multiple of 2**-STEPS
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """``entropy``: how far from the entropy found (0) to that of equal weights (1).  ``repeats``: most passes over a source.

    One of the two is given.  ``budget``: tokens of the mixture as a multiple of those found; None: so many that the source
    that is read least is read once, and no document is left out.
    """

    entropy: float | None = None
    repeats: float | None = None
    budget: float | None = None
    block_docs: int = 64
    seed: int = 1

    def __post_init__(self):
        if (self.entropy is None) == (self.repeats is None):
            raise ValueError("give either entropy or repeats")


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def digest_of(id_col: Column) -> Column:
    """60 bits of a digest of the id; NULL like the empty text."""
    head = F.conv(F.substring(_digest(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 15), 16, 10)
    return head.cast("long")


def _blocks_of(docs: Column, target: Target) -> Column:
    """The power of two that leaves at most ``block_docs`` documents a block on average."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(docs / target.block_docs, F.lit(1.0))))).cast("long")


def _cell(digest: Column, cells: int) -> Column:
    return digest.bitwiseAND(F.lit(cells - 1).cast("long"))


def cells_for(counts: DataFrame, target: Target) -> int:
    """As many cells as the largest source has blocks, at least ``CELLS``; both are powers of two."""
    most = counts.groupBy("source").agg(F.count("*").alias("docs")).agg(F.max(_blocks_of(F.col("docs"), target))).first()[0]
    return max(CELLS, most or 1)


def token_counts(rows: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, tokens, digest) of every row; tokens are words, NULL text has none."""
    words = F.size(F.regexp_extract_all(text_of(text_col), F.lit(WORD), F.lit(0))).cast("long")
    return rows.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), words.alias("tokens"), digest_of(F.col(id_col)).alias("digest"))


def _exponent(sources: DataFrame, total: int, target: Target) -> float:
    """Bisect over multiples of 2**-STEPS; each job evaluates the seven middles that three steps may need."""
    share = F.col("tokens") / F.lit(total).cast("double")
    with_tokens = sources.filter("tokens > 0")
    low_share, high_share, n, found = with_tokens.agg(F.min(share), F.max(share), F.count("*"), F.sum(-share * F.log(share))).first()

    # entropy falls and the passes over the smallest source fall as the exponent grows
    def fine(k: int, power: float, power_log: float) -> bool:
        a = k / 2**STEPS
        if target.entropy is not None:
            wanted = found + target.entropy * (math.log(n) - found)
            return math.log(power) - a * power_log / power >= wanted
        if target.budget is None:
            passes = (high_share / low_share) ** (1 - a)
        else:
            passes = target.budget * low_share ** (a - 1) / power
        return passes <= target.repeats + 1e-12

    keep_low = target.entropy is not None  # flat enough: try larger exponents; few enough passes: try smaller ones
    low, high = 0, 2**STEPS
    if n < 2:
        return 1.0
    while high - low > 1:
        middles, ends = set(), [(low, high)]
        for _ in range(3):
            middles |= {(a + b) // 2 for a, b in ends if b - a > 1}
            ends = [x for a, b in ends if b - a > 1 for x in ((a, (a + b) // 2), ((a + b) // 2, b))]
        order = sorted(middles)
        power = [F.pow(share, F.lit(k / 2**STEPS)) for k in order]
        sums = with_tokens.agg(*[F.sum(p) for p in power], *[F.sum(p * F.log(share)) for p in power]).first()
        at = {k: (sums[i], sums[len(order) + i]) for i, k in enumerate(order)}
        while high - low > 1 and (middle := (low + high) // 2) in at:
            if fine(middle, *at[middle]) == keep_low:
                low = middle
            else:
                high = middle
    return (low if keep_low else high) / 2**STEPS


def plan(counts: DataFrame, target: Target, cells_of_source: int) -> DataFrame:
    """(source, cell, weight, block, place, copies) for every cell of ``counts`` (staged: it is read several times).

    ``copies`` is how often the cell's documents are read, ``place`` the rank of its block in the permutation of the last pass.
    Sources without tokens weigh nothing and cost nothing: their documents are read once.
    """
    cells = counts.select("source", _cell(F.col("digest"), cells_of_source).alias("cell"), "tokens")
    cells = staged(cells.groupBy("source", "cell").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")), "mix-cells")
    sources = staged(cells.groupBy("source").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")), "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    exponent = _exponent(sources, total, target) if total else 1.0
    share = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(exponent))
    with_tokens = sources.filter("tokens > 0").select(F.sum(share), F.max(F.col("tokens") / share)).first()
    power, least_read = with_tokens[0] or 1.0, with_tokens[1] or 0.0
    budget = math.floor(target.budget * total) if target.budget is not None else least_read * power
    weighed = sources.select(
        F.col("source").alias("_source"), F.col("tokens").alias("own"), _blocks_of(F.col("docs"), target).alias("blocks"),
        F.when(F.col("tokens") > 0, share / F.lit(power)).otherwise(0.0).alias("weight"),
    ).withColumn("wanted", F.floor(F.col("weight") * budget + 1e-6).cast("long"))
    blocks = (
        cells.join(weighed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("block", F.col("cell").bitwiseAND(F.col("blocks") - 1))
        .withColumn("passes", F.when(F.col("own") > 0, F.floor(F.col("wanted") / F.col("own"))).otherwise(1).cast("long"))
        .withColumn("rest", F.when(F.col("own") > 0, F.col("wanted") - F.col("passes") * F.col("own")).otherwise(0))
    )
    key = _digest(F.lit(target.seed), F.col("passes"), F.coalesce("source", F.lit("")), F.col("block"))
    sizes = blocks.groupBy("source", "block", "passes", "rest").agg(F.sum("tokens").alias("size")).withColumn("key", key)
    sizes = staged(sizes.withColumn("lane", F.substring("key", 1, 3)), "mix-blocks")
    before = Window.partitionBy("source").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)  # 4096 lanes of a source
    lanes = (
        sizes.groupBy("source", "lane").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
        .select(
            F.col("source").alias("_source"), F.col("lane").alias("_lane"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("places"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("tokens"),
        )
    )
    order = Window.partitionBy("source", "lane").orderBy("key", "block")
    placed = (
        sizes.withColumn("within", F.row_number().over(order))
        .withColumn("sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .join(lanes, F.col("source").eqNullSafe(F.col("_source")) & (F.col("lane") == F.col("_lane"))).drop("_source")
        .withColumn("place", F.col("places") + F.col("within"))
        .withColumn("upto", F.col("tokens") + F.col("sum"))
        .withColumn("copies", F.col("passes") + ((F.col("upto") * 2 - F.col("size") <= F.col("rest") * 2) & (F.col("rest") > 0)).cast("long"))
        .select(F.col("source").alias("_source"), F.col("block").alias("_block"), "place", "copies")
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    return staged(blocks.join(placed, same).select("source", "cell", "weight", "block", "place", "copies"), "mix-plan")


def mix_counts(rows: DataFrame, target: Target, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: id, source, n_tokens, weight (of the source), block, place, n_copies (0: not in the mixture).

    NULL sources form a source, NULL text has no tokens, rows that repeat an id share a cell.  An empty table gives no rows.
    """
    counts = staged(token_counts(rows, id_col, text_col, source_col), "mix-tokens")
    cells = cells_for(counts, target)
    made = plan(counts, target, cells).withColumnsRenamed({"source": "_source", "cell": "_cell"})
    same = F.col("source").eqNullSafe(F.col("_source")) & (_cell(F.col("digest"), cells) == F.col("_cell"))
    return counts.join(made, same).select(
        F.col("id").alias(id_col), "source", F.col("tokens").alias("n_tokens"), "weight", "block", "place", F.col("copies").alias("n_copies")
    )


def mix(rows: DataFrame, target: Target, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``rows`` with all its columns, each row as often as the mixture reads it."""
    counts = staged(token_counts(rows, id_col, text_col, source_col).select("source", "digest", "tokens"), "mix-tokens")
    cells = cells_for(counts, target)
    made = plan(counts, target, cells).filter("copies > 0").select(F.col("source").alias("_s"), F.col("cell").alias("_c"), F.col("copies").cast("int").alias("_n"))
    own = rows.select(F.col(source_col).cast("string").alias("_source"), _cell(digest_of(F.col(id_col)), cells).alias("_cell"), packed(rows))
    joined = own.join(made, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_c")))
    return joined.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_row.*")
