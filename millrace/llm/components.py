"""Connected components of a link table by alternating large and small stars.

Each round is two aggregates by the smaller neighbour and two joins, stored in the shared folder; nothing but a row count and
a checksum reaches the driver.  The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged


def _least(links: DataFrame) -> DataFrame:
    return staged(links.groupBy("u").agg(F.min("v").alias("m")), "star-least")


def _stars(links: DataFrame) -> DataFrame:
    """One round over links (u, v) with u > v."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (
        both.join(_least(both), "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )
    large = staged(large, "large-star")
    least = _least(large)
    small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node that can be reached.

    Loops and repeated edges do no harm; rows with NULL are ignored; no edges give no rows.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), (F.col("a") != F.col("b")).alias("real"))
    links = staged(links.filter("real").select("u", "v").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        sums = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums == before or not sums[0]:
            break
        before = sums
        links = _stars(links)
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
