"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256).  The ledger holds, per blob and rule version, the spans found.
A run scans one copy of each blob, and of that only the rules whose (blob, rule version) pair the ledger lacks; then it
joins the ledger back to all paths.  Plain SQL functions throughout: a text is searched with ``rlike`` and only blobs with a
hit are split into matches and gaps, whose running lengths give the places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged, text_of

LEDGER = "sha binary, rule string, version int, spans array<struct<start:long,stop:long>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose group ``group`` has ``least`` characters or more."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True


def any_case(words: str) -> str:
    """The pattern with each letter in either case, independent of the engine's own folding."""
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.isalpha() else c for c in words)


# The patterns of the result.  Runs are maximal, so the least lengths of access and hex may stand in the pattern.
ASSIGN = "(" + any_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    Rule("assign", 1, ASSIGN, group=2, least=6),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "[0-9a-f]{24,}"),
)
#: Further kinds; their spans are added to the base ones and change none.
MORE = (
    Rule("private_key", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("signed_token", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", base=False),
)


def _todo(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Blobs with the kinds that no ledger row of the present rule version covers."""
    pairs = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    return (
        blobs.select("sha", "rep", F.explode(pairs).alias("p")).select("sha", "rep", "p.*")
        .join(ledger.select("sha", "rule", "version"), ["sha", "rule", "version"], "left_anti")
        .groupBy("sha", "rep").agg(F.collect_set("rule").alias("rules"))
    )


def _matches(r: Rule) -> Column:
    """Per match: length of the gap before it, its own length, whether it counts."""
    text, pattern = F.col("t"), F.lit(r.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    group = F.regexp_extract_all(text, pattern, F.lit(r.group))
    return F.transform(
        F.arrays_zip(F.slice(F.split(text, r.pattern, -1), 1, F.size(whole)).alias("gap"), whole.alias("whole"), group.alias("group")),
        lambda m: F.struct(
            F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), F.char_length(m["gap"]).cast("long").alias("gap"),
            F.char_length(m["whole"]).cast("long").alias("length"), (F.char_length(m["group"]) >= r.least).alias("counts"),
        ),
    )


def scan(rows: DataFrame, ledger: DataFrame | None, id_col: str, text_col: str, rules: tuple[Rule, ...]) -> tuple[DataFrame, DataFrame]:
    """(paths, ledger): (id, sha) of every row, and the ledger with all pairs of these blobs and rules.

    ``ledger`` has the columns of ``LEDGER``; rows of other rule versions are kept.  One text of each unseen blob is scanned.
    """
    spark = rows.sparkSession
    if ledger is None:
        ledger = spark.createDataFrame([], LEDGER)
    docs = rows.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).withColumn("sha", F.unhex(F.sha2("t", 256)))
    paths = staged(docs.select("id", "sha"), "secret-paths")
    todo = staged(_todo(paths.groupBy("sha").agg(F.min("id").alias("rep")), ledger, rules), "secret-todo")
    wanted = todo.select(F.col("sha").alias("_sha"), F.col("rep").alias("_rep"), "rules")
    texts = docs.join(wanted, (F.col("sha") == F.col("_sha")) & F.col("id").eqNullSafe(F.col("_rep")))
    none = F.array().cast("array<struct<rule:string,version:int,gap:long,length:long,counts:boolean>>")
    hits = F.concat(*[F.when(F.array_contains("rules", r.kind) & F.col("t").rlike(r.pattern), _matches(r)).otherwise(none) for r in rules])
    found = texts.select("sha", "id", hits.alias("hits")).filter(F.size("hits") > 0).dropDuplicates(["sha"])
    order = Window.partitionBy("sha", "rule").orderBy("i")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        found.select("sha", F.posexplode("hits").alias("i", "m")).select("sha", "i", "m.*")
        .withColumn("stop", F.sum(F.col("gap") + F.col("length")).over(upto))
        .filter("counts")
        .groupBy("sha", "rule", "version")
        .agg(F.sort_array(F.collect_list(F.struct((F.col("stop") - F.col("length")).alias("start"), "stop"))).alias("spans"))
    )
    versions = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    scanned = todo.select("sha", F.explode("rules").alias("rule")).withColumn("version", versions[F.col("rule")])
    fresh = scanned.join(spans, ["sha", "rule", "version"], "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast("array<struct<start:bigint,stop:bigint>>"))
    )
    return paths, ledger.unionByName(staged(fresh, "secret-ledger"))


def scan_secrets(
    rows: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE
) -> tuple[DataFrame, DataFrame]:
    """(findings, ledger).  Findings: one row per input row with id, spans and base_spans.

    Spans are structs (start, rank, kind, stop) by start, then by the order of ``rules``; code points, end exclusive.
    NULL text is empty; repeated rows and equal texts share the blob's findings; an empty table gives no rows; other
    columns are not read.  Store the ledger and pass it to the next run.
    """
    paths, ledger = scan(rows, ledger, id_col, text_col, rules)
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    blobs = (
        ledger.filter((F.col("version") == current[F.col("rule")]) & (F.size("spans") > 0))
        .withColumn("rank", rank[F.col("rule")])
        .select("sha", F.explode("spans").alias("s"), "rank", "rule")
        .groupBy("sha")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("s.start").alias("start"), "rank", F.col("rule").alias("kind"), F.col("s.stop").alias("stop")))).alias("spans"))
    )
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,stop:bigint>>")
    spans = F.coalesce("spans", empty)
    base = [i for i, r in enumerate(rules) if r.base]
    findings = paths.join(staged(blobs, "secret-blobs"), "sha", "left").select(
        F.col("id").alias(id_col), spans.alias("spans"), F.filter(spans, lambda s: s["rank"].isin(base)).alias("base_spans")
    )
    return findings, ledger


def spans_text(c: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
