"""Profiles of an inference log by time window and slice, model quality with late labels, and drift.

All statistics are aggregates with partial sums, so one slice or day with most of the rows costs no
more than an even split.  Statistics that need an order (exact quantiles, Kolmogorov-Smirnov) are taken
from value counts and distributed running sums, never from a list of a group's values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.index import running_sums
from millrace.operators.metrics import Metric, add_derived, custom_aggs, regression_aggs
from millrace.session import cut_lineage
from millrace.sources.tables import Tables

ALL = "all"
PSI_FLOOR = 1e-6  # share given to a category one side lacks


def with_slices(df: DataFrame, exprs: Sequence[str]) -> DataFrame:
    """One row per slice a row belongs to: the overall slice, and for every expression the slice named by
    its value (a column gives one slice per value, a condition gives true and false)."""
    slices = [F.struct(F.lit(ALL).alias("slice_key"), F.lit(ALL).alias("slice_value"))]
    for e in exprs:
        value = F.coalesce(F.expr(e).cast("string"), F.lit("null"))
        slices.append(F.struct(F.lit(e).alias("slice_key"), value.alias("slice_value")))
    return df.select("*", F.inline(F.array(*slices)))


def _windowed(df: DataFrame, ts: str, granularity: str) -> DataFrame:
    return df.withColumn("window_start", F.window(ts, granularity)["start"])


SLICE_KEYS = ["window_start", "model_id", "slice_key", "slice_value"]


def profile(
    df: DataFrame,
    ts: str,
    granularity: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    slices: Sequence[str] = (),
    model_id: str = "model_id",
    exact: bool = False,
    probs: Sequence[float] = (),
    custom: Sequence[Metric] = (),
) -> DataFrame:
    """One row per window, model, slice and column: count, nulls, distinct, mean, stddev, min, max and
    optional quantiles (sketches); custom metrics are repeated on the rows of their input column.

    Columns are aggregated side by side and turned into rows afterwards, so the data is multiplied by
    the number of slices only.  Distinct values of numeric columns are counted by a sketch; ``exact``
    counts those of categorical columns by their sets, which merge like any other partial result.
    """
    sliced = with_slices(_windowed(df, ts, granularity), slices)
    keys = ["window_start", F.col(model_id).cast("string").alias("model_id"), "slice_key", "slice_value"]
    distinct = {c: F.size(F.collect_set(c)).cast("bigint") if exact and c in categorical else F.approx_count_distinct(c) for c in [*numeric, *categorical]}
    aggs = []
    for c in [*numeric, *categorical]:
        aggs += [
            F.count(F.col(c)).alias(f"{c}__n"),
            F.count_if(F.col(c).isNull()).alias(f"{c}__null"),
            distinct[c].alias(f"{c}__distinct"),
        ]
    for c in numeric:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__sd"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        if probs:
            aggs.append(F.percentile_approx(x, list(probs), 10_000).alias(f"{c}__q"))
    wide = add_derived(sliced.groupBy(*keys).agg(*aggs, *custom_aggs(custom)), custom)

    def cell(c: str, is_num: bool) -> Column:
        def num(stat: str) -> Column:
            return (F.col(f"{c}__{stat}") if is_num else F.lit(None).cast("double")).alias(
                {"mean": "mean", "sd": "stddev", "min": "min", "max": "max"}[stat]
            )

        fields = [
            F.lit(c).alias("column"),
            F.col(f"{c}__n").alias("n"),
            F.col(f"{c}__null").alias("n_null"),
            F.col(f"{c}__distinct").alias("n_distinct"),
            num("mean"), num("sd"), num("min"), num("max"),
        ]
        if probs:
            fields.append((F.col(f"{c}__q") if is_num else F.lit(None).cast("array<double>")).alias("quantiles"))
        for m in custom:
            if m.type in ("aggregate", "derived"):
                one = len(m.input_columns) == 1
                source = F.col(m.name if one else f"{m.name}_{c}") if c in m.input_columns else F.lit(None)
                fields.append(source.cast(m.output_type).alias(m.name))
        return F.struct(*fields)

    cells = [cell(c, True) for c in numeric] + [cell(c, False) for c in categorical]
    return wide.select(*SLICE_KEYS, F.inline(F.array(*cells)))


def profile_all(df: DataFrame, ts: str, granularities: Sequence[str], **kw) -> DataFrame:
    """Profiles of several granularities, told apart by ``granularity``."""
    out = None
    for g in granularities:
        one = profile(df, ts, g, **kw).withColumn("granularity", F.lit(g))
        out = one if out is None else out.unionByName(one)
    return out


def top_values(df: DataFrame, ts: str, granularity: str, column: str, n: int, slices: Sequence[str] = ()) -> DataFrame:
    """The ``n`` most frequent values of a column per window and slice (ties by value)."""
    sliced = with_slices(_windowed(df, ts, granularity), slices)
    counts = sliced.groupBy("window_start", "slice_key", "slice_value", F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    w = Window.partitionBy("window_start", "slice_key", "slice_value").orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def exact_quantiles(df: DataFrame, by: Sequence[str], column: str, probs: Sequence[float]) -> DataFrame:
    """Exact discrete quantiles per group: the value at rank ``ceil(p·n)``.

    Values are counted first; running counts are formed over range partitions, so neither a frequent
    value nor a large group ends up in one task.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(_group(by).alias("_by"), F.col(column).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    counts = cut_lineage(counts)  # the running sums and the totals both start from the counts
    cum = running_sums(counts, ["_by"], ["_v"], ["_c"])
    ranked = cum.join(counts.groupBy("_by").agg(F.sum("_c").alias("_n")), "_by")
    aggs = [
        F.min(F.when(F.col("cum__c") >= F.greatest(F.ceil(F.lit(float(p)) * F.col("_n")), F.lit(1)), F.col("_v"))).alias(f"q{i}")
        for i, p in enumerate(probs)
    ]
    cells = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col(f"q{i}").alias("value")) for i, p in enumerate(probs)])
    return ranked.groupBy("_by").agg(*aggs).select(*_group_columns(by), F.inline(cells))


def _group(by: Sequence[str]) -> Column:
    """The group columns as one struct: a key that is never NULL itself, equal where its NULLs agree, and
    whose field names cannot clash with columns made on the way."""
    return F.struct(*([F.col(b) for b in by] or [F.lit(0).alias("_all")]))


def _group_columns(by: Sequence[str]) -> list[Column]:
    return [F.col("_by")[b].alias(b) for b in by]


def quality(df: DataFrame, ts: str, granularity: str, y: str, p: str, by: Iterable[str] = ()) -> DataFrame:
    """Regression metrics per window over the rows whose label has arrived."""
    aggs = [c.alias(a) for a, c in regression_aggs(y, p).items()]
    return _windowed(df.filter(F.col(y).isNotNull()), ts, granularity).groupBy("window_start", *by).agg(*aggs)


# -- drift -----------------------------------------------------------------------------------------


def _value_counts(df: DataFrame, by: Sequence[str], cols: Sequence[str], type_: str) -> DataFrame:
    """``(_by, column, value, c)`` of all columns in one pass; NULL counts as a value of its own."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(type_).alias("value")) for c in cols])
    return df.select(_group(by).alias("_by"), F.inline(cells)).groupBy("_by", "column", "value").agg(F.count(F.lit(1)).alias("c"))


def drift_categorical(current: DataFrame, baseline: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Total variation, PSI, Jensen-Shannon divergence (base 2) and chi-square of every column against the
    baseline, per ``by`` group of the current rows, plus the share of rows in unseen categories.

    Categories a group lacks enter through the baseline totals, so no group is paired with the whole
    list of baseline categories.
    """
    cur = _value_counts(current, by, cols, "string").withColumn("value", F.coalesce("value", F.lit("\\N")))
    base = _value_counts(baseline, [], cols, "string").withColumn("value", F.coalesce("value", F.lit("\\N")))
    sizes = cur.groupBy("_by", "column").agg(F.sum("c").alias("n"))
    base_sizes = base.groupBy("column").agg(F.sum("c").alias("nb"))
    eps = F.lit(PSI_FLOOR)
    q = F.col("b") / F.col("nb")
    absent_psi = (eps - F.greatest(q, eps)) * F.log(eps / F.greatest(q, eps))
    base = base.withColumnRenamed("c", "b").join(base_sizes, "column").withColumns({"q": q, "absent": absent_psi})
    totals = base.groupBy("column").agg(F.sum("absent").alias("t_absent"))

    shares = (
        cur.join(sizes, ["_by", "column"])
        .join(base.select("column", "value", "q", "absent"), ["column", "value"], "left")
        .withColumns({"p": F.col("c") / F.col("n"), "q": F.coalesce("q", F.lit(0.0)), "absent": F.coalesce("absent", F.lit(0.0))})
    )
    p, q = F.col("p"), F.col("q")
    mid = (p + q) / 2
    floor_p, floor_q = F.greatest(p, eps), F.greatest(q, eps)
    js = 0.5 * p * F.log2(p / mid) + F.when(q > 0, 0.5 * q * F.log2(q / mid)).otherwise(0.0)
    expected = q * F.col("n")
    per = shares.groupBy("_by", "column").agg(
        F.max("n").alias("n"),
        F.sum(F.abs(p - q)).alias("tv"),
        F.sum((floor_p - floor_q) * F.log(floor_p / floor_q)).alias("psi"),
        F.sum(js).alias("js"),
        F.sum(F.when(q > 0, (F.col("c") - expected) * (F.col("c") - expected) / expected)).alias("chi2"),
        F.sum(F.when(q == 0, p).otherwise(0.0)).alias("unseen"),
        F.sum(q).alias("seen"),
        F.sum("absent").alias("absent"),
    )
    missing = F.greatest(1 - F.col("seen"), F.lit(0.0))
    return per.join(totals, "column").select(
        *_group_columns(by),
        "column",
        ((F.col("tv") + missing) / 2).alias("total_variation"),
        (F.col("psi") + F.col("t_absent") - F.col("absent")).alias("psi"),
        (F.col("js") + missing / 2).alias("js_divergence"),
        (F.coalesce("chi2", F.lit(0.0)) + F.col("n") * missing).alias("chi_square"),
        F.col("unseen").alias("unseen_share"),
    )


def drift_numeric(current: DataFrame, baseline: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, NULL and mean differences and the two-sample Kolmogorov-Smirnov distance of every column
    against the baseline, per ``by`` group of the current rows.

    A group's distance is reached at one of its own values or just below one, so only those need the
    baseline's distribution: baseline counts and current values are merged, summed up in order over range
    partitions, and looked up by equality.
    """
    # stored once each: sizes, the merge and the running sums all start from the counts, not from the rows
    cur, base = (cut_lineage(_value_counts(df, keys, cols, "double")) for df, keys in ((current, by), (baseline, [])))
    have, x = F.col("value").isNotNull(), F.col("value") * F.col("c")

    def sizes(counts: DataFrame, keys: list[str], tag: str) -> DataFrame:
        return counts.groupBy(*keys, "column").agg(
            F.sum("c").alias(f"{tag}_rows"),
            F.sum(F.when(have, F.col("c")).otherwise(0)).alias(f"{tag}_n"),
            F.sum(x).alias(f"{tag}_sum"),
        )

    cur_size, base_size = sizes(cur, ["_by"], "c"), sizes(base, [], "b")
    merged = (
        base.filter(have).select("column", "value", F.col("c").alias("b"))
        .unionByName(cur.filter(have).select("column", "value", F.lit(0).cast("bigint").alias("b")))
        .groupBy("column", "value").agg(F.sum("b").alias("b"))
    )
    base_cum = running_sums(merged, ["column"], ["value"], ["b"])
    cur_cum = running_sums(cur.filter(have), ["_by", "column"], ["value"], ["c"])
    steps = cur_cum.join(base_cum, ["column", "value"]).join(cur_size, ["_by", "column"]).join(base_size, "column")
    at = F.abs(F.col("cum_c") / F.col("c_n") - F.col("cum_b") / F.col("b_n"))
    below = F.abs((F.col("cum_c") - F.col("c")) / F.col("c_n") - (F.col("cum_b") - F.col("b")) / F.col("b_n"))
    ks = steps.groupBy("_by", "column").agg(F.max(F.greatest(at, below)).alias("ks"))
    return (
        cur_size.join(base_size, "column")
        .join(ks, ["_by", "column"], "left")
        .select(
            *_group_columns(by),
            "column",
            (F.col("c_rows") - F.col("b_rows")).alias("count_delta"),
            ((F.col("c_rows") - F.col("c_n")) / F.col("c_rows") - (F.col("b_rows") - F.col("b_n")) / F.col("b_rows")).alias("null_share_delta"),
            (F.try_divide(F.col("c_sum"), F.col("c_n")) - F.try_divide(F.col("b_sum"), F.col("b_n"))).alias("mean_delta"),
            "ks",
        )
    )


def drift_previous(profiles: DataFrame) -> DataFrame:
    """Differences of each window's profile to the window before it of the same model, slice and column."""
    w = Window.partitionBy("model_id", "slice_key", "slice_value", "column").orderBy("window_start")

    def delta(c: str) -> Column:
        return (F.col(c) - F.lag(c).over(w)).alias(f"{c}_delta")

    return profiles.select(
        *SLICE_KEYS, "column", F.lag("window_start").over(w).alias("previous_start"),
        delta("n"), delta("n_null"), delta("mean"), delta("stddev"),
    ).filter(F.col("previous_start").isNotNull())


def alerts(metrics: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows of a metric table that break a rule, with the rule's name; rules are conditions by name."""
    hits = F.array(*[F.when(F.coalesce(F.expr(c), F.lit(False)), F.lit(n)) for n, c in rules.items()])
    return metrics.withColumn("alert", F.explode(F.filter(hits, lambda h: h.isNotNull())))


# -- refresh ---------------------------------------------------------------------------------------


def refresh(tables: Tables, before: str, log: str, profiles: str, key: str, ts: str, **profile_args) -> None:
    """Bring a published daily profile from the snapshot ``before`` of a log to the log as it is now.

    The log is partitioned by ``day`` and so are the profiles.  Only days with a changed row are read
    again and only their profile rows are replaced.
    """
    changed = tables.changes(before, log, [key]).select(F.col("day").cast("string")).distinct()
    days = [[r[0]] for r in changed.collect()]  # one row per changed day
    if days:
        touched = tables.read(log).filter(F.col("day").cast("string").isin([d[0] for d in days]))
        tables.replace_partitions(profiles, daily_profile(touched, ts, **profile_args), days)


def daily_profile(df: DataFrame, ts: str, **profile_args) -> DataFrame:
    made = profile(df, ts, "1 day", **profile_args)
    return made.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
