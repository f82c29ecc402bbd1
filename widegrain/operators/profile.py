"""Column profiles: nulls, missingness tiers, describe, skewness, duplicates,
value counts, histograms, kernel density, box summaries, roll-up checks.

Wide tables are profiled with **one** aggregate holding one expression per
column (not a loop of jobs); the single result row is then unpivoted to a long
(column, statistic...) table. Quantiles use the exact skew-safe operator in
``ranking``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import broadcast_if_small, group_quantiles

# Missingness tier labels, in order, used by both tier schemes.
TIER_LABELS = ["0%", "<5%", "5-20%", "20-40%", "40-60%", ">60%"]
# Tier edges (percent).
TIER_EDGES = [0, 5, 20, 40, 60]


def _stack(names: Sequence[str], rows: Sequence[Sequence]) -> "F.Column":
    """explode(array(struct...)) with the same field names in every struct."""
    def as_col(v):
        return F.lit(v) if isinstance(v, (str, int, float, bool)) else v
    return F.explode(F.array(*[F.struct(*[as_col(v).alias(n) for n, v in zip(names, r)]) for r in rows]))


def _cols(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols is not None else list(df.columns)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and percent per column (A8): (column, position, dtype,
    null_count, null_pct) from a single aggregate pass."""
    cols = _cols(df, cols)
    types = dict(df.dtypes)
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__c{i}") for i, c in enumerate(cols)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.lit(types[c]).alias("dtype"),
                 F.col(f"__c{i}").alias("null_count"))
        for i, c in enumerate(cols)]))
    return (row.select(F.col("__n"), stack.alias("s"))
            .select("s.column_name", "s.position", "s.dtype", F.col("s.null_count").cast("long").alias("null_count"),
                    F.try_divide(F.col("s.null_count") * F.lit(100.0), F.col("__n")).alias("null_pct")))


def tier_of(pct, scheme: str = "left"):
    """Missingness tier label of a percent column.

    ``left`` (A9): 0, (0,5), [5,20), [20,40), [40,60), [60,100].
    ``right`` (A10): [0,0], (0,5], (5,20], (20,40], (40,60], (60,100].
    """
    p = F.col(pct) if isinstance(pct, str) else pct
    e = TIER_EDGES
    if scheme == "left":
        return (F.when(p == 0, TIER_LABELS[0]).when(p < e[1], TIER_LABELS[1]).when(p < e[2], TIER_LABELS[2])
                .when(p < e[3], TIER_LABELS[3]).when(p < e[4], TIER_LABELS[4]).otherwise(TIER_LABELS[5]))
    return (F.when(p <= 0, TIER_LABELS[0]).when(p <= e[1], TIER_LABELS[1]).when(p <= e[2], TIER_LABELS[2])
            .when(p <= e[3], TIER_LABELS[3]).when(p <= e[4], TIER_LABELS[4]).otherwise(TIER_LABELS[5]))


def tier_counts(profile: DataFrame, scheme: str = "left") -> DataFrame:
    """Columns per missingness tier (A9 / A10), every tier present (zero counts
    kept), from an A8 profile."""
    t = profile.select(tier_of("null_pct", scheme).alias("t"))
    row = t.agg(*[F.count_if(F.col("t") == lab).alias(f"__t{i}") for i, lab in enumerate(TIER_LABELS)])
    stack = F.explode(F.array(*[F.struct(F.lit(i).alias("tier_order"), F.lit(lab).alias("tier"),
                                         F.col(f"__t{i}").alias("n_columns"))
                                for i, lab in enumerate(TIER_LABELS)]))
    return row.select(stack.alias("s")).select("s.tier_order", "s.tier",
                                               F.col("s.n_columns").cast("long").alias("n_columns"))


def tier_crosstab(profile: DataFrame, structural_prefixes: Sequence[str] = ("la",),
                  scheme: str = "left") -> DataFrame:
    """Tier x structural crosstab (A11): one row per tier present, with counts
    of non-structural and structural columns."""
    structural = F.lit(False)
    for p in structural_prefixes:
        structural = structural | F.lower(F.col("column_name")).startswith(p.lower())
    t = profile.select(tier_of("null_pct", scheme).alias("tier"), structural.alias("s"))
    return t.groupBy("tier").agg(F.count_if(~F.col("s")).alias("not_structural"),
                                 F.count_if(F.col("s")).alias("structural"))


def missing_report(profile: DataFrame) -> DataFrame:
    """Columns with at least one null, largest count first."""
    return profile.where(F.col("null_count") > 0).orderBy(F.col("null_count").desc(), "position")


def overall_missing_pct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean over columns of the null share, in percent, rounded to 2."""
    prof = null_profile(df, cols)
    return prof.agg(F.round(F.avg("null_pct"), 2).alias("overall_missing_pct"))


def row_completeness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with any null and rows with all nulls among ``cols``."""
    cols = _cols(df, cols)
    flags = F.array(*[F.col(c).isNull() for c in cols])
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.exists(flags, lambda x: x)).alias("rows_any_null"),
                  F.count_if(F.forall(flags, lambda x: x)).alias("rows_all_null"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """pandas ``describe`` per numeric column (A12): count, mean, sample std,
    min, interpolated quartiles, max — as rows (column, statistics...).

    Moments come from one wide aggregate; quartiles from the exact skew-safe
    quantile operator over the unpivoted (column, value) pairs.
    """
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    mom = df.agg(*aggs)
    mom = mom.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.col(f"n{i}").alias("count"),
                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")
    q = group_quantiles(long, "value", [0.25, 0.5, 0.75], ["column_name"], ["q25", "q50", "q75"])
    return mom.join(q, "column_name", "left").select("column_name", "position", F.col("count").cast("long"),
                                                "mean", "std", "min", "q25", "q50", "q75", "max")


def sample_skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected sample skewness G1 (pandas ``skew``) per column.

    Spark's ``skewness`` is the population g1; G1 = g1 * sqrt(n(n-1)) / (n-2).
    """
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(F.col(c)).alias(f"n{i}"), F.skewness(F.col(c)).alias(f"g{i}")]
    r = df.agg(*aggs)
    def g1(i):
        n = F.col(f"n{i}").cast("double")
        return F.when(n > 2, F.col(f"g{i}") * F.sqrt(n * (n - 1)) / (n - 2))
    return r.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), g1(i).alias("skewness"))
                                        for i, c in enumerate(cols)])).alias("s")).select("s.*")


def duplicate_summary(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Duplicate rows, distinct keys, duplicate keys and uniqueness.

    Two chained aggregates and no join: distinct rows with their multiplicity,
    then per key; both have map-side partial combine, so a hot key or a
    massively repeated row never ships its raw copies.
    """
    key = list(key)
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__m"))
    per_key = rows.groupBy(*key).agg(F.sum("__m").alias("__c"), F.count(F.lit(1)).alias("__d"))
    out = per_key.agg(F.sum("__c").alias("n_rows"), F.sum("__d").alias("__nd"),
                      F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("__c") > 1).alias("n_dup_keys"),
                      F.coalesce(F.sum(F.when(F.col("__c") > 1, F.col("__c") - 1)), F.lit(0)).alias("__dk"))
    return out.select(F.col("n_rows").cast("long").alias("n_rows"),
                      (F.col("n_rows") - F.col("__nd")).cast("long").alias("n_duplicate_rows"),
                      "n_keys", "n_dup_keys", F.col("__dk").cast("long").alias("n_dup_key_rows"),
                      (F.col("n_dup_keys") == 0).alias("key_is_unique"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Non-null value counts."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram with ``bins`` bins between min and max, the last bin
    closed, empty bins kept (A19): (bin, bin_lo, bin_hi, count)."""
    x = F.col(col).cast("double")
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()  # a two-number profile
    lo, hi = st["lo"], st["hi"]
    if lo is None:
        raise ValueError(f"{col} has no values")
    span = hi - lo
    frac = (x - F.lit(lo)) / F.lit(span) if span > 0 else F.lit(0.0)
    b = F.least(F.floor(frac * bins).cast("int") + 1, F.lit(bins))
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = span / bins
    grid = counts.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    grid = grid.select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_lo"),
                       (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_hi"))
    return grid.join(counts, "bin", "left").select(
        "bin", "bin_lo", "bin_hi", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def kde(df: DataFrame, col: str, points: int = 20) -> DataFrame:
    """Gaussian kernel density on ``points`` evenly spaced grid points from min
    to max (A20), Scott bandwidth ``h = s * n^(-1/5)`` (sample s).

    One stats row is read on the driver; then a single aggregate evaluates all
    grid points as ``points`` sum expressions over the data — no join with the
    grid, no row replication.
    """
    x = F.col(col).cast("double")
    st = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("s"), F.min(x).alias("lo"),
                F.max(x).alias("hi")).first()
    n, s, lo, hi = st["n"], st["s"], st["lo"], st["hi"]
    if not n or s is None or s == 0:
        raise ValueError("kde needs at least two distinct values")
    h = s * n ** (-0.2)
    step = (hi - lo) / (points - 1)
    grid = [lo + i * step for i in range(points)]
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    sums = df.agg(*[F.sum(F.exp(F.lit(-0.5) * F.pow((F.lit(g) - x) / F.lit(h), 2))).alias(f"d{i}")
                    for i, g in enumerate(grid)])
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("point"), F.lit(g).alias("x"), (F.col(f"d{i}") * F.lit(norm)).alias("density"))
        for i, g in enumerate(grid)])).alias("s")).select("s.*")


def box_summary(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Box-plot numbers per group (A21): quartiles, IQR, 1.5 IQR fences,
    whisker ends (extreme values inside the fences) and outlier count."""
    P = list(by) or ["__g"]
    src = df if by else df.withColumn("__g", F.lit(0))
    q = group_quantiles(src, col, [0.25, 0.5, 0.75], P, ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr")) \
         .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr"))
    x = F.col(col).cast("double")
    fences = broadcast_if_small(q.select(*P, "lower_fence", "upper_fence"), known_max_rows=None if by else 1)
    j = src.where(x.isNotNull()).join(fences, P, "inner")
    inside = (x >= F.col("lower_fence")) & (x <= F.col("upper_fence"))
    agg = j.groupBy(*P).agg(F.count(F.lit(1)).alias("n"),
                            F.count_if(~inside).alias("n_outliers"),
                            F.min(F.when(inside, x)).alias("whisker_lo"),
                            F.max(F.when(inside, x)).alias("whisker_hi"))
    out = q.join(agg, P, "inner")
    return out if by else out.drop("__g")


def rollup_checks(fine: DataFrame, coarse: DataFrame, key: str, weight: str,
                  flags: Sequence[str] = (), fine_key_expr=None) -> DataFrame:
    """Grain-change validation (A22) as rows (check, observed, expected, ok):
    coarse key unique and non-null, total weight conserved, weighted flags in
    [0, 1], number of coarse rows equals the number of distinct fine keys."""
    fk = fine_key_expr if fine_key_expr is not None else F.col(key)
    f = fine.agg(F.coalesce(F.sum(weight), F.lit(0)).cast("double").alias("w"),
                 F.count_distinct(fk).cast("double").alias("k"))
    flag_bad = F.lit(0)
    for c in flags:
        flag_bad = flag_bad + F.count_if((F.col(c) < 0) | (F.col(c) > 1))
    c = coarse.agg(F.count(F.lit(1)).cast("double").alias("n"),
                   F.count_distinct(F.col(key)).cast("double").alias("nk"),
                   F.count_if(F.col(key).isNull()).cast("double").alias("nnull"),
                   F.coalesce(F.sum(weight), F.lit(0)).cast("double").alias("w"),
                   flag_bad.cast("double").alias("bad"))
    # two one-row aggregates combined by union + max (no keyless join)
    fcols, ccols = ["fw", "fk"], ["n", "nk", "nnull", "w", "bad"]
    f = f.select(F.col("w").alias("fw"), F.col("k").alias("fk"), *[F.lit(None).cast("double").alias(x) for x in ccols])
    c = c.select(*[F.lit(None).cast("double").alias(x) for x in fcols], *ccols)
    j = f.unionByName(c).agg(*[F.max(x).alias(x) for x in fcols + ccols])
    rows = _stack(["check", "observed", "expected"], [
        ("coarse_rows_equal_fine_keys", F.col("n"), F.col("fk")),
        ("key_unique", F.col("nk"), F.col("n")),
        ("key_not_null", F.col("nnull"), 0.0),
        ("weight_conserved", F.col("w"), F.col("fw")),
        ("flags_in_unit_interval", F.col("bad"), 0.0),
    ])
    out = j.select(rows.alias("s")).select("s.*")
    return out.withColumn("ok", F.abs(F.col("observed") - F.col("expected")) <= 1e-6 * F.greatest(F.lit(1.0), F.abs(F.col("expected"))))


def cleaning_checks(before: DataFrame, after: DataFrame, key: str, filled: Sequence[str], untouched: Sequence[str]) -> DataFrame:
    """Validation of a cleaned table against its input (A22) as rows (check,
    observed, expected, ok): row count kept, no nulls left in the ``filled``
    columns, and values of ``untouched`` columns, and those of ``filled`` ones
    that were not null, equal by key (which must be unique)."""
    sides = [df.select(F.col(key).alias("__k"), F.lit(i).alias("__side"), *[F.col(c).alias(f"__{j}") for j, c in enumerate([*untouched, *filled])])
             for i, df in enumerate((before, after))]
    cols = [f"__{j}" for j in range(len(untouched) + len(filled))]

    def of(side, c):
        return F.max(F.when(F.col("__side") == side, F.col(c)))

    per_key = sides[0].unionByName(sides[1]).groupBy("__k").agg(
        F.count_if(F.col("__side") == 0).alias("n0"), F.count_if(F.col("__side") == 1).alias("n1"),
        *[x for c in cols for x in (of(0, c).alias(f"{c}_a"), of(1, c).alias(f"{c}_b"))])
    changed = F.lit(False)
    for c in cols[:len(untouched)]:
        changed = changed | ~F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b"))
    for c in cols[len(untouched):]:
        changed = changed | F.coalesce(F.col(f"{c}_a") != F.col(f"{c}_b"), F.lit(False))
    left = F.lit(0)
    for c in cols[len(untouched):]:
        left = left + F.col(f"{c}_b").isNull().cast("int")
    a = per_key.agg(F.sum("n0").cast("double").alias("n0"), F.sum("n1").cast("double").alias("n1"), F.sum(left).cast("double").alias("left"),
                    F.count_if(changed).cast("double").alias("changed"))
    rows = _stack(["check", "observed", "expected"], [("rows_kept", F.col("n1"), F.col("n0")), ("nulls_left", F.col("left"), 0.0),
                                                      ("values_changed", F.col("changed"), 0.0)])
    return a.select(rows.alias("s")).select("s.*").withColumn("ok", F.col("observed") == F.col("expected"))


def report_header(df: DataFrame, target: str, sources: dict | None = None, train: DataFrame | None = None,
                  test: DataFrame | None = None) -> DataFrame:
    """Report header counts (A29) as (metric, value) rows: rows, usable
    targets, duplicate rows, overall missing percent, columns per source and
    split sizes — one aggregate per input table, combined by union."""
    n = F.count(F.lit(1)).cast("double")
    base = df.agg(n.alias("rows"), F.count(F.col(target)).cast("double").alias("usable"))
    out = base.select(_stack(["metric", "value"], [("total_records", F.col("rows")),
                                                   ("usable_targets", F.col("usable"))]).alias("s")).select("s.*")
    dup = duplicate_summary(df, df.columns).select(F.lit("duplicate_records").alias("metric"),
                                                   F.col("n_duplicate_rows").cast("double").alias("value"))
    miss = overall_missing_pct(df).select(F.lit("missing_pct").alias("metric"),
                                          F.col("overall_missing_pct").cast("double").alias("value"))
    out = out.unionByName(dup).unionByName(miss)
    spark = df.sparkSession
    if sources:
        out = out.unionByName(spark.createDataFrame([(f"columns_{k}", float(len(v))) for k, v in sources.items()],
                                                    "metric string, value double"))
    for name, part in (("train_samples", train), ("test_samples", test)):
        if part is not None:
            out = out.unionByName(part.agg(n.alias("value")).select(F.lit(name).alias("metric"), "value"))
    return out
