"""Driver-table queries for column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators.reshape import weighted_rollup
from .registry import register
from .tables import LINEITEM_GAPS_SQL, lineitem_gaps, lineitem_gaps_sql, load, rnd

_G = lineitem_gaps_sql()
_GAP_COLS = ["l_orderkey", "l_line", "l_returnflag"] + list(LINEITEM_GAPS_SQL)
_GAP_TYPES = {"l_orderkey": "bigint", "l_line": "int", "l_returnflag": "string",
              "l_quantity": "double", "tax_3": "double", "disc_10": "double",
              "price_30": "double", "line_50": "int", "la_share_70": "double"}

_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS position, '{_GAP_TYPES[c]}' AS dtype, "
    f"count(*) - count({c}) AS null_count, (count(*) - count({c})) * 100.0 / count(*) AS null_pct FROM {_G}"
    for i, c in enumerate(_GAP_COLS))

_TIERS_LEFT = """CASE WHEN null_pct = 0 THEN '0%' WHEN null_pct < 5 THEN '<5%' WHEN null_pct < 20 THEN '5-20%'
 WHEN null_pct < 40 THEN '20-40%' WHEN null_pct < 60 THEN '40-60%' ELSE '>60%' END"""
_TIERS_RIGHT = """CASE WHEN null_pct <= 0 THEN '0%' WHEN null_pct <= 5 THEN '<5%' WHEN null_pct <= 20 THEN '5-20%'
 WHEN null_pct <= 40 THEN '20-40%' WHEN null_pct <= 60 THEN '40-60%' ELSE '>60%' END"""
_TIER_LIST = "(VALUES (0, '0%'), (1, '<5%'), (2, '5-20%'), (3, '20-40%'), (4, '40-60%'), (5, '>60%')) AS t(tier_order, tier)"


def _profile(spark, sf):
    return P.null_profile(lineitem_gaps(spark, sf))


@register("null_profile_lineitem", "A8", sql=f"""
SELECT column_name, position, dtype, CAST(null_count AS BIGINT) AS null_count, round(null_pct, 6) AS null_pct
FROM ({_PROFILE_SQL})
""")
def null_profile_lineitem(spark, sf):
    p = _profile(spark, sf)
    return p.withColumn("null_pct", rnd("null_pct"))


def _tier_sql(case):
    return f"""
SELECT t.tier_order, t.tier, CAST(count(p.column_name) AS BIGINT) AS n_columns
FROM {_TIER_LIST} LEFT JOIN (SELECT column_name, {case} AS tier FROM ({_PROFILE_SQL})) p USING (tier)
GROUP BY t.tier_order, t.tier
"""


@register("missing_tiers_left_closed", "A9,I8", sql=_tier_sql(_TIERS_LEFT))
def missing_tiers_left_closed(spark, sf):
    return P.tier_counts(_profile(spark, sf), "left")


@register("missing_bins_right_closed", "A10", sql=_tier_sql(_TIERS_RIGHT))
def missing_bins_right_closed(spark, sf):
    return P.tier_counts(_profile(spark, sf), "right")


@register("missing_tier_crosstab", "A11", sql=f"""
SELECT tier, count(*) FILTER (WHERE NOT s) AS not_structural, count(*) FILTER (WHERE s) AS structural
FROM (SELECT {_TIERS_LEFT} AS tier, lower(column_name) LIKE 'la%' AS s FROM ({_PROFILE_SQL})) GROUP BY tier
""")
def missing_tier_crosstab(spark, sf):
    return P.tier_crosstab(_profile(spark, sf), ["la"])


@register("missing_report", "A26", sql=f"""
SELECT column_name, position, dtype, CAST(null_count AS BIGINT) AS null_count, round(null_pct, 6) AS null_pct
FROM ({_PROFILE_SQL}) WHERE null_count > 0
""")
def missing_report(spark, sf):
    return P.missing_report(_profile(spark, sf)).withColumn("null_pct", rnd("null_pct"))


_NULLABLE = list(LINEITEM_GAPS_SQL)[1:]


@register("profile_header", "A23,A25,A29", sql=f"""
WITH g AS {_G}
SELECT 'n_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM g
UNION ALL SELECT 'n_columns', {len(_GAP_COLS)}.0
UNION ALL SELECT 'overall_missing_pct', round(avg(null_pct), 2) FROM ({_PROFILE_SQL})
UNION ALL SELECT 'rows_any_null', CAST(count(*) FILTER (WHERE {' OR '.join(c + ' IS NULL' for c in _NULLABLE)}) AS DOUBLE) FROM g
UNION ALL SELECT 'rows_all_null', CAST(count(*) FILTER (WHERE {' AND '.join(c + ' IS NULL' for c in _NULLABLE)}) AS DOUBLE) FROM g
""")
def profile_header(spark, sf):
    g = lineitem_gaps(spark, sf)
    om = P.overall_missing_pct(g).select(F.lit("overall_missing_pct").alias("metric"),
                                         F.col("overall_missing_pct").cast("double").alias("value"))
    rc = P.row_completeness(g, _NULLABLE)
    rc = rc.select(P._stack(["metric", "value"], [
        ("n_rows", F.col("n_rows").cast("double")),
        ("n_columns", float(len(g.columns))),
        ("rows_any_null", F.col("rows_any_null").cast("double")),
        ("rows_all_null", F.col("rows_all_null").cast("double"))]).alias("s")).select("s.*")
    return rc.unionByName(om)


_DESC_COLS = ["l_quantity", "price_30", "tax_3"]


@register("describe_lineitem", "A12", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, {i} AS position, count({c}) AS count, round(avg({c}), 6) AS mean,
 round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
 round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max
 FROM {_G}""" for i, c in enumerate(_DESC_COLS)))
def describe_lineitem(spark, sf):
    d = P.describe(lineitem_gaps(spark, sf), _DESC_COLS)
    return d.select("column_name", "position", "count",
                    *[rnd(c).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


_SKEW_COLS = ["l_extendedprice", "l_quantity", "l_tax"]


@register("skewness_lineitem", "A13", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(skewness({c}), 6) AS skewness FROM lineitem" for c in _SKEW_COLS))
def skewness_lineitem(spark, sf):
    s = P.sample_skewness(load(spark, sf, "lineitem"), _SKEW_COLS)
    return s.withColumn("skewness", rnd("skewness"))


@register("duplicates_lineitem_key", "A17", sql="""
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY ALL)
SELECT (SELECT count(*) FROM lineitem) AS n_rows,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_duplicate_rows,
       count(*) AS n_keys, count(*) FILTER (WHERE c > 1) AS n_dup_keys,
       CAST(coalesce(sum(c - 1) FILTER (WHERE c > 1), 0) AS BIGINT) AS n_dup_key_rows,
       count(*) FILTER (WHERE c > 1) = 0 AS key_is_unique
FROM k
""")
def duplicates_lineitem_key(spark, sf):
    return P.duplicate_summary(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("value_counts_priority", "A18", sql="""
SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1
""")
def value_counts_priority(spark, sf):
    return P.value_counts(load(spark, sf, "orders"), "o_orderpriority")


@register("histogram_retailprice", "A19", sql="""
WITH s AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
     b AS (SELECT least(CAST(floor((p_retailprice - lo) / (hi - lo) * 40) AS INTEGER) + 1, 40) AS bin, count(*) AS c
           FROM part, s WHERE p_retailprice IS NOT NULL GROUP BY 1),
     g AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, 41) t(i))
SELECT g.bin, round(lo + (g.bin - 1) * ((hi - lo) / 40), 6) AS bin_lo, round(lo + g.bin * ((hi - lo) / 40), 6) AS bin_hi,
       CAST(coalesce(b.c, 0) AS BIGINT) AS count
FROM g CROSS JOIN s LEFT JOIN b USING (bin)
""")
def histogram_retailprice(spark, sf):
    h = P.histogram(load(spark, sf, "part"), "p_retailprice", 40)
    return h.select("bin", rnd("bin_lo").alias("bin_lo"), rnd("bin_hi").alias("bin_hi"), "count")


@register("kde_retailprice", "A20", sql="""
WITH s AS (SELECT count(p_retailprice) AS n, stddev_samp(p_retailprice) AS sd, min(p_retailprice) AS lo,
                  max(p_retailprice) AS hi FROM part),
     g AS (SELECT CAST(i AS INTEGER) + 1 AS point, lo + i * ((hi - lo) / 19) AS x, sd * pow(n, -0.2) AS h, n
           FROM range(0, 20) t(i), s)
SELECT point, round(x, 6) AS x,
       round(sum(exp(-0.5 * pow((x - p_retailprice) / h, 2))) * (1.0 / (n * h * sqrt(2 * pi()))), 9) AS density
FROM g, part WHERE p_retailprice IS NOT NULL GROUP BY point, x, h, n
""")
def kde_retailprice(spark, sf):
    k = P.kde(load(spark, sf, "part"), "p_retailprice", 20)
    return k.select("point", rnd("x").alias("x"), rnd("density", 9).alias("density"))


@register("box_totalprice_by_status", "A21", sql="""
WITH q AS (SELECT o_orderstatus, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1),
     f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.o_orderstatus, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence, count(*) AS n,
       count(*) FILTER (WHERE o_totalprice < lower_fence OR o_totalprice > upper_fence) AS n_outliers,
       round(min(o_totalprice) FILTER (WHERE o_totalprice BETWEEN lower_fence AND upper_fence), 6) AS whisker_lo,
       round(max(o_totalprice) FILTER (WHERE o_totalprice BETWEEN lower_fence AND upper_fence), 6) AS whisker_hi
FROM f JOIN orders o USING (o_orderstatus) WHERE o_totalprice IS NOT NULL
GROUP BY ALL
""")
def box_totalprice_by_status(spark, sf):
    b = P.box_summary(load(spark, sf, "orders"), "o_totalprice", ["o_orderstatus"])
    num = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_lo", "whisker_hi"]
    return b.select("o_orderstatus", *[rnd(c).alias(c) for c in num], "n", "n_outliers")


@register("rollup_validation", "A22", sql="""
WITH f AS (SELECT sum(l_quantity) AS fw, CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS fk FROM lineitem),
     c AS (SELECT l_suppkey, sum(l_quantity) AS w,
                  sum(CAST(l_discount > 0.05 AS INTEGER) * l_quantity) / nullif(sum(l_quantity), 0) AS disc_flag
           FROM lineitem GROUP BY 1),
     a AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS nk,
                  CAST(count(*) FILTER (WHERE l_suppkey IS NULL) AS DOUBLE) AS nnull, sum(w) AS w,
                  CAST(count(*) FILTER (WHERE disc_flag < 0 OR disc_flag > 1) AS DOUBLE) AS bad FROM c)
SELECT * , abs(observed - expected) <= 1e-6 * greatest(1.0, abs(expected)) AS ok FROM (
  SELECT 'coarse_rows_equal_fine_keys' AS check, n AS observed, fk AS expected FROM a, f
  UNION ALL SELECT 'key_unique', nk, n FROM a
  UNION ALL SELECT 'key_not_null', nnull, 0.0 FROM a
  UNION ALL SELECT 'weight_conserved', round(w, 4), round(fw, 4) FROM a, f
  UNION ALL SELECT 'flags_in_unit_interval', bad, 0.0 FROM a)
""")
def rollup_validation(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("disc_flag", (F.col("l_discount") > 0.05).cast("int"))
    coarse = weighted_rollup(li, "l_suppkey", "l_quantity", flags=["disc_flag"], weight_sum_col="l_quantity")
    chk = P.rollup_checks(li, coarse, "l_suppkey", "l_quantity", ["disc_flag"])
    w = F.col("check") == "weight_conserved"
    return chk.select("check", F.when(w, F.round("observed", 4)).otherwise(F.col("observed")).alias("observed"),
                      F.when(w, F.round("expected", 4)).otherwise(F.col("expected")).alias("expected"), "ok")
