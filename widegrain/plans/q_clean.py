"""Driver-table queries for the missing-data and reliability operators."""

from __future__ import annotations

from ..operators import clean as C
from .registry import register
from .tables import flagged, flagged_sql, part_gaps, part_gaps_sql, rnd

_PG = part_gaps_sql()
_FL = flagged_sql()


@register("group_median_fill_part", "W1", sql=f"""
SELECT p_partkey, p_type,
       round(coalesce(price_gap, median(price_gap) OVER (PARTITION BY p_type)), 6) AS price_gap,
       round(coalesce(size_gap7, median(size_gap7) OVER (PARTITION BY p_type)), 6) AS size_gap7
FROM {_PG}
""")
def group_median_fill_part(spark, sf):
    g = part_gaps(spark, sf).select("p_partkey", "p_type", "price_gap", "size_gap7")
    f = C.group_median_fill(g, ["price_gap", "size_gap7"], "p_type")
    return f.select("p_partkey", "p_type", rnd("price_gap").alias("price_gap"), rnd("size_gap7").alias("size_gap7"))


@register("tiered_clean_part", "I1,I8,W1", sql=f"""
SELECT p_partkey, p_type, p_name,
       round(coalesce(price_gap, median(price_gap) OVER (PARTITION BY p_type)), 6) AS price_gap,
       round(coalesce(la_size_share, 0.0), 6) AS la_size_share,
       round(size_gap, 6) AS size_gap,
       round(coalesce(size_gap7, median(size_gap7) OVER (PARTITION BY p_type)), 6) AS size_gap7
FROM {_PG}
""")
def tiered_clean_part(spark, sf):
    c = C.tiered_clean(part_gaps(spark, sf), "p_type", protect=["p_partkey"])
    return c.select("p_partkey", "p_type", "p_name",
                    *[rnd(x).alias(x) for x in ["price_gap", "la_size_share", "size_gap", "size_gap7"]])


_REL = f"""
WITH f AS {_FL},
r AS (SELECT l_orderkey,
             CASE WHEN v1_flag = 2 THEN -1.0 ELSE TRY_CAST(v1_rawvalue AS DOUBLE) END AS v1_rawvalue,
             v1_flag, v1_cilow, v1_numerator,
             CASE WHEN v2_flag = 2 THEN -1.0 ELSE TRY_CAST(v2_rawvalue AS DOUBLE) END AS v2_rawvalue,
             v2_flag, v3_rawvalue,
             coalesce(CAST(v1_flag = 2 AS INTEGER), 0) AS v1_flag_suppressed,
             coalesce(CAST(v1_flag = 1 AS INTEGER), 0) AS v1_flag_unreliable,
             coalesce(CAST(v2_flag = 2 AS INTEGER), 0) AS v2_flag_suppressed,
             coalesce(CAST(v2_flag = 1 AS INTEGER), 0) AS v2_flag_unreliable
      FROM f)"""


@register("reliability_clean_lineitem", "I2,I3,I4,I5,I6,P17,P9", sql=_REL + """,
m AS (SELECT median(v1_rawvalue) AS m1, median(v1_flag) AS mf1,
             median(v2_rawvalue) FILTER (WHERE v2_rawvalue <> -1) AS m2 FROM r)
SELECT l_orderkey,
       round(CASE WHEN v1_rawvalue IS NULL OR v1_rawvalue = -1 THEN m1 ELSE v1_rawvalue END, 6) AS v1_rawvalue,
       CAST(CASE coalesce(v1_flag, mf1) WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE coalesce(v1_flag, mf1) END AS DOUBLE) AS v1_flag,
       round(CASE WHEN v2_rawvalue IS NULL OR v2_rawvalue = -1 THEN m2 ELSE v2_rawvalue END, 6) AS v2_rawvalue,
       v1_flag_suppressed, v1_flag_unreliable, v2_flag_suppressed, v2_flag_unreliable,
       CAST(v1_rawvalue IS NULL OR v1_rawvalue = -1 AS INTEGER) AS v1_rawvalue_is_missing,
       CAST(v1_flag IS NULL OR v1_flag = -1 AS INTEGER) AS v1_flag_is_missing,
       CAST(v2_rawvalue IS NULL OR v2_rawvalue = -1 AS INTEGER) AS v2_rawvalue_is_missing
FROM r, m
""")
def reliability_clean_lineitem(spark, sf):
    final, _, _ = C.clean_flagged(flagged(spark, sf), "l_orderkey", named_col="v1_rawvalue",
                                  recode_cols=["v1_flag"])
    return final.select(*[rnd(c).alias(c) if c in ("v1_rawvalue", "v2_rawvalue") else c for c in final.columns])


@register("metadata_split_lineitem", "I5", sql=f"""
SELECT l_orderkey, v1_cilow, v1_numerator FROM {_FL}
""")
def metadata_split_lineitem(spark, sf):
    rel = C.reliability_expand(flagged(spark, sf))
    meta, _ = C.split_metadata(rel, "l_orderkey")
    return meta


@register("suppression_audit_lineitem", "A24", sql=_REL + """
SELECT 'v1_rawvalue' AS column_name, count(*) FILTER (WHERE v1_rawvalue = -1) AS n_sentinel,
       round(count(*) FILTER (WHERE v1_rawvalue = -1) * 100.0 / count(*), 6) AS sentinel_pct,
       round(avg(CASE WHEN v1_rawvalue = -1 THEN coalesce(CAST(v1_flag = 2 AS DOUBLE), 0.0) END), 6) AS explained_share
FROM r
UNION ALL
SELECT 'v2_rawvalue', count(*) FILTER (WHERE v2_rawvalue = -1),
       round(count(*) FILTER (WHERE v2_rawvalue = -1) * 100.0 / count(*), 6),
       round(avg(CASE WHEN v2_rawvalue = -1 THEN coalesce(CAST(v2_flag = 2 AS DOUBLE), 0.0) END), 6)
FROM r
""")
def suppression_audit_lineitem(spark, sf):
    rel = C.reliability_expand(flagged(spark, sf))
    a = C.suppression_audit(rel)
    return a.select("column_name", "n_sentinel", rnd("sentinel_pct").alias("sentinel_pct"),
                    rnd("explained_share").alias("explained_share"))
