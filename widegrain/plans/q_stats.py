"""Driver-table queries for correlations, VIF, PCA error and Spearman."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats as S
from .registry import register
from .tables import load, rnd

_CORR_COLS = {"l_quantity": "l_quantity", "l_discount": "l_discount + 0.0", "l_tax": "l_tax + 0.0",
              "l_linenumber": "CAST(l_linenumber AS DOUBLE)",
              "tax_3": "CASE WHEN l_orderkey % 100 < 3 THEN NULL ELSE l_tax END",
              "price_30": "CASE WHEN l_orderkey % 10 < 3 THEN NULL ELSE l_extendedprice END",
              "const_one": "1.0"}
_T = "l_extendedprice"


def _corr_frame(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select(F.col(_T), *[F.expr(e).cast("double").alias(c) for c, e in _CORR_COLS.items()])


_CORR_VIEW = "(SELECT l_extendedprice, " + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _CORR_COLS.items()) + " FROM lineitem)"
_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {k} AS position, count(*) FILTER (WHERE {c} IS NOT NULL) AS n, "
    f"CASE WHEN var_samp({c}) > 0 THEN corr({c}, {_T}) END AS r FROM {_CORR_VIEW}"
    for k, c in enumerate(_CORR_COLS))


@register("target_correlations", "A14,A16,A30", sql=f"""
SELECT column_name, position, n, round(r, 6) AS r, abs(r) > 0.95 AS leak FROM ({_CORR_SQL}) WHERE r IS NOT NULL
""")
def target_correlations(spark, sf):
    c = S.corr_with_target(_corr_frame(spark, sf), _T, list(_CORR_COLS))
    return c.select("column_name", "position", "n", rnd("r").alias("r"), (F.abs("r") > 0.95).alias("leak"))


@register("top_target_correlations", "W2,A16", sql=f"""
SELECT column_name, round(r, 6) AS r FROM ({_CORR_SQL}) WHERE r IS NOT NULL ORDER BY abs(r) DESC, position LIMIT 3
""")
def top_target_correlations(spark, sf):
    c = S.corr_with_target(_corr_frame(spark, sf), _T, list(_CORR_COLS))
    return S.top_correlations(c, 3).select("column_name", rnd("r").alias("r"))


_MAT_COLS = ["l_quantity", "l_discount", "tax_3", "price_30", _T]


@register("correlation_matrix_lineitem", "A15", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {i} AS a_idx, {j} AS b_idx, "
    f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n, round(corr({a}, {b}), 6) AS r FROM {_CORR_VIEW}"
    for i, a in enumerate(_MAT_COLS) for j, b in enumerate(_MAT_COLS) if i > j))
def correlation_matrix_lineitem(spark, sf):
    m = S.corr_matrix(_corr_frame(spark, sf), _MAT_COLS)
    return m.select("col_a", "col_b", "a_idx", "b_idx", "n", rnd("r").alias("r"))


# VIF of three columns on list-wise complete rows: diag of the inverse 3x3
# correlation matrix, in closed form.
_VIF_COLS = ["l_quantity", "l_discount", "tax_3"]
_VIF_SQL = f"""
WITH d AS (SELECT l_quantity, l_discount, tax_3 FROM {_CORR_VIEW}
           WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND tax_3 IS NOT NULL),
     r AS (SELECT corr(l_quantity, l_discount) AS r12, corr(l_quantity, tax_3) AS r13, corr(l_discount, tax_3) AS r23 FROM d),
     t AS (SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det FROM r)
SELECT 'l_quantity' AS column_name, 0 AS position, round((1 - r23 * r23) / det, 6) AS vif FROM t
UNION ALL SELECT 'l_discount', 1, round((1 - r13 * r13) / det, 6) FROM t
UNION ALL SELECT 'tax_3', 2, round((1 - r12 * r12) / det, 6) FROM t
"""


@register("vif_lineitem", "M1", sql=_VIF_SQL)
def vif_lineitem(spark, sf):
    v = S.vif(_corr_frame(spark, sf), _VIF_COLS)
    return v.select("column_name", "position", rnd("vif").alias("vif"))


@register("pca_reconstruction_lineitem", "M7,W5", sql=f"""
WITH r AS (SELECT abs(corr(l_quantity, {_T})) AS a FROM lineitem WHERE l_quantity IS NOT NULL AND {_T} IS NOT NULL)
SELECT 0 AS k, 1.0 AS mse, CAST(NULL AS DOUBLE) AS explained_ratio, 0.0 AS cumulative FROM r
UNION ALL SELECT 1, round((1 - a) / 2, 6), round((1 + a) / 2, 6), round((1 + a) / 2, 6) FROM r
UNION ALL SELECT 2, 0.0, round((1 - a) / 2, 6), 1.0 FROM r
""")
def pca_reconstruction_lineitem(spark, sf):
    e = S.pca_reconstruction(load(spark, sf, "lineitem"), ["l_quantity", _T])
    return e.select("k", rnd("mse").alias("mse"), rnd("explained_ratio").alias("explained_ratio"),
                    rnd("cumulative").alias("cumulative"))


@register("spearman_quantity_price", "M23", sql=f"""
WITH d AS (SELECT l_quantity AS a, {_T} AS b FROM lineitem WHERE l_quantity IS NOT NULL AND {_T} IS NOT NULL),
     r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
                  rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM d)
SELECT count(*) AS n, round(corr(ra, rb), 6) AS rho FROM r
""")
def spearman_quantity_price(spark, sf):
    s = S.spearman(load(spark, sf, "lineitem"), "l_quantity", _T)
    return s.select("n", rnd("rho").alias("rho"))
