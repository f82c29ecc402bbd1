"""Driver-table queries for seeded splits, folds, samples, top-k and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import row_argmax
from ..operators import ranking as R
from .registry import register
from .tables import lineitem_gaps, lineitem_gaps_sql, load, rnd

_MD5 = "md5('42:' || CAST(o_orderkey AS VARCHAR))"


@register("split_orders", "W12", sql=f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN row_number() OVER (ORDER BY {_MD5}) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM orders
""")
def split_orders(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return R.exact_split(o, ["o_orderkey"], 0.2, 42)


@register("sample_orders", "W13", sql=f"""
SELECT o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (ORDER BY {_MD5}) <= 100
""")
def sample_orders(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return R.seeded_sample(o, ["o_orderkey"], 100, 42)


@register("folds_orders", "M17", sql=f"""
SELECT o_orderkey, CAST((row_number() OVER (ORDER BY {_MD5}) - 1) % 5 AS INTEGER) AS fold FROM orders
""")
def folds_orders(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    return R.kfold_assign(o, ["o_orderkey"], 5, 42)


@register("fold_sizes_orders", "M17", sql=f"""
SELECT fold, count(*) AS n FROM (
  SELECT CAST((row_number() OVER (ORDER BY {_MD5}) - 1) % 5 AS INTEGER) AS fold FROM orders) GROUP BY fold
""")
def fold_sizes_orders(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    return R.kfold_assign(o, ["o_orderkey"], 5, 42).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("top_orders_by_price", "W3", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def top_orders_by_price(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.top_k(o, "o_totalprice", 5, tiebreak=["o_orderkey"])


@register("running_revenue_share", "W5", sql="""
WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, sum(o_totalprice) AS revenue FROM orders GROUP BY 1)
SELECT order_year, round(revenue, 4) AS revenue,
       round(sum(revenue) OVER (ORDER BY order_year ROWS UNBOUNDED PRECEDING), 4) AS cum,
       round(sum(revenue) OVER (ORDER BY order_year ROWS UNBOUNDED PRECEDING) / sum(revenue) OVER (), 6) AS cum_share,
       round(1 - sum(revenue) OVER (ORDER BY order_year ROWS UNBOUNDED PRECEDING) / sum(revenue) OVER (), 6) AS residual
FROM y
""")
def running_revenue_share(spark, sf):
    o = load(spark, sf, "orders")
    y = o.groupBy(F.year("o_orderdate").alias("order_year")).agg(F.sum("o_totalprice").alias("revenue"))
    r = R.running_share(y, "order_year", "revenue")
    return r.select("order_year", F.round("revenue", 4).alias("revenue"), F.round("cum", 4).alias("cum"),
                    rnd("cum_share").alias("cum_share"), rnd("residual").alias("residual"))


@register("rank_nations_by_balance", "W6", sql="""
WITH a AS (SELECT c_nationkey, avg(c_acctbal) AS avg_bal FROM customer GROUP BY 1)
SELECT c_nationkey, round(avg_bal, 6) AS avg_bal, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, rank() OVER (ORDER BY avg_bal DESC) AS rank FROM a) WHERE rank <= 10
""")
def rank_nations_by_balance(spark, sf):
    a = load(spark, sf, "customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("avg_bal"))
    r = R.competition_rank(a, "avg_bal", keep=10)
    return r.select("c_nationkey", rnd("avg_bal").alias("avg_bal"), "rank")


@register("head_tail_orders", "W8", sql="""
SELECT * FROM (SELECT o_orderkey, o_totalprice, 'head' AS side FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL
SELECT * FROM (SELECT o_orderkey, o_totalprice, 'tail' AS side FROM orders ORDER BY o_orderkey DESC LIMIT 5)
""")
def head_tail_orders(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    head = R.top_k(o, "o_orderkey", 5, ascending=True).withColumn("side", F.lit("head"))
    tail = R.top_k(o, "o_orderkey", 5).withColumn("side", F.lit("tail"))
    return head.unionByName(tail)


_DRIVERS = {"qty_scaled": "l_quantity / 50", "disc_scaled": "disc_10 * 10", "tax_scaled": "tax_3 * 12.5"}


@register("row_argmax_lineitem", "W9", sql=f"""
WITH g AS (SELECT l_orderkey, l_line, {', '.join(f'{e} AS {n}' for n, e in _DRIVERS.items())} FROM {lineitem_gaps_sql()}),
     m AS (SELECT *, greatest({', '.join(_DRIVERS)}) AS top_value FROM g)
SELECT l_orderkey, l_line, round(top_value, 6) AS top_value,
       CASE {' '.join(f"WHEN {n} = top_value THEN '{n}'" for n in _DRIVERS)} END AS top_driver
FROM m
""")
def row_argmax_lineitem(spark, sf):
    g = lineitem_gaps(spark, sf).select("l_orderkey", "l_line", *[F.expr(e).alias(n) for n, e in _DRIVERS.items()])
    v, name = row_argmax(list(_DRIVERS))
    return g.select("l_orderkey", "l_line", rnd(v).alias("top_value"), name.alias("top_driver"))


@register("top_bottom_customers", "W11", sql="""
SELECT * FROM (SELECT c_custkey, c_acctbal, 'top' AS side FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)
UNION ALL
SELECT * FROM (SELECT c_custkey, c_acctbal, 'bottom' AS side FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10)
""")
def top_bottom_customers(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return R.top_and_bottom(c, "c_acctbal", 10, tiebreak=["c_custkey"])


@register("shared_ordering_nations", "W14", sql="""
WITH a AS (SELECT c_nationkey AS nationkey, count(*) AS n_customers FROM customer GROUP BY 1),
     b AS (SELECT s_nationkey AS nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1)
SELECT nationkey, n_customers, n_suppliers FROM a LEFT JOIN b USING (nationkey)
ORDER BY n_customers DESC, nationkey LIMIT 20
""")
def shared_ordering_nations(spark, sf):
    a = load(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    b = load(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_suppliers"))
    return R.top_k(a.join(b, "nationkey", "left"), "n_customers", 20, tiebreak=["nationkey"])
