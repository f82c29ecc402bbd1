"""Driver-table queries for pivots, grain changes, merges and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.keys import key_check, key_prefix, pad_key
from ..operators.reshape import (group_sum_zero, left_chain, left_lookup, outer_merge, pivot_mean,
                                 side_by_side, transpose, unmatched, weighted_rollup)
from .registry import register
from .tables import lineitem_gaps, lineitem_gaps_sql, load, pad_sql, rnd

RETURN_FLAGS = ["A", "N", "R"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("pivot_quantity_by_returnflag", "A1,A2", sql="""
SELECT l_suppkey,
       round(avg(l_quantity) FILTER (WHERE l_returnflag = 'A'), 6) AS avg_qty_a,
       round(avg(l_quantity) FILTER (WHERE l_returnflag = 'N'), 6) AS avg_qty_n,
       round(avg(l_quantity) FILTER (WHERE l_returnflag = 'R'), 6) AS avg_qty_r
FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey
""")
def pivot_quantity_by_returnflag(spark, sf):
    li = load(spark, sf, "lineitem")
    names = {v: f"avg_qty_{v.lower()}" for v in RETURN_FLAGS}
    w = pivot_mean(li, "l_suppkey", "l_returnflag", "l_quantity", RETURN_FLAGS, names)
    return w.select("l_suppkey", *[rnd(n).alias(n) for n in names.values()])


@register("pivot_value_by_event_type", "A1,A2", sql="""
SELECT user_id, """ + ",\n       ".join(
    f"round(avg(value) FILTER (WHERE event_type = '{t}'), 6) AS avg_{t}" for t in EVENT_TYPES) + """
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
""")
def pivot_value_by_event_type(spark, sf):
    ev = load(spark, sf, "events")
    names = {t: f"avg_{t}" for t in EVENT_TYPES}
    w = pivot_mean(ev, "user_id", "event_type", "value", EVENT_TYPES, names)
    return w.select("user_id", *[rnd(n).alias(n) for n in names.values()])


_DISC_NULL = "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount + 0.0 END"


@register("rollup_lineitem_to_supplier", "A3,A4,A5,A6,A7", sql=f"""
WITH t AS (
  SELECT l_suppkey, l_orderkey, l_quantity, l_extendedprice, l_returnflag,
         CAST(l_discount > 0.05 AS INTEGER) AS disc_flag, {_DISC_NULL} AS disc_rate
  FROM lineitem)
SELECT l_suppkey,
       count(*) AS n_rows,
       round(coalesce(sum(disc_flag * l_quantity), 0) / nullif(sum(l_quantity), 0), 6) AS disc_flag,
       round(coalesce(sum(disc_rate * l_quantity), 0) / nullif(sum(l_quantity), 0), 6) AS disc_rate,
       round(coalesce(sum(l_extendedprice), 0), 6) AS l_extendedprice,
       round(coalesce(sum(l_quantity), 0), 6) AS weight_total,
       round(avg(l_extendedprice), 6) AS mean_price,
       min({{'o': l_orderkey, 'l': l_returnflag}}).l AS first_flag
FROM t GROUP BY l_suppkey
""")
def rollup_lineitem_to_supplier(spark, sf):
    li = load(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag",
        (F.col("l_discount") > 0.05).cast("int").alias("disc_flag"),
        F.expr(_DISC_NULL).alias("disc_rate"))
    r = weighted_rollup(li, "l_suppkey", "l_quantity", flags=["disc_flag"], rates=["disc_rate"],
                        counts=["l_extendedprice"], labels={"l_returnflag": "first_flag"},
                        label_order="l_orderkey", weight_sum_col="weight_total",
                        means={"l_extendedprice": "mean_price"})
    return r.select("l_suppkey", "n_rows", *[rnd(c).alias(c) for c in
                    ["disc_flag", "disc_rate", "l_extendedprice", "weight_total", "mean_price"]],
                    "first_flag")


_TS = "yyyy-MM-dd HH:mm:ss"


@register("outer_merge_customer_sources", "J1,P22,P7,C5", sql=f"""
WITH c AS (SELECT {pad_sql('c_custkey')} AS cust_key, c_nationkey, c_acctbal, c_mktsegment FROM customer),
     o AS (SELECT {pad_sql('o_custkey')} AS cust_key, count(*) AS n_orders,
                  round(sum(o_totalprice), 4) AS sum_totalprice, max(o_orderdate) AS last_activity
           FROM orders GROUP BY 1),
     e AS (SELECT {pad_sql('user_id')} AS cust_key, count(*) AS n_events,
                  round(sum(value), 4) AS sum_value, max(ts) AS last_activity
           FROM events GROUP BY 1)
SELECT cust_key, c_nationkey, c_acctbal, c_mktsegment, n_orders, sum_totalprice,
       strftime(coalesce(o.last_activity, e.last_activity), '%Y-%m-%d %H:%M:%S') AS last_activity,
       n_events, sum_value
FROM c FULL JOIN o USING (cust_key) FULL JOIN e USING (cust_key)
WHERE cust_key IS NOT NULL
""")
def outer_merge_customer_sources(spark, sf):
    m = outer_merge(customer_sources(spark, sf), "cust_key", method="union")   # keys unique per source (checked in-plan)
    return m.withColumn("last_activity", F.date_format("last_activity", _TS))


def customer_sources(spark, sf):
    """Customers, and their orders and events added up, by padded key."""
    c = load(spark, sf, "customer").select(pad_key("c_custkey").alias("cust_key"),
                                            "c_nationkey", "c_acctbal", "c_mktsegment")
    o = (load(spark, sf, "orders").groupBy(pad_key("o_custkey").alias("cust_key"))
         .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 4).alias("sum_totalprice"),
              F.max("o_orderdate").alias("last_activity")))
    e = (load(spark, sf, "events").groupBy(pad_key("user_id").alias("cust_key"))
         .agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 4).alias("sum_value"),
              F.max("ts").alias("last_activity")))
    return [c, o, e]


@register("documents_left_labels", "J2,S9", sql="""
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def documents_left_labels(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return left_lookup(d, load(spark, sf, "labels"), "doc_id")


@register("documents_unlabeled", "J7", sql="""
SELECT d.doc_id, d.lang, d.source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def documents_unlabeled(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "lang", "source")
    return unmatched(d, load(spark, sf, "labels").select("doc_id"), "doc_id")


@register("key_padding", "P7,P8", sql=f"""
SELECT c_custkey, {pad_sql('c_custkey')} AS cust_key, {pad_sql('c_custkey', 3)} AS key3,
       substr({pad_sql('c_custkey')}, 1, 2) AS key_prefix
FROM customer
""")
def key_padding(spark, sf):
    c = load(spark, sf, "customer")
    k = pad_key("c_custkey")
    return c.select("c_custkey", k.alias("cust_key"), pad_key("c_custkey", 3).alias("key3"),
                    key_prefix(k, 2).alias("key_prefix"))


@register("key_validation", "P21", sql=f"""
SELECT 'cust_key' AS key, true AS is_string, count(*) AS n_rows,
       count(*) FILTER (WHERE k IS NULL) AS n_null, CAST(min(length(k)) AS INTEGER) AS min_len,
       CAST(max(length(k)) AS INTEGER) AS max_len,
       count(*) FILTER (WHERE length(k) <> 3) AS n_bad_len,
       count(*) FILTER (WHERE length(k) <> 3) = 0 AS ok
FROM (SELECT {pad_sql('c_custkey', 3)} AS k FROM customer)
""")
def key_validation(spark, sf):
    c = load(spark, sf, "customer").select(pad_key("c_custkey", 3).alias("cust_key"))
    return key_check(c, "cust_key", 3)


_FACTS = ["n_lines", "sum_qty", "avg_price"]


def _supplier_facts(li, flag):
    return (li.where(F.col("l_returnflag") == flag).groupBy("l_suppkey")
            .agg(F.count(F.lit(1)).cast("double").alias("n_lines"),
                 F.sum("l_quantity").alias("sum_qty"),
                 F.round(F.avg("l_extendedprice"), 6).alias("avg_price")))


@register("supplier_side_by_side", "J5,P14,C10", sql="""
WITH a AS (SELECT l_suppkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS sum_qty,
                  round(avg(l_extendedprice), 6) AS avg_price FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
     b AS (SELECT l_suppkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS sum_qty,
                  round(avg(l_extendedprice), 6) AS avg_price FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
     la AS (UNPIVOT a ON n_lines, sum_qty, avg_price INTO NAME field VALUE value_a),
     lb AS (UNPIVOT b ON n_lines, sum_qty, avg_price INTO NAME field VALUE value_b)
SELECT l_suppkey, field, value_a, value_b FROM la FULL JOIN lb USING (l_suppkey, field)
""")
def supplier_side_by_side(spark, sf):
    li = load(spark, sf, "lineitem")
    return side_by_side(_supplier_facts(li, "R"), _supplier_facts(li, "A"), "l_suppkey", _FACTS)


@register("supplier_transpose", "P14", sql="""
SELECT s_suppkey, field, value FROM (
  UNPIVOT (SELECT s_suppkey, CAST(s_nationkey AS DOUBLE) AS s_nationkey, s_acctbal FROM supplier)
  ON s_nationkey, s_acctbal INTO NAME field VALUE value)
""")
def supplier_transpose(spark, sf):
    s = load(spark, sf, "supplier")
    return transpose(s, ["s_suppkey"], ["s_nationkey", "s_acctbal"])


@register("left_chain_customer_sources", "J3,J2", sql=f"""
WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY 1),
     e AS (SELECT user_id AS c_custkey, count(*) AS n_events FROM events GROUP BY 1)
SELECT c_custkey, c_nationkey, n_orders, n_events FROM customer LEFT JOIN o USING (c_custkey) LEFT JOIN e USING (c_custkey)
""")
def left_chain_customer_sources(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    o = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    e = load(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_events"))
    return left_chain(c, [o, e], "c_custkey")


@register("group_sums_zero_fill", "A4", sql="""
SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_lines,
       round(coalesce(sum(CASE WHEN l_orderkey % 10 < 7 THEN NULL ELSE l_discount * 10 END), 0), 6) AS la_share_70,
       round(coalesce(sum(CASE WHEN l_orderkey % 10 < 3 THEN NULL ELSE l_extendedprice END), 0), 6) AS price_30
FROM lineitem GROUP BY l_orderkey
""")
def group_sums_zero_fill(spark, sf):
    g = lineitem_gaps(spark, sf)
    s = group_sum_zero(g, ["l_orderkey"], ["la_share_70", "price_30"])
    n = g.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return n.join(s, "l_orderkey").select("l_orderkey", "n_lines", rnd("la_share_70").alias("la_share_70"),
                                          rnd("price_30").alias("price_30"))


@register("complete_cases_lineitem", "P20,P2", sql="""
SELECT l_orderkey, l_line, l_returnflag FROM """ + lineitem_gaps_sql() + """
WHERE tax_3 IS NOT NULL AND disc_10 IS NOT NULL AND price_30 IS NOT NULL
""")
def complete_cases_lineitem(spark, sf):
    g = lineitem_gaps(spark, sf)
    return g.na.drop("any", subset=["tax_3", "disc_10", "price_30"]).select("l_orderkey", "l_line", "l_returnflag")
