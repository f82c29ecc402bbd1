"""Driver-table queries for the user-level compositions."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import pipelines as PL
from .registry import register
from .tables import ORDER_FEATURES_SQL, load, order_features, pad_sql, rnd

_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("prepare_long_measures_events", "C1,A1,A2,P2,P3,P5,P7,P9", sql=f"""
SELECT {pad_sql('user_id')} AS user_key, """ + ",\n       ".join(
    f"round(avg(value) FILTER (WHERE event_type = '{t}'), 6) AS {t.upper()}" for t in _EVENT_TYPES) + """
FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL AND event_type IN ('click', 'error', 'purchase', 'signup', 'view')
GROUP BY user_id
""")
def prepare_long_measures_events(spark, sf):
    ev = load(spark, sf, "events")
    w = PL.prepare_long_measures(ev, "user_id", "event_type", "value", _EVENT_TYPES, drop_cols=["props"],
                                 rename={"user_id": "user_key", **{t: t.upper() for t in _EVENT_TYPES}})
    return w.select("user_key", *[rnd(t.upper()).alias(t.upper()) for t in _EVENT_TYPES])


_FINE_SQL = {
    "tract_key": f"{pad_sql('l_suppkey')} || {pad_sql('l_orderkey', 8)}",
    "grp": "l_returnflag",
    "pop": "l_quantity",
    "disc_flag": "CAST(l_discount > 0.05 AS INTEGER)",
    "disc_share": "CASE WHEN l_orderkey % 10 = 1 THEN NULL ELSE l_discount + 0.0 END",
    "lahalf_share": "CASE WHEN l_orderkey % 10 < 3 THEN NULL ELSE l_tax + 0.0 END",
    "price": "l_extendedprice",
    "lafar_share": "CASE WHEN l_orderkey % 10 < 7 THEN NULL ELSE l_tax + 0.0 END",
}
_FINE_VIEW = "(SELECT " + ", ".join(f"{e} AS {c}" for c, e in _FINE_SQL.items()) + " FROM lineitem)"


@register("prepare_fine_grain_lineitem", "C2,I1,W1,P8,P11,A5,A6,P7", sql=f"""
WITH f AS {_FINE_VIEW},
c AS (SELECT tract_key, grp, pop, disc_flag, price,
             coalesce(disc_share, median(disc_share) OVER (PARTITION BY grp)) AS disc_share,
             coalesce(lahalf_share, 0.0) AS lahalf_share, substr(tract_key, 1, 5) AS fipscode FROM f)
SELECT fipscode,
       round(coalesce(sum(disc_flag * pop), 0) / nullif(sum(pop), 0), 6) AS disc_flag,
       round(coalesce(sum(disc_share * pop), 0) / nullif(sum(pop), 0), 6) AS disc_share,
       round(coalesce(sum(lahalf_share * pop), 0) / nullif(sum(pop), 0), 6) AS lahalf_share,
       round(coalesce(sum(pop), 0), 6) AS pop, round(coalesce(sum(price), 0), 4) AS price,
       min({{'o': tract_key, 'l': grp}}).l AS grp
FROM c GROUP BY fipscode
""")
def prepare_fine_grain_lineitem(spark, sf):
    li = load(spark, sf, "lineitem")
    fine = li.select(*[F.expr(e).alias(c) for c, e in _FINE_SQL.items()])
    out = PL.prepare_fine_grain(fine, "tract_key", "pop", "grp", coarse_len=5)
    return out.select("fipscode", *[rnd(c).alias(c) for c in ["disc_flag", "disc_share", "lahalf_share", "pop"]],
                      F.round("price", 4).alias("price"), "grp")


_MD5 = "md5('42:' || CAST(l_orderkey AS VARCHAR))"


@register("engineer_and_split_orders", "C7,P2,P13,P18,W12,P19", sql=f"""
WITH d AS (SELECT l_orderkey, revenue, sum_qty, n_lines, avg_retail, (avg_disc + avg_tax) / 2 AS disc_tax_mean
           FROM {ORDER_FEATURES_SQL} WHERE revenue IS NOT NULL)
SELECT l_orderkey, round(revenue, 6) AS revenue, round(sum_qty, 6) AS sum_qty, n_lines,
       round(disc_tax_mean, 6) AS disc_tax_mean,
       CASE WHEN row_number() OVER (ORDER BY {_MD5}) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS part
FROM d
""")
def engineer_and_split_orders(spark, sf):
    d = order_features(spark, sf)
    e = PL.engineer(d, "revenue", {"disc_tax_mean": ("avg_disc", "avg_tax")}, family_prefixes=("avg",),
                    keep_any=("share",), drop_any=())
    parts = PL.split(e, "l_orderkey", "revenue")
    out = None
    for part in ("train", "test"):
        t = parts[f"x_{part}"].join(parts[f"y_{part}"], "l_orderkey").withColumn("part", F.lit(part))
        out = t if out is None else out.unionByName(t)
    return out.select("l_orderkey", rnd("revenue").alias("revenue"), rnd("sum_qty").alias("sum_qty"), "n_lines",
                      rnd("disc_tax_mean").alias("disc_tax_mean"), "part")
