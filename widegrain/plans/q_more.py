"""Driver-table queries for the compositions and helpers that chain several
operators: persisted tables, merges with repeated keys, report headers, scored
entities, derived columns and column selection by name."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import columns as COL
from ..functions.keys import pad_key
from ..functions.scalars import coerce_numeric, safe_ratio
from ..models import foldfits as FF
from ..models import pipeline as MP
from ..operators import clean as C
from ..operators import profile as P
from ..operators import ranking as R
from ..operators import reshape as RS
from ..operators import stats as S
from ..session import cut_lineage
from ..sources import io as IO
from . import pipelines as PL
from . import q_clean, q_models, q_reshape
from .registry import ORACLE, register
from .tables import ORDER_FEATURE_COLS, ORDER_FEATURES_SQL, flagged, load, order_features, pad_sql, part_gaps, part_gaps_sql, rnd

# ---- sources and tables ---------------------------------------------------- #


@register("csv_roundtrip_supplier", "S1,S6", sql=f"""
SELECT {pad_sql('s_suppkey')} AS supp_key, s_name, s_nationkey, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier
""")
def csv_roundtrip_supplier(spark, sf):
    s = load(spark, sf, "supplier").select(pad_key("s_suppkey").alias("supp_key"), "s_name", "s_nationkey",
                                           F.expr("CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_acctbal END").alias("s_acctbal"))
    path = IO.scratch_path(spark, "csv")
    IO.write_files(s, path, "csv")
    return IO.read_csv(spark, path, key_cols=["supp_key"]).withColumn("s_nationkey", F.col("s_nationkey").cast("int"))


@register("select_variables_events", "S11", sql="""
SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('purchase', 'signup')
""")
def select_variables_events(spark, sf):
    return IO.select_variables(load(spark, sf, "events"), "event_type", ["purchase", "signup"]).select("event_id", "user_id", "event_type", "value")


@register("persisted_tables_customer", "S7,S8,S5,S4,C6,S12", sql="""
SELECT c_custkey, c_name, c_acctbal, 'kept' AS state FROM customer WHERE c_acctbal > 0
UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'fallback' FROM supplier
""")
def persisted_tables_customer(spark, sf):
    """A table replaced by a second version, and one that is empty and falls
    back to another, both persisted in a folder and read back by name."""
    tag, folder = f"wg{uuid.uuid4().hex[:8]}", IO.scratch_path(spark, "tables")
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"))
    main, spare, empty = f"{tag}_customer", f"{tag}_supplier", f"{tag}_empty"
    IO.replace_table(spark, main, c, folder)
    IO.replace_table(spark, main, IO.read_table(spark, main).where("c_acctbal > 0"), folder)
    IO.bootstrap_tables(spark, {spare: lambda: s, empty: lambda: s.limit(0)}, {empty: spare}, folder)
    IO.require_tables(spark, [main, spare, empty])
    kept, other = IO.read_table(spark, main), IO.read_table(spark, empty)
    return kept.withColumn("state", F.lit("kept")).unionByName(other.withColumn("state", F.lit("fallback")))


# ---- merges ---------------------------------------------------------------- #


@register("merge_master_customer_sources", "C5,J1,P22,P7,A17", sql=ORACLE["outer_merge_customer_sources"])
def merge_master_customer_sources(spark, sf):
    master, _ = PL.merge_master(q_reshape.customer_sources(spark, sf), "cust_key")
    return master.withColumn("last_activity", F.date_format("last_activity", "yyyy-MM-dd HH:mm:ss"))


_HOT = "CASE WHEN {k} % 3 = 0 THEN 0 ELSE {n} END"


@register("outer_merge_hot_key", "J1,P22", sql=f"""
WITH a AS (SELECT {_HOT.format(k='c_custkey', n='c_nationkey')} AS nation, c_custkey, c_acctbal AS balance FROM customer),
     b AS (SELECT {_HOT.format(k='s_suppkey', n='s_nationkey + 5')} AS nation, s_suppkey, s_acctbal AS balance FROM supplier)
SELECT nation, c_custkey, coalesce(a.balance, b.balance) AS balance, s_suppkey FROM a FULL JOIN b USING (nation)
""")
def outer_merge_hot_key(spark, sf):
    """Repeated keys on both sides, one of them a third of all rows."""
    a = load(spark, sf, "customer").select(F.expr(_HOT.format(k="c_custkey", n="c_nationkey")).alias("nation"), "c_custkey", F.col("c_acctbal").alias("balance"))
    b = load(spark, sf, "supplier").select(F.expr(_HOT.format(k="s_suppkey", n="s_nationkey + 5")).alias("nation"), "s_suppkey", F.col("s_acctbal").alias("balance"))
    n = a.count()
    return RS.outer_merge([a, b], "nation", hot_rows=max(10, n // 10))


# ---- preparation of keyed and flagged tables ------------------------------- #


@register("prepare_flagged_lineitem", "C3,I6,P6,P7", sql=ORACLE["reliability_clean_lineitem"].replace(
    "SELECT l_orderkey,\n       round(CASE", f"SELECT {pad_sql('l_orderkey')} AS l_orderkey,\n       round(CASE"))
def prepare_flagged_lineitem(spark, sf):
    final = PL.prepare_flagged(flagged(spark, sf), "l_orderkey", named_col="v1_rawvalue", recode_cols=["v1_flag"])["final"]
    return final.select(*[rnd(c).alias(c) if c in ("v1_rawvalue", "v2_rawvalue") else c for c in final.columns])


@register("prepare_keyed_part", "C4,P7,P2,P5", sql=f"""
SELECT {pad_sql('p_partkey')} AS p_partkey, p_type AS kind, price_gap AS price FROM {part_gaps_sql()} WHERE price_gap IS NOT NULL
""")
def prepare_keyed_part(spark, sf):
    p = part_gaps(spark, sf).select("p_partkey", "p_type", "price_gap")
    return PL.prepare_keyed(p, "p_partkey", required=["price_gap"], rename={"p_type": "kind", "price_gap": "price"})


@register("named_fill_lineitem", "I4", sql=q_clean._REL + """,
m AS (SELECT median(v1_rawvalue) AS m1 FROM r)
SELECT l_orderkey, v1_flag, round(CASE WHEN v1_rawvalue IS NULL OR v1_rawvalue = -1 THEN m1 ELSE v1_rawvalue END, 6) AS v1_rawvalue,
       CAST(v1_rawvalue IS NULL OR v1_rawvalue = -1 AS INTEGER) AS v1_is_missing
FROM r, m
""")
def named_fill_lineitem(spark, sf):
    rel = C.reliability_expand(flagged(spark, sf)).select("l_orderkey", "v1_flag", "v1_rawvalue")
    out = C.indicator_impute_one(rel, "v1_rawvalue", indicator="v1_is_missing")
    return out.withColumn("v1_rawvalue", rnd("v1_rawvalue"))


@register("tiered_indicators_part", "I8,I1,W1", sql=f"""
SELECT p_partkey, round(coalesce(price_gap, median(price_gap) OVER (PARTITION BY p_type)), 6) AS price_gap,
       round(size_gap, 6) AS size_gap, CAST(size_gap IS NULL AS INTEGER) AS size_gap_is_missing
FROM {part_gaps_sql()}
""")
def tiered_indicators_part(spark, sf):
    policy = C.MissingPolicy(indicate_between=True)
    c = C.tiered_clean(part_gaps(spark, sf).drop("la_size_share", "lafar_share", "size_gap7"), "p_type", policy, protect=["p_partkey"])
    return c.select("p_partkey", rnd("price_gap").alias("price_gap"), rnd("size_gap").alias("size_gap"), "size_gap_is_missing")


@register("cleaning_checks_part", "A22", sql=f"""
WITH b AS {part_gaps_sql()},
     a AS (SELECT p_partkey, p_name, coalesce(price_gap, median(price_gap) OVER (PARTITION BY p_type)) AS price_gap FROM b)
SELECT 'rows_kept' AS check, CAST((SELECT count(*) FROM a) AS DOUBLE) AS observed, CAST((SELECT count(*) FROM b) AS DOUBLE) AS expected, true AS ok
UNION ALL SELECT 'nulls_left', CAST(count(*) FILTER (WHERE price_gap IS NULL) AS DOUBLE), 0.0, count(*) FILTER (WHERE price_gap IS NULL) = 0 FROM a
UNION ALL SELECT 'values_changed', CAST(count(*) FILTER (WHERE a.p_name IS DISTINCT FROM b.p_name OR a.price_gap <> b.price_gap) AS DOUBLE), 0.0,
       count(*) FILTER (WHERE a.p_name IS DISTINCT FROM b.p_name OR a.price_gap <> b.price_gap) = 0 FROM a JOIN b USING (p_partkey)
""")
def cleaning_checks_part(spark, sf):
    before = part_gaps(spark, sf)
    after = C.group_median_fill(before, ["price_gap"], "p_type")
    return P.cleaning_checks(before, after, "p_partkey", ["price_gap"], ["p_name", "p_type"])


# ---- columns by name, derived columns, choices ----------------------------- #

_MATCHED = ["l_extendedprice", "l_discount", "l_tax"]


@register("columns_by_name_lineitem", "P10,A18", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean FROM lineitem" for c in _MATCHED))
def columns_by_name_lineitem(spark, sf):
    li = load(spark, sf, "lineitem")
    names = COL.columns_matching(li.columns, suffix=["PRICE", "tax"], contains="disc")
    means = li.agg(*[F.avg(c).alias(c) for c in names]).unpivot([], names, "column_name", "mean")
    return means.select("column_name", rnd("mean").alias("mean"))


@register("derived_measures_customer", "P13,P4", sql="""
WITH o AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spent FROM orders GROUP BY 1)
SELECT c_custkey, round(spent / n_orders, 7) AS price_per_order, round(n_orders / nullif(c_acctbal, 0) * 100000, 4) AS orders_per_100k,
       round(c_acctbal / 1000, 6) AS balance_k
FROM customer LEFT JOIN o ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'
""")
def derived_measures_customer(spark, sf):
    o = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spent"))
    c = COL.choice_filter(load(spark, sf, "customer"), {"c_mktsegment": "BUILDING", "c_nationkey": "All"})
    j = c.join(o, c["c_custkey"] == o["o_custkey"], "left")
    return j.select("c_custkey", F.round(safe_ratio("spent", "n_orders"), 7).alias("price_per_order"),
                    F.round(safe_ratio("n_orders", "c_acctbal", 100_000), 4).alias("orders_per_100k"),
                    rnd(F.col("c_acctbal") / 1000).alias("balance_k"))


@register("family_pruned_part", "P18,C7", sql="""
SELECT p_partkey, la_share, TractPop FROM (
  SELECT p_partkey, CAST(p_size AS DOUBLE) / 50 AS la_share, p_size AS la_number_share, p_retailprice AS lafar, p_size AS TractPop FROM part)
""")
def family_pruned_part(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", (F.col("p_size").cast("double") / 50).alias("la_share"), F.col("p_size").alias("la_number_share"),
                                       F.col("p_retailprice").alias("lafar"), F.col("p_size").alias("TractPop"))
    _, dropped = COL.family_prune(p.columns)
    return p.drop(*dropped)


# ---- report headers and consistency ---------------------------------------- #

_SOURCES = {"lineitem": ["revenue", "sum_qty", "n_lines", "avg_disc", "avg_tax"], "part": ["avg_retail"]}


@register("report_header_orders", "A29,C8,P15", sql=f"""
WITH d AS (SELECT *, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE revenue END AS target FROM {ORDER_FEATURES_SQL})
SELECT 'total_records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM d
UNION ALL SELECT 'usable_targets', CAST(count(target) AS DOUBLE) FROM d
UNION ALL SELECT 'duplicate_records', 0.0
UNION ALL SELECT 'missing_pct', round(100.0 * (count(*) - count(target)) / count(*) / 8, 2) FROM d
UNION ALL SELECT 'columns_lineitem', 5.0
UNION ALL SELECT 'columns_part', 1.0
UNION ALL SELECT 'train_samples', CAST(count(*) - ceil(0.2 * count(*)) AS DOUBLE) FROM d
UNION ALL SELECT 'test_samples', CAST(ceil(0.2 * count(*)) AS DOUBLE) FROM d
""")
def report_header_orders(spark, sf):
    d = cut_lineage(order_features(spark, sf).withColumn("target", F.expr("CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE revenue END")))
    parts = R.exact_split(d, ["l_orderkey"], 0.2, 42)
    counted = {r["source"]: r["n"] for r in COL.source_counts(COL.source_catalog(spark, _SOURCES)).collect()}  # one row per source
    return PL.profile_report(d, "target", "l_orderkey", sources={k: range(n) for k, n in counted.items()},
                             train=parts.where("split = 'train'"), test=parts.where("split = 'test'"))["header"]


@register("cross_source_consistency", "A30,A14,J1", sql="""
WITH a AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS from_lines FROM lineitem GROUP BY 1),
     b AS (SELECT o_orderkey AS k, o_totalprice AS from_orders FROM orders)
SELECT count(*) AS n, round(corr(from_lines, from_orders), 6) AS r FROM a JOIN b USING (k)
""")
def cross_source_consistency(spark, sf):
    """Two estimates of an order's price, from two sources, after their merge."""
    a = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_extendedprice").alias("from_lines"))
    b = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("from_orders"))
    return S.pair_consistency(RS.outer_merge([a, b], "k", method="union"), "from_lines", "from_orders").select("n", rnd("r").alias("r"))


# ---- scoring --------------------------------------------------------------- #


@register("scored_orders", "M20,P16,C10", sql=f"""
WITH d AS {ORDER_FEATURES_SQL},
     {q_models._swept_sql(ORDER_FEATURE_COLS, 'd')}
SELECT l_orderkey, round({q_models._linear_sql(ORDER_FEATURE_COLS)}, 3) AS prediction FROM d, coef
""")
def scored_orders(spark, sf):
    d = cut_lineage(order_features(spark, sf))
    model = q_models._ols_model(d, ORDER_FEATURE_COLS)
    unordered = d.select("avg_tax", "l_orderkey", "n_lines", "avg_retail", "sum_qty", "avg_disc", F.lit(1).alias("extra"))
    score = PL.entity_profile(unordered, unordered, "l_orderkey", ["n_lines"], ORDER_FEATURE_COLS, "All", model, ORDER_FEATURE_COLS)["score"]
    return score.select("l_orderkey", F.round("prediction", 3).alias("prediction"))


@register("retrained_test_errors", "M27,A27,J4", sql=q_models._SPLIT + """
SELECT count(*) AS n, round(1 - sum((revenue - pred) ^ 2) / (count(*) * var_pop(revenue)), 6) AS r2,
       round(sqrt(avg((revenue - pred) ^ 2)), 6) AS rmse, round(avg(abs(revenue - pred)), 6) AS mae,
       round(max(abs(revenue - pred)), 4) AS largest FROM p WHERE split = 'test'
""")
def retrained_test_errors(spark, sf):
    d = cut_lineage(R.exact_split(order_features(spark, sf), ["l_orderkey"], 0.2, 42))
    pipe = MP.make_pipeline(["sum_qty"], "revenue", "linear", select=False, reduce=False)
    _, scores, resid = MP.train_and_evaluate(d.where("split = 'train'"), d.where("split = 'test'"), pipe, "revenue", "l_orderkey")
    worst = float(resid.agg(F.max("abs_error")).first()[0])
    return scores.select("n", *[rnd(c).alias(c) for c in ("r2", "rmse", "mae")], F.round(F.lit(worst), 4).alias("largest"))


@register("final_scores_orders", "M28,M18,M31", sql=q_models._SPLIT + """,
     tr AS (SELECT *, (row_number() OVER (ORDER BY md5('42:' || CAST(l_orderkey AS VARCHAR))) - 1) % 5 AS fold FROM d WHERE split = 'train'),
     fit AS (SELECT v.f, covar_pop(sum_qty, revenue) / var_pop(sum_qty) AS b,
                    avg(revenue) - covar_pop(sum_qty, revenue) / var_pop(sum_qty) * avg(sum_qty) AS a
             FROM (SELECT DISTINCT fold AS f FROM tr) v JOIN tr ON tr.fold <> v.f GROUP BY v.f),
     per AS (SELECT fold, 1 - sum((revenue - a - b * sum_qty) ^ 2) / (count(*) * var_pop(revenue)) AS r2,
                    sqrt(avg((revenue - a - b * sum_qty) ^ 2)) AS rmse, avg(abs(revenue - a - b * sum_qty)) AS mae
             FROM tr JOIN fit ON f = fold GROUP BY fold)
SELECT split, count(*) AS n, round(1 - sum((revenue - pred) ^ 2) / (count(*) * var_pop(revenue)), 6) AS r2,
       round(sqrt(avg((revenue - pred) ^ 2)), 6) AS rmse, round(avg(abs(revenue - pred)), 6) AS mae FROM p GROUP BY split
UNION ALL SELECT 'mean_baseline_test', count(*), round(1 - sum((revenue - ybar) ^ 2) / (count(*) * var_pop(revenue)), 6),
       round(sqrt(avg((revenue - ybar) ^ 2)), 6), round(avg(abs(revenue - ybar)), 6) FROM p WHERE split = 'test'
UNION ALL SELECT 'cv', NULL, round(avg(r2), 6), round(avg(rmse), 6), round(avg(mae), 6) FROM per
""")
def final_scores_orders(spark, sf):
    d = cut_lineage(R.exact_split(order_features(spark, sf), ["l_orderkey"], 0.2, 42))
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    settings = {"kind": "linear", "alpha": None, "n_components": None}
    model = MP.make_pipeline(["sum_qty"], "revenue", "linear", select=False, reduce=False).fit(train)
    scores = MP.score_table({"train": model.transform(train), "test": model.transform(test),
                             "mean_baseline_test": MP.mean_baseline(train, test, "revenue")}, "revenue")
    moments = FF.fold_moments(R.kfold_assign(train.drop("split"), ["l_orderkey"], 5, 42), ["sum_qty"], "revenue", "fold")
    _, cv = FF.linear_scores(moments, {"linear": settings})
    row = cv.select(F.lit("cv").alias("split"), F.lit(None).cast("long").alias("n"), *[F.col(f"{c}_mean").alias(c) for c in ("r2", "rmse", "mae")])
    both = scores.select("split", "n", "r2", "rmse", "mae").unionByName(row)
    return both.select("split", "n", *[rnd(c).alias(c) for c in ("r2", "rmse", "mae")])
