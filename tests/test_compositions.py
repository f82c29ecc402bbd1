"""C3, C5, C8, C9, C10 end to end on driver tables at the smallest scale."""

from pyspark.sql import functions as F

from widegrain.models import pipeline as MP
from widegrain.operators import ranking as R
from widegrain.plans import pipelines as PL
from widegrain.plans.tables import ORDER_FEATURE_COLS, flagged, load, order_features


def test_profile_report(spark, sf_dir):
    d = order_features(spark, sf_dir)
    rep = PL.profile_report(d, "revenue", "l_orderkey", k_top=3, heat_k=2)
    assert rep["duplicates"].first()["key_is_unique"]
    assert rep["target_histogram"].agg(F.sum("count")).first()[0] == d.count()
    assert rep["missing_bins"].agg(F.sum("n_columns")).first()[0] == len(d.columns)
    assert rep["top_correlations"].count() == 3
    assert rep["heatmap"].count() == 10       # 5 columns -> lower triangle


def test_model_report(spark, sf_dir):
    d = R.exact_split(order_features(spark, sf_dir), ["l_orderkey"], 0.2, 42)
    train, test = d.where("split = 'train'"), d.where("split = 'test'")
    cands = {k: MP.make_pipeline(ORDER_FEATURE_COLS, "revenue", k, alpha=0.0055, n_components=3)
             for k in ["linear", "ridge"]}
    rep = PL.model_report(train, test, ORDER_FEATURE_COLS, "revenue", "l_orderkey", cands, k=3, n_repeats=2,
                          n_background=10)
    assert rep["cv_per_fold"].count() == 6
    scores = {r["split"]: r["r2"] for r in rep["scores"].collect()}
    assert scores["test"] > 0.5
    assert rep["permutation_importance"].count() == len(ORDER_FEATURE_COLS)
    agree = {r["scope"]: r["n"] for r in rep["importance_agreement"].collect()}
    assert agree == {"all": len(ORDER_FEATURE_COLS), "top20": len(ORDER_FEATURE_COLS)}


def test_flagged_and_merge_and_entity(spark, sf_dir):
    parts = PL.prepare_flagged(flagged(spark, sf_dir), "l_orderkey", named_col="v1_rawvalue",
                               recode_cols=["v1_flag"], key_width=8)
    assert parts["final"].columns[0] == "l_orderkey"
    assert parts["final"].where(F.col("v1_rawvalue").isNull()).count() == 0
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal")
    o = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n_orders"))
    master, dups = PL.merge_master([c, o], "k")
    assert dups.count() == 0 and master.count() == c.count()
    master_u, _ = PL.merge_master([c, o], "k", method="union")
    assert sorted(map(tuple, master_u.collect())) == sorted(map(tuple, master.collect()))
    li = load(spark, sf_dir, "lineitem")
    a = li.where("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"), F.avg("l_tax").alias("t"))
    b = li.where("l_returnflag = 'A'").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"), F.avg("l_tax").alias("t"))
    ent = PL.entity_profile(a, b, "l_suppkey", ["q", "t"], ["q", "t"])
    assert ent["side_by_side"].where("field = 'q'").count() >= a.count()
    assert ent["top_driver"].where("top_driver = 'q'").count() == a.count()
