"""Faults found on hand-made rows that the driver tables do not show."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from widegrain.functions import columns as COL
from widegrain.models import pipeline as MP
from widegrain.models.transformers import CentredPCA, LassoSelector
from widegrain.operators import clean as C
from widegrain.operators import explain as X
from widegrain.operators import reshape as RS
from widegrain.plans import pipelines as P
from widegrain.sources import io as IO


def test_median_of_whole_numbers_is_not_truncated(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, None, 1, 2, 1, 2)], "g string, v int")
    filled = [r["v"] for r in C.group_median_fill(df, ["v"], "g").collect()]
    assert sorted(filled) == [1.0, 1.0, 1.0, 1.5, 2.0, 2.0, 2.0]
    assert 1.5 in [r["v"] for r in C.indicator_impute(df, ["v"]).collect()]
    assert 1.5 in [r["v"] for r in C.indicator_impute_one(df, "v").collect()]


def test_fingerprint_tells_null_places_apart(spark):
    a, b = (spark.createDataFrame([r], "x string, y string") for r in ((None, "x"), ("x", None)))
    c, d = (spark.createDataFrame([r], "x string, y string") for r in (("p|1:q", "r"), ("p", "q|1:r")))
    for method in ("xxhash64", "md5"):
        assert IO.table_fingerprint(a, method=method).first() != IO.table_fingerprint(b, method=method).first()
        assert IO.table_fingerprint(c, method=method).first() != IO.table_fingerprint(d, method=method).first()


def test_na_text_is_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,income,name\n01,12,NA\n02,NA,Bob\n03,1.5,Al\n")
    rows = IO.read_csv(spark, str(tmp_path / "a.csv"), key_cols=["k"]).collect()
    assert [(r["k"], r["income"], r["name"]) for r in rows] == [("01", 12.0, None), ("02", None, "Bob"), ("03", 1.5, "Al")]


def test_family_rule_ignores_case_of_number():
    kept, dropped = COL.family_prune(["laNumber_share", "la_share", "Tract_x", "other", "lapop"])
    assert (kept, dropped) == (["la_share", "Tract_x"], ["laNumber_share", "lapop"])


def test_null_group_keys_go(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "k string, v double")
    assert [r["k"] for r in RS.group_sum_zero(df, ["k"], ["v"]).collect()] == ["a"]
    assert [r["k"] for r in RS.group_mean(df, ["k"], ["v"]).collect()] == ["a"]


def test_labels_are_part_of_the_key(spark):
    df = spark.createDataFrame([("1", None, "m", 1.0), ("1", "Old", "m", 3.0), ("1", "New", "m", 5.0)],
                               "k string, name string, measure string, v double")
    got = P.prepare_long_measures(df, "k", "measure", "v", ["m"], labels=["name"]).collect()
    assert sorted((r["k"], r["name"], r["m"]) for r in got) == [("00001", "New", 5.0), ("00001", "Old", 3.0)]


def test_coefficients_come_sorted(spark):
    rows = X.coefficient_table([0.5, -2.0, 3.0], ["a", "b", "c"]).collect()
    assert [r["feature"] for r in rows] == ["c", "a", "b"]


def _noisy(spark):
    return spark.range(120).select(
        "id", F.cos("id").alias("a"), F.sin(F.col("id") * 3).alias("b"), (100 * F.cos(F.col("id") * 5)).alias("c"),
        (F.cos("id") * 2 + F.sin(F.col("id") * 3)).alias("y"), (F.col("id") % 3).cast("int").alias("fold"))


def test_too_many_components_and_an_empty_selection_raise(spark):
    d = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(_noisy(spark))
    with pytest.raises(ValueError, match="components"):
        CentredPCA(inputCol="f", outputCol="p", k=3).fit(d)
    with pytest.raises(ValueError, match="keeps no feature"):
        LassoSelector(featuresCol="f", labelCol="y", alpha=1e6).fit(d)


def test_kernel_width_follows_the_fitted_vector(spark):
    d = _noisy(spark)
    for settings in ({"reduce": False}, {"n_components": 2}):
        model = MP.make_pipeline(["a", "b", "c"], "y", "svr_rbf", alpha=0.01, n_random_features=20, **settings).fit(d)
        assert model.transform(d).where("prediction IS NULL").count() == 0


def test_report_scores_only_rows_with_a_prediction(spark):
    d = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (90.0, None)], "y double, p double")
    both = MP.regression_report(d, "y", {"p": "p"}).first(), MP.regression_metrics(d, "y", "p").first()
    assert both[0]["r2"] == both[1]["r2"] and both[0]["n"] == both[1]["n"] == 3


def test_scaled_lasso_path_ignores_units(spark):
    d = _noisy(spark)
    one, two = (MP.lasso_cv(x, ["a", "b", "c"], "y", "fold", n_alphas=10, scale=True)
                for x in (d, d.withColumn("b", F.col("b") * 1000)))
    assert one[1] == pytest.approx(two[1]) and one[2] == pytest.approx(two[2], abs=1e-9)
