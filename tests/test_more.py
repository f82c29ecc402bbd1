"""Merges with hot keys, persisted tables, guards, scoring and cleaning checks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from widegrain.operators import clean as C
from widegrain.operators import profile as P
from widegrain.operators import reshape as RS
from widegrain.plans import pipelines as PL
from widegrain.sources import io as IO


@pytest.mark.parametrize("hot_rows", [1, 5, 30, 10 ** 6])
def test_split_full_join_equals_the_plain_one(spark, hot_rows):
    a = spark.createDataFrame([(k, i, f"a{i}") for i, k in enumerate([1] * 40 + [2] * 7 + [3, 4, 5, 5, None] + [9] * 35)], "k int, x int, name string")
    b = spark.createDataFrame([(k, i, f"b{i}") for i, k in enumerate([1] * 3 + [2] * 8 + [4, 6, 6, None] + [8] * 40)], "k int, y int, name string")
    rows = [Counter(map(tuple, RS.outer_merge([a, b], "k", method=m, hot_rows=hot_rows).collect())) for m in ("join", "split")]
    assert rows[0] == rows[1] and sum(rows[0].values()) == 120 + 56 + 1 + 1 + 2 + 35 + 2 + 40
    empty = RS.outer_merge([a, b.limit(0)], "k", hot_rows=hot_rows)
    assert empty.where("k IS NOT NULL").count() == 86
    with pytest.raises(ValueError):
        RS.outer_merge([a, b], "k", method="other")


def test_replaced_table_shows_one_version_or_the_other(spark):
    folder, name = IO.scratch_path(spark, "t"), "wgtest_replaced"
    first = IO.replace_table(spark, name, spark.range(5), folder)
    assert spark.table(name).count() == 5
    with pytest.raises(Exception, match="boom"):
        IO.replace_table(spark, name, spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), folder)
    assert spark.table(name).count() == 5
    second = IO.replace_table(spark, name, spark.table(name).where("id > 2").withColumn("more", F.lit(1)), folder)
    assert sorted(map(tuple, spark.table(name).collect())) == [(3, 1), (4, 1)]
    assert not spark.catalog.tableExists(first) and spark.catalog.tableExists(second)


def test_optional_tables_are_left_out_with_a_warning(spark):
    spark.range(1).createOrReplaceTempView("wgtest_there")
    with pytest.warns(UserWarning, match="wgtest_absent"):
        assert IO.existing_only(spark, ["wgtest_there", "wgtest_absent"]) == ["wgtest_there"]
    with pytest.raises(FileNotFoundError):
        IO.require_tables(spark, ["wgtest_absent"])


def test_cleaning_checks_tell_what_went_wrong(spark):
    before = spark.createDataFrame([(1, 2.0, "a"), (2, None, "b"), (3, 4.0, "c")], "k int, v double, t string")
    bad = spark.createDataFrame([(1, 2.5, "a"), (2, None, "x")], "k int, v double, t string")
    got = {r["check"]: (r["observed"], r["expected"], r["ok"]) for r in P.cleaning_checks(before, bad, "k", ["v"], ["t"]).collect()}
    assert got == {"rows_kept": (2.0, 3.0, False), "nulls_left": (2.0, 0.0, False), "values_changed": (3.0, 0.0, False)}


def test_metadata_split_by_role(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "key int, v1_cilow int, v1_rawvalue int, v1_flag_suppressed int, cilow_unreliable int")
    meta, feats = C.split_metadata(df, "key")
    assert meta.columns == ["key", "v1_cilow", "cilow_unreliable"] and feats.columns == ["key", "v1_rawvalue", "v1_flag_suppressed", "cilow_unreliable"]


def test_scoring_aligns_and_raises(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from widegrain.models import pipeline as MP
    d = spark.createDataFrame([(i, float(i), float(i % 3), 2.0 * i + i % 3) for i in range(20)], "k int, a double, b double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), MP.make_regressor("linear", "features", "y")]).fit(d)
    got = {r["k"]: r["prediction"] for r in PL.score_entities(model, d.select("b", "k", "a"), ["a", "b"], "k").collect()}
    assert got == pytest.approx({i: 2.0 * i + i % 3 for i in range(20)})
    with pytest.raises(ValueError, match="absent"):
        PL.score_entities(model, d.select("k", "a"), ["a", "b"], "k")
    assert PL.score_entities(model, d.select("k", "a"), ["a", "b"], "k", fill_absent=True).where("k = 1").first()["prediction"] == pytest.approx(2.0)
    one = PL.entity_profile(d, d, "k", ["a"], ["a", "b"], 4, model, ["a", "b"])
    assert one["score"].count() == 1 and one["top_driver"].first()["top_driver"] == "a"


def test_written_policy_adds_indicators(spark):
    rows = [(i, None if i % 3 == 0 else float(i), None if i % 10 == 0 else float(i), "g") for i in range(30)]
    df = spark.createDataFrame(rows, "k int, third double, tenth double, grp string")
    out = C.tiered_clean(df, "grp", C.MissingPolicy(indicate_between=True), protect=["k"])
    assert out.columns[-1] == "third_is_missing" and "tenth_is_missing" not in out.columns
    assert out.agg(F.sum("third_is_missing")).first()[0] == 10 and out.where("tenth IS NULL").count() == 0 and out.where("third IS NULL").count() == 10
    assert "third_is_missing" not in C.tiered_clean(df, "grp", protect=["k"]).columns


def test_gram_hands_on_one_row_per_task(spark):
    from widegrain.operators import stats as S
    rows = [(float(i % 7), float(i % 5) if i % 3 else None, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(6)
    parts = df.mapInArrow(S._gram_partition(3), S._PART_SCHEMA)
    assert parts.count() == 6 and parts.select("lane").distinct().count() == 6
    got = {(r["i"], r["j"]): r for r in S.gram(df, ["a", "b", "c"], center=False).collect()}
    assert len(got) == 9
    for (i, j), r in got.items():
        both = [x for x in rows if x[i] is not None and x[j] is not None]
        assert r["n"] == len(both) and r["sx"] == sum(x[i] for x in both) and r["sy"] == sum(x[j] for x in both)
        assert r["sxy"] == sum(x[i] * x[j] for x in both) and r["sxx"] == sum(x[i] ** 2 for x in both) and r["syy"] == sum(x[j] ** 2 for x in both)
    assert S.gram(df.limit(0), ["a", "b"], center=False).count() == 0


def test_a_key_of_many_pairs_is_not_left_to_the_full_join(spark, monkeypatch):
    """A full outer join holds all rows of a key at once: many pairs of a key
    with few rows on each side are streamed by an inner join."""
    from collections import Counter

    from widegrain.operators import reshape as RS
    monkeypatch.setattr(RS, "FULL_JOIN_PRODUCT", 500)
    a = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 100), (3, 101), (None, 102)], "k int, x int")
    b = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 100), (4, 101), (None, 102)], "k int, y int")
    got = RS.full_join_split(a, b, "k")
    assert "__salt" in got._jdf.queryExecution().optimizedPlan().toString()
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, a.join(b, "k", "full").collect()))
    monkeypatch.setattr(RS, "FULL_JOIN_PRODUCT", 1000)
    assert "__salt" not in RS.full_join_split(a, b, "k")._jdf.queryExecution().optimizedPlan().toString()
