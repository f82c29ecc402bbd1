"""Hand-written edge tables (FIXTURES §3) and identities."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from widegrain.functions.keys import pad_key
from widegrain.functions.scalars import recode, row_argmax, safe_ratio
from widegrain.functions.columns import binary_columns, family_prune
from widegrain.operators import clean as C
from widegrain.operators import profile as P
from widegrain.operators import ranking as R
from widegrain.operators import reshape as RS
from widegrain.operators import stats as S


def test_pad_key_never_truncates(spark):
    df = spark.createDataFrame([("1",), ("01001",), ("1234567",), (None,), ("",)], "k string")
    got = [r[0] for r in df.select(pad_key("k")).collect()]
    assert got == ["00001", "01001", "1234567", None, "00000"]


def test_tier_schemes_differ_at_edges(spark):
    # columns with exactly 0, 5, 20, 40, 60, 100 % nulls over 20 rows
    shares = {"c0": 0, "c5": 1, "c20": 4, "c40": 8, "c60": 12, "c100": 20}
    rows = [tuple(None if i < k else 1.0 for k in shares.values()) for i in range(20)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in shares))
    prof = P.null_profile(df)
    left = {r["tier"]: r["n_columns"] for r in P.tier_counts(prof, "left").collect()}
    right = {r["tier"]: r["n_columns"] for r in P.tier_counts(prof, "right").collect()}
    assert left == {"0%": 1, "<5%": 0, "5-20%": 1, "20-40%": 1, "40-60%": 1, ">60%": 2}
    assert right == {"0%": 1, "<5%": 1, "5-20%": 1, "20-40%": 1, "40-60%": 1, ">60%": 1}
    assert sum(left.values()) == len(shares)


def test_weighted_rollup_edges(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None, 2.0, "x"), ("a", 3.0, None, None, None), ("b", 0.0, 0.5, 1.0, "y"),
         (None, 2.0, 1.0, 5.0, "z")], "k string, w double, rate double, cnt double, lab string")
    out = {r["k"]: r for r in RS.weighted_rollup(df, "k", "w", rates=["rate"], counts=["cnt"],
                                                 labels=["lab"], label_order="w").collect()}
    assert out["a"]["rate"] == 0.0          # all-null group: 0 / total weight (pandas sum -> 0)
    assert out["a"]["cnt"] == 2.0
    assert out["a"]["lab"] == "x"
    assert out["b"]["rate"] is None          # total weight 0 -> null, never an error
    assert None not in out                   # a null key belongs to no group


def test_outer_merge_reconciles_and_drops_null_keys(spark):
    a = spark.createDataFrame([("1", 1.0, "p"), ("2", 2.0, None), (None, 9.0, "q")], "k string, x double, s string")
    b = spark.createDataFrame([("2", "r"), ("3", "t"), ("3", "u")], "k string, s string")
    m = {(r["k"], r["s"]) for r in RS.outer_merge([a, b], "k").collect()}
    assert m == {("1", "p"), ("2", "r"), ("3", "t"), ("3", "u")}


def test_recode_is_simultaneous(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (3,)], "f int")
    assert [r[0] for r in df.select(recode("f", {1: 0, 2: 1})).collect()] == [0, 1, None, 3]


def test_reliability_expand_flags_and_text(spark):
    df = spark.createDataFrame([("x", None, "12.5"), ("y", 1, "abc"), ("z", 2, "7")],
                               "k string, v_flag int, v_rawvalue string")
    out = {r["k"]: r for r in C.reliability_expand(df).collect()}
    assert out["x"]["v_rawvalue"] == 12.5 and out["x"]["v_flag_suppressed"] == 0
    assert out["y"]["v_rawvalue"] is None and out["y"]["v_flag_unreliable"] == 1
    assert out["z"]["v_rawvalue"] == -1.0 and out["z"]["v_flag_suppressed"] == 1


def test_indicator_impute_excludes_sentinel_from_share_and_median(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (3.0,), (None,), (5.0,)], "v double")
    out = C.indicator_impute(df)
    rows = out.collect()
    assert [r["v"] for r in rows] == [1.0, 3.0, 3.0, 3.0, 5.0]
    assert [r["v_is_missing"] for r in rows] == [0, 1, 0, 1, 0]


def test_binary_columns_vacuous(spark):
    df = spark.createDataFrame([(0, None, 2), (1, None, 0)], "a int, b int, c int")
    assert binary_columns(df) == ["a", "b"]


def test_family_prune_scope():
    cols = ["LACKTRPT", "lapop1share", "lapop1", "TractLOWI", "lanumber_share"]
    kept, dropped = family_prune(cols)
    assert kept == ["lapop1share", "TractLOWI"]
    assert set(dropped) == {"LACKTRPT", "lapop1", "lanumber_share"}
    kept2, dropped2 = family_prune(cols, scope=["lapop1share", "lapop1", "TractLOWI", "lanumber_share"])
    assert "LACKTRPT" not in dropped2


@pytest.mark.parametrize("ranges", [None, 1, 8, 97])
def test_quantiles_skewed_group(spark, ranges):
    # one key holds a third of the rows, half of them one constant value
    rows = [("hot", 7.0)] * 300 + [("hot", float(i)) for i in range(300)] + \
           [(f"k{i % 50}", float(i)) for i in range(1200)] + [("nulls", None)] * 5
    df = spark.createDataFrame(rows, "g string, v double")
    q = R.group_quantiles(df, "v", [0.25, 0.5, 0.9], ["g"], ["a", "b", "c"], n_ranges=ranges)
    got = {r["g"]: (r["a"], r["b"], r["c"]) for r in q.collect()}
    want = {r["g"]: tuple(r["p"]) for r in df.where("v is not null").groupBy("g").agg(
        F.percentile("v", [0.25, 0.5, 0.9]).alias("p")).collect()}
    assert set(got) == set(want)
    for k in want:
        assert np.allclose(got[k], want[k])


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_value_ranks_against_plain_order(spark, ranges):
    rows = [(None, 3.0)] * 9 + [(None, float("inf")), ("a", float("-inf")), ("a", float("inf")), ("b", None)] + \
           [("a", float(i % 11)) for i in range(200)] + [("c", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["v"]): (r["cnt"], r["below"]) for r in R.value_ranks(df, "v", ["g"], ranges).collect()}
    want = {(g, v): (sum(x == (g, v) for x in rows), sum(h == g and w is not None and w < v for h, w in rows))
            for g, v in rows if v is not None}
    assert got == want
    ends = {r["g"]: (r["lo"], r["hi"]) for r in R.group_quantiles(df, "v", [0, 1], ["g"], ["lo", "hi"], ranges).collect()}
    assert ends == {None: (3.0, float("inf")), "a": (float("-inf"), float("inf")), "c": (5.0, 5.0)}
    assert R.group_quantiles(df.where("v < -9 and g = 'b'"), "v", [0.5], ["g"]).count() == 0


def test_hot_group_is_shared_out(spark):
    # two million rows of one key: no range holds much more than its share of the distinct values
    df = spark.range(2_000_000).select(F.lit("k").alias("g"), (F.col("id") * 7919 % 1_000_003).cast("double").alias("v"))
    ranged, sizes = R._value_ranges(df, "v", ["g"], 16)
    most = ranged.groupBy("__b").count().agg(F.max("count")).first()[0]
    assert most < 2 * 1_000_003 / 16 and sizes.count() <= 17
    want = df.select(F.percentile("v", [0.1, 0.5]).alias("p")).first()["p"]
    got = R.group_quantiles(df, "v", [0.1, 0.5], ["g"], ["a", "b"], 16).first()
    assert [got["a"], got["b"]] == pytest.approx(want)


def test_seeded_rank_partitioned_exact(spark):
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id long")
    r = R.seeded_rank(df, ["id"], 7, partition_cols=["g"], digits=2)
    got = {(x["g"], x["id"]): x["rank"] for x in r.collect()}
    from collections import defaultdict
    import hashlib
    groups = defaultdict(list)
    for g, i in rows:
        groups[g].append((hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
    for g, lst in groups.items():
        for pos, (_, i) in enumerate(sorted(lst), start=1):
            assert got[(g, i)] == pos


def test_folds_and_split_sizes(spark):
    df = spark.range(0, 1003).withColumnRenamed("id", "k")
    sizes = [r["c"] for r in R.kfold_assign(df, ["k"], 5).groupBy("fold").agg(F.count("*").alias("c")).collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 1003
    n_test = R.exact_split(df, ["k"], 0.2).where("split = 'test'").count()
    assert n_test == math.ceil(0.2 * 1003)


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,)], "x double")
    h = {r["bin"]: r["count"] for r in P.histogram(df, "x", 5).collect()}
    assert h == {1: 2, 2: 1, 3: 0, 4: 0, 5: 1}


def test_corr_constant_column_is_undefined_not_error(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 1.0, 4.0), (3.0, 1.0, 7.0)], "y double, c double, x double")
    out = {r["column_name"] for r in S.corr_with_target(df, "y", ["c", "x"]).collect()}
    assert out == {"x"}


def test_vif_orthogonal_and_dependent(spark):
    rows = [(float(a), float(b)) for a in (-1, 1) for b in (-1, 1)] * 5
    df = spark.createDataFrame(rows, "a double, b double")
    v = {r["column_name"]: r["vif"] for r in S.vif(df, ["a", "b"]).collect()}
    assert v["a"] == pytest.approx(1.0) and v["b"] == pytest.approx(1.0)
    dep = df.withColumn("c", F.col("a") * 2 + F.col("b"))
    v2 = {r["column_name"]: r["vif"] for r in S.vif(dep, ["a", "b", "c"]).collect()}
    assert all(math.isinf(x) for x in v2.values())


def test_pca_ratios_sum_to_one(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double, d double")
    e = S.pca_reconstruction(df, ["a", "b", "c", "d"]).orderBy("k").collect()
    assert e[-1]["cumulative"] == pytest.approx(1.0)
    assert e[-1]["mse"] == pytest.approx(0.0, abs=1e-12)
    assert e[0]["mse"] == pytest.approx(1.0)


def test_row_argmax_ties_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0, None), (None, None, None), (0.5, 2.0, 2.0)], "a double, b double, c double")
    v, n = row_argmax(["a", "b", "c"])
    got = [(r[0], r[1]) for r in df.select(v, n).collect()]
    assert got == [(1.0, "a"), (None, None), (2.0, "b")]


def test_safe_ratio_zero_divisor(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio("a", "b", 100000)).collect()] == [None, 50000.0]


def test_group_median_fill_keeps_null_key_values(spark):
    df = spark.createDataFrame([("s1", 1.0), ("s1", None), ("s1", 3.0), (None, 5.0), (None, None), ("s2", None)],
                               "st string, v double")
    out = [r["v"] for r in C.group_median_fill(df, ["v"], "st").orderBy("st", "v").collect()]
    assert sorted(out, key=lambda x: (x is None, x)) == [1.0, 2.0, 3.0, 5.0, 5.0, None]


def test_seeded_rank_rejects_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    with pytest.raises(Exception, match="not unique"):
        R.seeded_rank(df, ["k"]).collect()


def test_outer_merge_union_equals_join_and_rejects_duplicates(spark):
    a = spark.createDataFrame([("1", 1.0, "p"), ("2", 2.0, None), (None, 9.0, "q")], "k string, x double, s string")
    b = spark.createDataFrame([("2", "r", 5), ("3", "t", 6)], "k string, s string, n int")
    j = sorted(map(tuple, RS.outer_merge([a, b], "k").collect()), key=str)
    u = sorted(map(tuple, RS.outer_merge([a, b], "k", method="union").collect()), key=str)
    assert j == u
    dup = b.unionByName(b)
    with pytest.raises(Exception, match="repeats"):
        RS.outer_merge([a, dup], "k", method="union").collect()


def test_report_header_and_choice_filter(spark):
    from widegrain.functions.columns import choice_filter
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 1.0, "x"), ("b", None, "y")], "k string, t double, s string")
    h = {r["metric"]: r["value"] for r in P.report_header(df, "t", {"src": ["t"]}, train=df, test=df.limit(1)).collect()}
    assert h["total_records"] == 3 and h["usable_targets"] == 2 and h["duplicate_records"] == 1
    assert h["missing_pct"] == round(100 / 9, 2) and h["columns_src"] == 1 and h["test_samples"] == 1
    assert choice_filter(df, {"k": "All", "s": "x"}).count() == 2


def test_catalog_guards_and_bootstrap(spark):
    from widegrain.sources import io as IO
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("wg_t_full")
    spark.createDataFrame([], "a int").createOrReplaceTempView("wg_t_empty")
    used = IO.bootstrap_tables(spark, {"wg_t_new": lambda: spark.range(3), "wg_t_empty": lambda: spark.range(1)},
                               fallbacks={"wg_t_empty": "wg_t_full"})
    assert used == {"wg_t_new": "loaded", "wg_t_empty": "fallback:wg_t_full"}
    assert spark.table("wg_t_empty").count() == 1
    names = {r["name"] for r in IO.list_tables(spark).collect()}
    assert {"wg_t_new", "wg_t_full"} <= names
    assert IO.existing_only(spark, ["wg_t_new", "wg_missing"]) == ["wg_t_new"]
    with pytest.raises(FileNotFoundError):
        IO.require_tables(spark, ["wg_missing"])


def test_read_csv_keys_stay_text_and_nan_is_null(spark):
    from widegrain.sources import io as IO
    path = IO.scratch_path(spark, "test-read-csv")
    spark.createDataFrame([("01001", "1.5", "x"), ("00007", "NaN", "y")], "fips string, v string, s string") \
        .coalesce(1).write.option("header", "true").csv(path)
    df = IO.read_csv(spark, path, key_cols=["fips"])
    assert dict(df.dtypes) == {"fips": "string", "v": "double", "s": "string"}
    got = {r["fips"]: r["v"] for r in df.collect()}
    assert got == {"01001": 1.5, "00007": None}


def test_transpose_strings_and_all_null_predicate(spark):
    df = spark.createDataFrame([("k1", 1, "a", None), ("k2", None, None, None)], "k string, n int, s string, z double")
    t = RS.transpose(df, ["k"], ["n", "s"], as_string=True)
    assert {(r["k"], r["field"], r["value"]) for r in t.collect()} == {
        ("k1", "n", "1"), ("k1", "s", "a"), ("k2", "n", None), ("k2", "s", None)}
    none = df.where(RS.all_null_in(["n", "s", "z"])).select("k").collect()
    assert [r["k"] for r in none] == ["k2"]


def test_keyed_and_long_measure_preparation(spark):
    from widegrain.plans import pipelines as PL
    long = spark.createDataFrame(
        [(1001, "Autauga", "A", "10.5"), (1001, "Autauga", "B", "x"), (1001, "Autauga", "B", "4"),
         (7, "Small", "A", None), (7, "Small", "A", "2"), (7, "Small", "C", "9")],
        "loc int, name string, measure string, value string")
    w = {r["loc"]: r for r in PL.prepare_long_measures(long, "loc", "measure", "value", ["A", "B"],
                                                         labels=["name"]).collect()}
    assert w["01001"]["A"] == 10.5 and w["01001"]["B"] == 4.0 and w["00007"]["B"] is None
    assert w["00007"]["name"] == "Small"
    k = PL.prepare_keyed(spark.createDataFrame([(1, 2.0), (22, None)], "fips int, inc double"), "fips",
                         required=["inc"], rename={"inc": "median_income"})
    assert [tuple(r) for r in k.collect()] == [("00001", 2.0)]


def test_tiered_clean_and_indicator_impute_at_tier_edges(spark):
    # 20 rows; null shares: g20 = 20 % (genuine: untouched), g5 = 5 % (median fill), la40 = 40 % (structural: 0),
    # g60 = 60 % (dropped), la60 = 60 % (dropped)
    n = 20
    rows = []
    for i in range(n):
        rows.append(("s1" if i % 2 else "s2", float(i),
                     None if i < 4 else float(i), None if i < 1 else float(i), None if i < 8 else 1.0,
                     None if i < 12 else 1.0, None if i < 12 else 1.0))
    df = spark.createDataFrame(rows, "st string, x double, g20 double, g5 double, la40 double, g60 double, la60 double")
    out = C.tiered_clean(df, "st")
    assert "g60" not in out.columns and "la60" not in out.columns
    got = out.orderBy("x").collect()
    assert got[0]["g20"] is None                              # 20 % genuine: left as is
    assert got[0]["g5"] == 10.0                               # row 0 is in group s2: median of 2, 4, ..., 18
    assert [r["la40"] for r in got[:8]] == [0.0] * 8          # structural: filled with 0
    imp = C.indicator_impute(df.drop("st"))
    assert "g60" not in imp.columns and "g20_is_missing" in imp.columns and "x_is_missing" not in imp.columns
