"""Model stages, penalties, explanations and persistence on small synthetic
tables with known structure (SURVEY §7.6)."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from widegrain.models import pipeline as MP
from widegrain.models.transformers import (LassoSelector, MedianImputer, PopulationScaler,
                                           centred_moments, lasso_coordinate_descent)
from widegrain.operators import explain as X
from widegrain.operators import ranking as R
from widegrain.sources import io as IO

FEATS = ["x1", "x2", "x3", "noise"]


@pytest.fixture(scope="module")
def synth(spark):
    rng = np.random.default_rng(3)
    n = 600
    X1 = rng.normal(size=(n, 4))
    y = 2.0 * X1[:, 0] - 1.0 * X1[:, 1] + 0.5 * X1[:, 2] + rng.normal(scale=0.3, size=n)
    rows = [(i, *map(float, X1[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, x1 double, x2 double, x3 double, noise double, y double")
    return df.withColumn("x3", F.when(F.col("k") % 17 == 0, None).otherwise(F.col("x3"))).cache()


def _np(df, cols):
    pdf = df.select(*cols).toPandas()
    return pdf


def test_imputer_exact_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "a double")
    m = MedianImputer(inputCols=["a"]).fit(df)
    assert m.getOrDefault("values") == [2.5]
    assert [r[0] for r in m.transform(df).collect()][-1] == 2.5


def test_impute_scale_equals_impute_then_scale(spark, synth):
    from widegrain.models.transformers import ImputeScale
    a = ImputeScale(inputCols=["x3", "x1"]).fit(synth).transform(synth)
    imp = MedianImputer(inputCols=["x3", "x1"]).fit(synth).transform(synth)
    b = PopulationScaler(inputCols=["x3", "x1"]).fit(imp).transform(imp)
    ra = sorted((r["k"], r["x3"], r["x1"]) for r in a.collect())
    rb = sorted((r["k"], r["x3"], r["x1"]) for r in b.collect())
    assert np.allclose(np.array(ra), np.array(rb), atol=1e-9)


def test_population_scaler(spark, synth):
    m = PopulationScaler(inputCols=["x1"]).fit(synth)
    out = m.transform(synth).agg(F.avg("x1"), F.stddev_pop("x1")).first()
    assert out[0] == pytest.approx(0.0, abs=1e-12) and out[1] == pytest.approx(1.0)


def test_penalties_match_closed_forms(spark, synth):
    d = synth.na.drop()
    pdf = _np(d, FEATS + ["y"])
    Xn, y = pdf[FEATS].to_numpy(), pdf["y"].to_numpy()
    n = len(y)
    Xc, yc = Xn - Xn.mean(0), y - y.mean()
    asm = VectorAssembler(inputCols=FEATS, outputCol="features")
    # ridge: (Xc'Xc + alpha I)^-1 Xc'yc
    w_r = np.linalg.solve(Xc.T @ Xc + 5.0 * np.eye(4), Xc.T @ yc)
    m = Pipeline(stages=[asm, MP.make_regressor("ridge", "features", "y", alpha=5.0)]).fit(d).stages[-1]
    assert np.allclose(m.coefficients.toArray(), w_r, atol=1e-6)
    # elastic net and lasso: coordinate descent on the same objective
    C, c = Xc.T @ Xc / n, Xc.T @ yc / n
    for kind, a, rho in [("elasticnet", 0.1, 0.5), ("lasso", 0.05, 1.0)]:
        w = lasso_coordinate_descent(C, c, a, rho)
        params = {"alpha": a, "l1_ratio": rho} if kind == "elasticnet" else {"alpha": a}
        m = Pipeline(stages=[asm, MP.make_regressor(kind, "features", "y", **params)]).fit(d).stages[-1]
        assert np.allclose(m.coefficients.toArray(), w, atol=1e-5), kind


def test_lasso_selector_drops_noise(spark, synth):
    d = VectorAssembler(inputCols=FEATS, outputCol="f").transform(synth.na.drop())
    C, c, n = centred_moments(d, "f", "y")
    assert n == d.count()
    sel = LassoSelector(featuresCol="f", labelCol="y", alpha=0.1).fit(d)
    assert sel.getOrDefault("indices") == [0, 1, 2]


def test_shared_pipeline_quality_and_block_removal(spark, synth):
    d = R.kfold_assign(synth, ["k"], 5, 42)
    full = {"linear": MP.make_pipeline(FEATS, "y", "linear", alpha=0.1, n_components=3)}
    _, s = MP.cross_validate(d, full, "y", "fold")
    r2 = s.first()["r2_mean"]
    noise_ceiling = 1 - 0.09 / (4 + 1 + 0.25 + 0.09)
    assert r2 > noise_ceiling - 0.03    # x3 is median-imputed in 1 of 17 rows
    reduced = {"linear": MP.make_pipeline(["x3", "noise"], "y", "linear", alpha=0.01, n_components=1)}
    _, s2 = MP.cross_validate(d, reduced, "y", "fold")
    assert s2.first()["r2_mean"] < r2 - 0.3          # removing an informative block lowers CV R² (M24)


def test_trees_beat_linear_on_nonlinear_target(spark):
    rng = np.random.default_rng(5)
    n = 800
    x = rng.uniform(-2, 2, size=(n, 2))
    y = np.sin(2 * x[:, 0]) * 3 + (x[:, 1] > 0) * 2 + rng.normal(scale=0.1, size=n)
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, (a, b), t in zip(range(n), x, y)],
                               "k long, a double, b double, y double")
    d = R.kfold_assign(df, ["k"], 3, 1)
    cands = {"linear": MP.make_pipeline(["a", "b"], "y", "linear", select=False, reduce=False),
             "forest": MP.make_pipeline(["a", "b"], "y", "forest", select=False, reduce=False,
                                        n_estimators=30, max_depth=6)}
    _, s = MP.cross_validate(d, cands, "y", "fold")
    got = {r["model"]: r["r2_mean"] for r in s.collect()}
    assert got["forest"] > got["linear"] + 0.2


def test_shapley_linear_closed_form_and_additivity(spark, synth):
    d = synth.na.drop().select("k", "x1", "x2", "y")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x1", "x2"], outputCol="features"),
                             MP.make_regressor("linear", "features", "y")]).fit(d)
    beta = model.stages[-1].coefficients.toArray()
    bg = R.seeded_sample(d, ["k"], 20, 1)
    phi = X.shapley_values(model, d, ["x1", "x2"], "k", bg, n_permutations=2, seed=1)
    mb = bg.agg(F.avg("x1"), F.avg("x2")).first()
    base = model.transform(d).select("k", "prediction")
    fbg = model.transform(bg).agg(F.avg("prediction")).first()[0]
    tot = phi.groupBy("k").agg(F.sum("phi").alias("s")).join(base, "k")
    dev = tot.select(F.max(F.abs(F.col("s") - (F.col("prediction") - F.lit(fbg))))).first()[0]
    assert dev < 1e-8
    chk = phi.join(d, "k").select(
        F.max(F.abs(F.col("phi") - F.when(F.col("feature") == "x1", F.lit(beta[0]) * (F.col("x1") - mb[0]))
                    .otherwise(F.lit(beta[1]) * (F.col("x2") - mb[1]))))).first()[0]
    assert chk < 1e-8


def test_shapley_of_a_linear_model_scores_no_copy_per_background_row(spark, synth, monkeypatch):
    d = synth.na.drop().select("k", "x1", "x2", "y")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x1", "x2"], outputCol="features"),
                             MP.make_regressor("linear", "features", "y")]).fit(d)
    bg, seen, whole = R.seeded_sample(d, ["k"], 20, 1), [], type(model).transform
    monkeypatch.setattr(type(model), "transform", lambda self, df, *a: seen.append(df) or whole(self, df, *a))
    phi = X.shapley_values(model, d, ["x1", "x2"], "k", bg, seed=1)
    monkeypatch.undo()
    assert max(x.count() for x in seen) <= 3 * d.count()
    # a model that is not told to be linear goes by every background row, to the same values
    monkeypatch.setattr(X, "_affine", lambda *a: False)
    slow = {(r["k"], r["feature"]): r["phi"] for r in X.shapley_values(model, d, ["x1", "x2"], "k", bg, seed=1).collect()}
    fast = {(r["k"], r["feature"]): r["phi"] for r in phi.collect()}
    assert fast.keys() == slow.keys() and len(fast) == 2 * d.count()
    assert all(fast[k] == pytest.approx(slow[k], abs=1e-9) for k in fast)


def test_permutation_importance_ranks_informative_first(spark, synth):
    d = synth.na.drop()
    model = Pipeline(stages=[VectorAssembler(inputCols=FEATS, outputCol="features"),
                             MP.make_regressor("linear", "features", "y")]).fit(d)
    summ, per = X.permutation_importance(model, d, FEATS, "y", "k", n_repeats=3)
    imp = {r["feature"]: r["importance_mean"] for r in summ.collect()}
    assert imp["x1"] > imp["x2"] > imp["x3"] > imp["noise"]
    assert per.count() == 12


def test_permuted_copies_shuffle_a_row_once(spark, synth):
    """Donors alone are shuffled once per repeat; their digests go as bytes."""
    from collections import Counter
    d = synth.na.drop().select("k", "x1", "x2", "y")
    got = X.permuted_copies(d, ["x1", "x2"], "k", n_repeats=4, seed=3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert not any("__pos" in k and "perm_repeat" in k for k in keys)
    n = d.count()
    assert got.count() == n * 2 * 4
    each = Counter((r["perm_feature"], r["perm_repeat"]) for r in got.collect())
    assert set(each.values()) == {n} and len(each) == 8
    x1 = sorted(r["x1"] for r in d.collect())
    for repeat in range(4):  # a permutation: every value once
        own = got.where(f"perm_feature = 'x1' AND perm_repeat = {repeat}")
        assert sorted(r["x1"] for r in own.collect()) == x1


def test_model_save_load_roundtrip(spark, synth):
    d = synth.na.drop()
    model = MP.make_pipeline(FEATS, "y", "ridge", alpha=0.01, n_components=2).fit(d)
    chk = IO.verify_reload(model, IO.scratch_path(spark, "test-model"), d, "y")
    assert all(r["ok"] for r in chk.collect())


def test_two_header_csv_and_fingerprint(spark):
    df = spark.createDataFrame([("01001", "a", 1.5), ("00007", "b", None)], "fips string, name string, v double")
    path = IO.scratch_path(spark, "test-csv")
    IO.write_two_header_csv(df, path)
    back = IO.read_two_header_csv(spark, path, key_cols=["fips"])
    assert dict(back.dtypes) == {"fips": "string", "name": "string", "v": "double"}
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    f1 = IO.table_fingerprint(df).first()
    f2 = IO.table_fingerprint(back.select("fips", "name", "v")).first()
    assert f1 == f2
    dup = IO.table_fingerprint(df.unionByName(df)).first()
    assert dup["digest_xor"] == 0 and dup["digest_sum"] != f1["digest_sum"]


def test_lasso_cv_and_block_pca_and_sensitivity(spark, synth):
    d = R.kfold_assign(synth.na.drop(), ["k"], 5, 42)
    path, best, w = MP.lasso_cv(d, FEATS, "y", "fold", n_alphas=20)
    assert path.count() == 20
    assert best < 0.1 and abs(w[0] - 2.0) < 0.1 and abs(w[3]) < 0.05
    tr, te = d.where("fold != 0"), d.where("fold = 0")
    a, b, m = MP.block_pca(tr, te, ["x1", "x2", "x3"], k=2)
    assert {"block_pc1", "block_pc2"} <= set(a.columns) and "x1" not in a.columns
    assert abs(a.agg(F.avg("block_pc1")).first()[0]) < 1e-9        # centred on train
    sens = {r["variant"]: r["r2_mean"] for r in MP.block_sensitivity(
        d, FEATS, ["x1"], "y", select=False, reduce=False).collect()}
    assert sens["all"] > sens["without_block"] + 0.3


@pytest.mark.parametrize("kind,size", [("linear", 9), ("ridge", 27), ("elasticnet", 81), ("gbt", 162),
                                       ("forest", 54), ("svr_rbf", 81)])
def test_reference_grid_sizes(spark, kind, size):
    pipe = MP.make_pipeline(FEATS, "y", kind)
    grids = MP.reference_param_grid(pipe, kind)
    assert sum(len(g) for g in grids) == size
    capped = MP.reference_param_grid(pipe, kind, max_components=12)
    from widegrain.models.transformers import CentredPCA
    assert all(m[MP.stage_of(pipe, CentredPCA).k] <= 12 for g in capped for m in g)


def test_centred_pca_matches_numpy(spark):
    from pyspark.ml.feature import VectorAssembler
    from widegrain.models.transformers import CentredPCA
    rng = np.random.default_rng(9)
    X = rng.normal(size=(300, 4)) @ np.array([[2, 0, 0, 0], [1, 1, 0, 0], [0, 0, 0.5, 0], [0, 0, 0.2, 0.1]]) + 5.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double, d double")
    v = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="v").transform(df)
    m = CentredPCA(inputCol="v", outputCol="s", k=2).fit(v)
    Xc = X - X.mean(0)
    lam, vec = np.linalg.eigh(np.cov(Xc.T, bias=True))
    top = vec[:, np.argsort(lam)[::-1][:2]]
    got = np.array([r["s"].toArray() for r in m.transform(v).select("s").collect()])
    want = Xc @ top
    for j in range(2):                                   # equal up to the sign of each component
        assert np.allclose(np.abs(got[:, j]), np.abs(want[:, j]), atol=1e-8)
    assert np.allclose(got.mean(0), 0.0, atol=1e-9)
    ratios = m.getOrDefault("explainedVariance")
    assert np.allclose(ratios, np.sort(lam)[::-1][:2] / lam.sum())


def test_registered_model_queries_use_whole_candidates_and_grids(spark, sf_dir, monkeypatch):
    """What the queries hand to the fits: the library's whole candidates and
    the whole union of grids, on all features."""
    import inspect
    import itertools

    from widegrain.plans import q_models
    from widegrain.plans.tables import ORDER_FEATURE_COLS
    seen = {}

    class Asked(Exception):
        pass

    def noting(name, stop=False):
        def run(moments, *args, **settings):
            seen[name] = (moments.features, args, settings)
            if stop:
                raise Asked
            return []
        return run

    monkeypatch.setattr(q_models.FF, "cross_validate_linear", noting("linear"))
    monkeypatch.setattr(q_models.SF, "cross_validate_svr", noting("svr"))
    monkeypatch.setattr(q_models.TF, "cross_validate_trees", noting("trees", stop=True))
    with pytest.raises(Asked):
        q_models.cv_candidates_orders(spark, sf_dir)
    monkeypatch.setattr(q_models.TF, "grid_search_trees", noting("grid", stop=True))
    with pytest.raises(Asked):
        q_models.grid_search_orders(spark, sf_dir)
    assert all(features == ORDER_FEATURE_COLS for features, _, _ in seen.values())
    assert set(seen["linear"][1][0]) == {"linear", "ridge", "elasticnet"}
    assert seen["svr"][1][0] == {"svr_rbf": {"c": 10.0, "epsilon": 0.1}}
    assert inspect.signature(q_models.SF.fit_svr).parameters["n_features"].default == 200
    trees = seen["trees"][1][0]
    assert trees["forest"] == ("forest", {"n_estimators": 400, "min_samples_leaf": 2, "max_depth": None})
    kind, boosting = trees["gbt"]
    assert (kind, boosting["n_estimators"], boosting["max_depth"]) == ("gbt", 400, 6)
    kind, shared, grid, _ = seen["grid"][1]
    pairs = [p for g in shared for p in itertools.product(g["selection_alpha"], g["n_components"])]
    assert kind == "gbt" and len(pairs) * len(list(itertools.product(*grid.values()))) == 162
    assert seen["grid"][2]["keep"] is None  # every set is returned
