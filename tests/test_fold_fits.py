"""Moment-based, tree and epsilon-insensitive fits over folds, against NumPy
and the row-based pipelines."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from widegrain.models import foldfits as FF
from widegrain.models import pipeline as MP
from widegrain.models import svrfits as SF
from widegrain.models import treefits as TF

COLS = ["a", "b", "c", "d"]


def _data(n=600, gaps=False, shift=0.0, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) @ np.array([[1, 0.5, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0.2], [0, 0, 0, 1.0]])
    y = 2 * x[:, 0] - x[:, 1] + 0.5 * x[:, 2] ** 2 + rng.normal(scale=0.3, size=n) + 10 * shift
    x = x + shift
    if gaps:
        x[rng.random(x.shape) < 0.1] = np.nan
    return x, y, rng.integers(0, 4, n)


def _frame(spark, x, y, fold):
    rows = [(*[None if np.isnan(v) else float(v) for v in r], float(t), int(f), "keep") for r, t, f in zip(x, y, fold, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, fold int, score string")


def _by_hand(x, y, fold, f, k, penalty):
    """Impute, scale, project and ridge on the training rows; scores on the fold."""
    tr, te = fold != f, fold == f
    med = np.nanmedian(x[tr], axis=0)
    z = np.where(np.isnan(x), med, x)
    mu, sd = z[tr].mean(0), z[tr].std(0)
    z = (z - mu) / sd
    if k:
        _, vec = np.linalg.eigh(np.cov(z[tr].T, bias=True))
        z = z @ vec[:, ::-1][:, :k]
    w = np.linalg.solve(z[tr].T @ z[tr] + penalty * np.eye(z.shape[1]), z[tr].T @ (y[tr] - y[tr].mean()))
    e = y[te] - y[tr].mean() - z[te] @ w
    return 1 - (e @ e) / (te.sum() * y[te].var()), np.sqrt(np.mean(e * e)), np.abs(e).mean()


@pytest.mark.parametrize("gaps,shift", [(False, 0.0), (True, 0.0), (False, 1e6)])
def test_scores_from_moments_equal_those_from_rows(spark, gaps, shift):
    x, y, fold = _data(gaps=gaps, shift=shift)
    m = FF.fold_moments(_frame(spark, x, y, fold), COLS, "y", "fold")
    rows = FF.cross_validate_linear(m, {"two": {"kind": "ridge", "alpha": None, "n_components": 2, "penalty": 3.0},
                                        "raw": {"kind": "linear", "alpha": None, "n_components": None}})
    for name, f, r2, rmse, mae, n in rows:
        want = _by_hand(x, y, fold, f, 2 if name == "two" else 0, 3.0 if name == "two" else 0.0)
        assert (r2, rmse, mae) == pytest.approx(want, rel=1e-5) and n == (fold == f).sum()


def test_scores_from_moments_equal_the_pipeline(spark):
    x, y, fold = _data(gaps=True)
    d = _frame(spark, x, y, fold)
    m = FF.fold_moments(d, COLS, "y", "fold")
    shared = {"alpha": 0.05, "n_components": 2}
    got, _ = FF.linear_scores(m, {"linear": {"kind": "linear", **shared}, "elasticnet": {"kind": "elasticnet", "penalty": 0.01, **shared}})
    cands = {k: MP.make_pipeline(COLS, "y", k, **shared) for k in ("linear", "elasticnet")}
    want, _ = MP.cross_validate(d, cands, "y", "fold")
    a = {(r["model"], r["fold"]): (r["r2"], r["rmse"], r["mae"]) for r in got.collect()}
    b = {(r["model"], r["fold"]): (r["r2"], r["rmse"], r["mae"]) for r in want.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-4)


def test_sweep_blocks_and_stages(spark):
    m = FF.fold_moments(_frame(spark, *_data()), COLS, "y", "fold")
    sweep = {r["n_components"]: r["r2_mean"] for r in FF.component_sweep(m, range(1, 31), alpha=0.01).collect()}
    assert sorted(sweep) == list(range(1, m.smallest_selection(0.01) + 1)) and sweep[max(sweep)] >= sweep[1]
    got = {r["variant"]: r["r2_mean"] for r in FF.without_blocks(m, {"ab": ["a", "b"]}, alpha=0.01, n_components=4, stages=True).collect()}
    assert set(got) == {"all", "without_ab", "no_selection", "no_pca", "no_selection_no_pca"} and got["without_ab"] < got["all"] - 0.3
    with pytest.raises(ValueError, match="keeps no feature"):
        m.select(0, 1e6)
    with pytest.raises(ValueError, match="components"):
        m.project(0, 0.01, 9)
    with pytest.raises(ValueError, match="two folds"):
        FF.fold_moments(_frame(spark, *_data()).where("fold = 0"), COLS, "y", "fold")


def test_one_tree_splits_where_the_gain_is_largest():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 8, (500, 3))
    y = np.where(bins[:, 1] > 4, 5.0, -1.0) + rng.normal(scale=0.1, size=500)
    nodes, value = TF.grow(bins, y, np.ones(500), np.arange(3), 1, 0.0, 1.0, 8)
    assert nodes[0][0] == 1 and nodes[0][1] == 4 and len(nodes) == 3
    assert value[bins[:, 1] > 4] == pytest.approx(y[bins[:, 1] > 4].mean()) and value[bins[:, 1] <= 4] == pytest.approx(y[bins[:, 1] <= 4].mean())
    _, deep = TF.grow(bins, y, np.ones(500), np.arange(3), 10 ** 6, 0.0, 2.0, 8)
    cells = {}
    for b, v in zip(map(tuple, bins), deep, strict=True):
        assert cells.setdefault(b, v) == v  # a tree sees a row only through its bins
    assert ((y - deep) ** 2).sum() < ((y - value) ** 2).sum()


def _grown_by_search(bins, g, h, cols, depth, penalty, least):
    """Nodes by trying every cut of every node, one at a time."""
    nodes, place = [[-1, 0, 0, 0, g.sum() / (h.sum() + penalty)]], np.zeros(len(bins), int)
    level = [0]
    for _ in range(depth):
        following = []
        for k in level:
            at, best = place == k, None
            whole = g[at].sum() ** 2 / (h[at].sum() + penalty)
            for c in cols:
                for cut in range(7):
                    side = bins[at, c] <= cut
                    (a, b), (x, y) = ((g[at][s].sum(), h[at][s].sum()) for s in (side, ~side))
                    if b >= least and y >= least:
                        gain = a * a / (b + penalty) + x * x / (y + penalty) - whole
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = gain, c, cut, a / (b + penalty), x / (y + penalty)
            if best:
                nodes[k][:4] = [best[1], best[2], len(nodes), len(nodes) + 1]
                place[at] = np.where(bins[at, best[1]] <= best[2], len(nodes), len(nodes) + 1)
                following += [len(nodes), len(nodes) + 1]
                nodes += [[-1, 0, 0, 0, best[3]], [-1, 0, 0, 0, best[4]]]
        level = following
    return np.array(nodes), place


@pytest.mark.parametrize("depth, penalty, least", [(3, 1.0, 1.0), (40, 0.0, 2.0)])
def test_trees_equal_a_search_of_every_cut(depth, penalty, least):
    """Few nodes and many, whose histograms hold the bins of their rows only."""
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 8, (150, 3))
    h = rng.integers(0, 3, 150).astype(float)
    g = h * rng.normal(size=150)
    told, place = _grown_by_search(bins, g, h, range(3), depth, penalty, least)
    nodes, value = TF.grow(bins, g, h, np.arange(3), depth, penalty, least, 8)
    assert nodes == pytest.approx(told) and value == pytest.approx(told[place, 4])


def test_every_setting_has_a_task_of_its_own(spark):
    x, y, fold = _data(n=300)
    m = FF.fold_moments(_frame(spark, x, y, fold), COLS, "y", "fold")
    cells = TF.make_cells(m, [m.project(f, None, None) for f in m.folds], bins=8)
    p = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3, "subsample": 1.0, "colsample": 1.0}
    settings = [TF.Setting(v, "gbt", {**p, "max_depth": d}, (2,)) for v in range(len(m.folds)) for d in (2, 3, 4, 5)]
    seen = {}
    whole = TF.cut_lineage
    try:
        TF.cut_lineage = lambda df: seen.setdefault("parts", df.withColumn("part", F.spark_partition_id())).drop("part")
        TF.fit_all(cells, settings)
    finally:
        TF.cut_lineage = whole
    got = [(r["model"], r["part"]) for r in seen["parts"].select("model", "part").collect()]
    assert sorted(r[0] for r in got) == list(range(len(settings))) and len({r[1] for r in got}) == len(settings)


def test_cells_stand_for_their_rows(spark):
    """Fits on added-up rows equal fits on the rows, where nothing is drawn."""
    x, y, fold = _data(n=400)
    x = np.round(x)  # few distinct rows
    m = FF.fold_moments(_frame(spark, x, y, fold), COLS, "y", "fold")
    cells = TF.make_cells(m, [m.project(0, None, None)], bins=16)
    got = cells.table.collect()
    assert sum(r["n"] for r in got) == 400 and len(got) < 400
    bins = cells.binning(0, x)
    n, sy = np.array([r["n"] for r in got if not r["held"]], float), np.array([r["sy"] for r in got if not r["held"]])
    cell_bins = np.stack([np.frombuffer(r["bins"], np.uint8) for r in got if not r["held"]]).astype(int)
    _, by_cell = TF.grow(cell_bins, sy, n, np.arange(4), 6, 1.0, 1.0, 16)
    tr = fold != 0
    _, by_row = TF.grow(bins[tr].astype(int), y[tr], np.ones(tr.sum()), np.arange(4), 6, 1.0, 1.0, 16)
    told = dict(zip(map(bytes, cell_bins.astype(np.uint8)), by_cell, strict=True))
    assert np.array([told[b.tobytes()] for b in bins[tr]]) == pytest.approx(by_row)


def test_too_many_cells_halve_the_bins(spark, monkeypatch):
    x, y, fold = _data(n=400)
    m = FF.fold_moments(_frame(spark, x, y, fold), COLS, "y", "fold")
    monkeypatch.setattr(TF, "MAX_CELLS", 100)
    cells = TF.make_cells(m, [m.project(f, None, None) for f in m.folds])
    assert cells.n_bins < TF.BINS and cells.table.groupBy("view").count().agg(F.max("count")).first()[0] <= 100
    assert all(r["n"] == 400 for r in cells.table.groupBy("view").agg(F.sum("n").alias("n")).collect())


def test_bins_do_not_depend_on_the_number_of_cells(spark):
    d = spark.range(1_100_000).select(*[F.rand(i).alias(c) for i, c in enumerate(COLS)], F.randn(9).alias("y"), (F.col("id") % 2).alias("fold"))
    m = FF.fold_moments(d, COLS, "y", "fold")
    cells = TF.make_cells(m, [m.project(FF.ALL, None, None)])
    told = cells.table.agg(F.count("*").alias("cells"), F.sum("n").alias("n"), F.max(F.conv(F.substring(F.hex("bins"), 1, 2), 16, 10).cast("int")).alias("last")).first()
    assert cells.n_bins == TF.BINS and told["cells"] > 1_000_000 and told["n"] == 1_100_000 and told["last"] == TF.BINS - 1


def _cells(n=700, seed=5):
    """Cells as a task gets them: training and held-out rows of equal bins follow each other."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 5, (n, 4)).astype(np.uint8)
    frame = pd.DataFrame({"bins": [r.tobytes() for r in x], "held": rng.random(n) < 0.3}).drop_duplicates().sort_values(["bins", "held"])
    return frame.assign(model=0, n=rng.integers(1, 4, len(frame)), sy=rng.normal(size=len(frame)), syy=1.0)


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_cells_in_files_give_the_fits_of_cells_in_memory(monkeypatch, kind):
    p = {"gbt": {"max_depth": 5, "learning_rate": 0.3, "subsample": 0.8, "colsample": 0.8}, "forest": {"min_samples_leaf": 2, "max_depth": None}}[kind]
    s, frame = TF.Setting(0, kind, p, (6,), keep=True, errors=True), _cells()
    monkeypatch.setattr(TF, "BLOCK", 50)

    def fitted(held):
        monkeypatch.setattr(TF, "HELD", held)
        return [r for part in TF._fitter([s], 8, 42)(iter([frame[:100], frame[100:]])) for r in part.to_dict("records")]

    whole, parts = fitted(1000), fitted(2)
    assert [(r["bins"], r["pred"], r["fitted"]) for r in whole[:-1]] == [(r["bins"], r["pred"], r["fitted"]) for r in parts[:-1]]
    assert (whole[-1]["n"], whole[-1]["sse"], whole[-1]["fitted"]) == (parts[-1]["n"], parts[-1]["sse"], parts[-1]["fitted"])
    assert sorted(r["bins"] for r in whole[:-1]) == sorted(frame["bins"][frame["held"]])  # every held-out cell once
    if kind == "gbt":  # nor do blocks change the fit; a bootstrap is drawn block by block
        monkeypatch.setattr(TF, "BLOCK", 10 ** 6)
        assert fitted(1000)[-1]["sse"] == pytest.approx(whole[-1]["sse"])


def test_held_out_rows_share_the_cell_of_training_rows():
    frame = _cells()
    d = TF.Fitted(iter([frame]))
    x, count, mean, n, sy, _ = d.cells.get(0)
    train = frame[~frame["held"]]
    assert x.shape[1] == frame["bins"].nunique() < len(frame) and count.sum() == train["n"].sum() and n.sum() == frame["n"][frame["held"]].sum()
    assert (count * mean).sum() == pytest.approx(train["sy"].sum()) and sy.sum() == pytest.approx(frame["sy"][frame["held"]].sum())


def test_cells_are_not_copied_for_every_setting(spark, monkeypatch):
    x, y, fold = _data(n=300)
    m = FF.fold_moments(_frame(spark, x, y, fold), COLS, "y", "fold")
    cells = TF.make_cells(m, [m.project(f, None, None) for f in m.folds], bins=8)
    p = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3, "subsample": 1.0, "colsample": 1.0}
    seen = []
    monkeypatch.setattr(TF, "cut_lineage", lambda df: seen.append(df) or df)
    TF.fit_all(cells, [TF.Setting(v, "gbt", {**p, "max_depth": d}, (2,)) for v in range(len(m.folds)) for d in (2, 3)])
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_trees_beat_linear_and_repeat(spark):
    x, y, fold = _data(n=900)
    m = FF.fold_moments(_frame(spark, x, y, fold), COLS, "y", "fold")
    linear = FF.cross_validate_linear(m, {"linear": {"alpha": None, "n_components": None}})
    cands = {"forest": ("forest", {"n_estimators": 100, "min_samples_leaf": 2, "max_depth": None}),
             "gbt": ("gbt", {"n_estimators": 80, "max_depth": 4, "learning_rate": 0.1, "subsample": 0.8, "colsample": 0.8})}
    first, again = (sorted(TF.cross_validate_trees(m, cands, alpha=None, n_components=None)) for _ in range(2))
    assert first == again and len(first) == 8
    for name in cands:
        assert np.mean([r[2] for r in first if r[0] == name]) > np.mean([r[2] for r in linear]) + 0.03
    assert sum(r[5] for r in first if r[0] == "gbt") == 900 and all(r[4] <= r[3] for r in first)  # MAE is at most RMSE


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_grid_search_scores_every_set_and_refits(spark, kind):
    x, y, fold = _data(n=500)
    d = _frame(spark, x, y, fold)
    m = FF.fold_moments(d, COLS, "y", "fold")
    shared = [{"selection_alpha": [0.01, 0.02], "n_components": [2, 15]}, {"selection_alpha": [0.05], "n_components": [2]}]
    grid = {"gbt": {"learning_rate": [0.1, 0.3], "n_estimators": [10, 30], "max_depth": [3]}, "forest": {"n_estimators": [50, 100], "min_samples_leaf": [2, 5]}}[kind]
    defaults = {"gbt": {"subsample": 0.8, "colsample": 1.0}, "forest": {"max_depth": None}}[kind]
    model, ranking = TF.grid_search_trees(m, kind, shared, grid, defaults, keep=None)
    rows = ranking.collect()
    assert len(rows) == 5 * 4 and min(r["rank"] for r in rows) == 1
    assert max(r["r2_mean"] for r in rows) == next(r["r2_mean"] for r in rows if r["rank"] == 1)
    fit = MP.regression_metrics(model.transform(d), "y").first()
    assert fit["n"] == 500 and fit["r2"] > max(r["r2_mean"] for r in rows) - 0.05
    assert model.transform(d).columns == [*d.columns, "prediction"]
    # a shorter run is read off the longer one
    if kind == "gbt":
        short = TF.grid_search_trees(m, kind, shared, {**grid, "n_estimators": [10]}, defaults, keep=None)[1].collect()
        assert {r["params"]: r["r2_mean"] for r in short}.items() <= {r["params"]: r["r2_mean"] for r in rows}.items()


def test_scaled_cosine_is_a_cosine():
    rng = np.random.default_rng(2)
    a = np.concatenate([rng.normal(scale=s, size=(30, 700)) for s in (1.0, 50.0, 1e4)] + [np.pi / 2 * np.arange(-350, 350).reshape(1, -1)])
    assert np.abs(SF.scaled_cosine(a.copy(), 0.5) - 0.5 * np.cos(a)).max() < 1e-14
    assert np.isnan(SF.scaled_cosine(np.array([[np.nan, 0.0]]), 1.0)).tolist() == [[True, False]]


def test_epsilon_changes_the_fit(spark):
    x, y, fold = _data(n=500)
    d = _frame(spark, x, y, fold)
    m = FF.fold_moments(d, COLS, "y", "fold")
    got = SF.cross_validate_svr(m, {"narrow": {"epsilon": 0.1}, "wide": {"epsilon": 4.0}}, alpha=None, n_components=None, n_features=60)
    r2 = {name: np.mean([r[2] for r in got if r[0] == name]) for name in ("narrow", "wide")}
    assert r2["narrow"] > 0.9 and r2["wide"] < r2["narrow"] - 0.02
    with pytest.raises(ValueError):
        SF.fit_svr(m, [0], c=-1.0)


def test_newton_solves_the_epsilon_insensitive_problem(spark):
    """No small move of the weights lowers the objective."""
    x, y, fold = _data(n=300)
    m = FF.fold_moments(_frame(spark, x, y, fold), COLS, "y", "fold")
    fit = SF.fit_svr(m, [FF.ALL], alpha=None, n_components=None, c=1.0, epsilon=0.5, n_features=10)[FF.ALL]
    z = np.hstack([fit.features(x), np.ones((300, 1))])

    def objective(w):
        return w[:-1] @ w[:-1] / 2 + np.maximum(np.abs(y - z @ w) - 0.5, 0).sum()

    best, rng = objective(fit.weights), np.random.default_rng(0)
    tried = [objective(fit.weights + rng.normal(size=11) * s) for s in (1e-3, 1e-2, 1e-1, 1.0) for _ in range(50)]
    assert min(tried) > best * (1 - 2e-3)


def test_svr_pipeline_takes_epsilon(spark):
    x, y, fold = _data(n=300)
    d = _frame(spark, x, y, fold)
    a, b = (MP.make_pipeline(COLS, "y", "svr_rbf", alpha=0.01, n_components=3, n_random_features=30, epsilon=e).fit(d).transform(d)
            .agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0] for e in (0.1, 5.0))
    assert a < b


def test_a_spark_forest_too_deep_raises():
    with pytest.raises(ValueError, match="30"):
        MP.make_regressor("forest", max_depth=31)


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_tree_shapley_equals_enumeration(spark, kind):
    import itertools
    import math

    from widegrain.operators import explain as X
    x, y, fold = _data(n=200, gaps=True)
    d = _frame(spark, x, y, fold).withColumn("k", F.monotonically_increasing_id())
    m = FF.fold_moments(d, COLS, "y", "fold")
    params = {"gbt": {"n_estimators": 6, "max_depth": 4, "learning_rate": 0.3, "subsample": 1.0, "colsample": 1.0},
              "forest": {"n_estimators": 5, "min_samples_leaf": 5, "max_depth": None}}[kind]
    model = TF.fit_trees(m, kind, params, None, None)
    some, bg = d.limit(5), d.limit(12).select(*COLS)
    got = {(r["k"], r["feature"]): r["phi"] for r in X.tree_shapley(model, some, "k", bg).collect()}
    back = np.array([[np.nan if v is None else v for v in r] for r in bg.collect()])
    for r in some.collect():
        row = np.array([np.nan if r[c] is None else r[c] for c in COLS])

        def worth(taken, row=row):
            mix = back.copy()
            mix[:, list(taken)] = row[list(taken)]
            return model.predict(mix).mean()
        for i, c in enumerate(COLS):
            rest = [j for j in range(4) if j != i]
            phi = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (worth((*s, i)) - worth(s))
                      for n in range(4) for s in itertools.combinations(rest, n))
            assert got[r["k"], c] == pytest.approx(phi, abs=1e-9)
    with pytest.raises(ValueError, match="components"):
        X.tree_shapley(TF.fit_trees(m, kind, params, None, 2), some, "k", bg)


@pytest.mark.parametrize("regions", [1, 60, 4096])
def test_tree_shapley_by_regions_equals_leaf_by_leaf(spark, monkeypatch, regions):
    """Leaves are worked out per region, not anew for every batch of rows."""
    from widegrain.operators import explain as X
    d = _frame(spark, *_data(n=300)).withColumn("k", F.monotonically_increasing_id())
    m = FF.fold_moments(d, COLS, "y", "fold")
    model = TF.fit_trees(m, "gbt", {"n_estimators": 8, "max_depth": 5, "learning_rate": 0.3, "subsample": 1.0, "colsample": 1.0}, None, None)
    bg = d.limit(20).select(*COLS)
    monkeypatch.setattr(X, "MAX_REGIONS", regions)
    phi = X.tree_shapley(model, d, "k", bg)
    mean = model.transform(bg).agg(F.avg("prediction")).first()[0]
    gap = phi.groupBy("k").agg(F.sum("phi").alias("s")).join(model.transform(d), "k").agg(F.max(F.abs(F.col("s") + mean - F.col("prediction")))).first()[0]
    assert gap < 1e-9
    monkeypatch.setattr(X, "MAX_REGIONS", 0)  # every leaf by itself
    slow = {(r["k"], r["feature"]): r["phi"] for r in X.tree_shapley(model, d, "k", bg).collect()}
    assert {(r["k"], r["feature"]): r["phi"] for r in phi.collect()} == pytest.approx(slow, abs=1e-9)
