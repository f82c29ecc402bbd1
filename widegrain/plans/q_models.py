"""Driver-table queries for models, metrics and explanations."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..models import foldfits as FF
from ..models import pipeline as MP
from ..models import svrfits as SF
from ..models import treefits as TF
from ..operators import explain as X
from ..operators import ranking as R
from ..session import cut_lineage
from .registry import register
from .tables import ORDER_FEATURE_COLS, ORDER_FEATURES_SQL, order_features, rnd

_OF = ORDER_FEATURES_SQL


def _one_feature_fit(spark, sf, kind, **params):
    d = order_features(spark, sf)
    asm = VectorAssembler(inputCols=["sum_qty"], outputCol="features")
    est = MP.make_regressor(kind, "features", "revenue", **params)
    m = Pipeline(stages=[asm, est]).fit(d).stages[-1]
    return spark.range(1).select(F.lit(kind).alias("model"), F.round(F.lit(float(m.coefficients[0])), 4).alias("coef"),
                                 F.round(F.lit(float(m.intercept)), 4).alias("intercept"))


_STATS = f"(SELECT covar_pop(sum_qty, revenue) AS c, var_pop(sum_qty) AS v, avg(sum_qty) AS mx, avg(revenue) AS my, count(*) AS n FROM {_OF})"


@register("ols_one_feature", "M11", sql=f"""
SELECT 'linear' AS model, round(c / v, 4) AS coef, round(my - c / v * mx, 4) AS intercept FROM {_STATS}
""")
def ols_one_feature(spark, sf):
    return _one_feature_fit(spark, sf, "linear")


@register("ridge_one_feature", "M12", sql=f"""
SELECT 'ridge' AS model, round(n * c / (n * v + 1000.0), 4) AS coef,
       round(my - n * c / (n * v + 1000.0) * mx, 4) AS intercept FROM {_STATS}
""")
def ridge_one_feature(spark, sf):
    return _one_feature_fit(spark, sf, "ridge", alpha=1000.0)


@register("lasso_one_feature", "M3", sql=f"""
SELECT 'lasso' AS model, round(sign(c) * greatest(abs(c) - 2.0, 0) / v, 4) AS coef,
       round(my - sign(c) * greatest(abs(c) - 2.0, 0) / v * mx, 4) AS intercept FROM {_STATS}
""")
def lasso_one_feature(spark, sf):
    return _one_feature_fit(spark, sf, "lasso", alpha=2.0)


@register("elastic_net_one_feature", "M13", sql=f"""
SELECT 'elasticnet' AS model, round(sign(c) * greatest(abs(c) - 2.0 * 0.5, 0) / (v + 2.0 * 0.5), 4) AS coef,
       round(my - sign(c) * greatest(abs(c) - 2.0 * 0.5, 0) / (v + 2.0 * 0.5) * mx, 4) AS intercept FROM {_STATS}
""")
def elastic_net_one_feature(spark, sf):
    return _one_feature_fit(spark, sf, "elasticnet", alpha=2.0, l1_ratio=0.5)


_MD5 = "md5('42:' || CAST(l_orderkey AS VARCHAR))"
_SPLIT = f"""WITH d AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {_MD5}) <= ceil(0.2 * count(*) OVER ())
                     THEN 'test' ELSE 'train' END AS split FROM {_OF}),
     s AS (SELECT covar_pop(sum_qty, revenue) / var_pop(sum_qty) AS b,
                  avg(revenue) - covar_pop(sum_qty, revenue) / var_pop(sum_qty) * avg(sum_qty) AS a,
                  avg(revenue) AS ybar FROM d WHERE split = 'train'),
     p AS (SELECT d.*, a + b * sum_qty AS pred, ybar FROM d, s)"""


def _split_predictions(spark, sf):
    # the split feature table is read by several jobs: written once to the shared checkpoint folder
    d = cut_lineage(R.exact_split(order_features(spark, sf), ["l_orderkey"], 0.2, 42))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["sum_qty"], outputCol="features"),
                            MP.make_regressor("linear", "features", "revenue")])
    model = pipe.fit(d.where(F.col("split") == "train"))
    pred = model.transform(d)
    return MP.mean_baseline(d.where(F.col("split") == "train"), pred, "revenue", "baseline")   # M31


@register("regression_scores", "A27,A28,M28,M31", sql=_SPLIT + """
SELECT split, 'linear' AS model, count(*) AS n,
       round(1 - sum((revenue - pred) ^ 2) / (count(*) * var_pop(revenue)), 6) AS r2,
       round(sqrt(avg((revenue - pred) ^ 2)), 6) AS rmse, round(avg(abs(revenue - pred)), 6) AS mae,
       round(stddev_samp(revenue - pred), 6) AS resid_sd,
       round(avg(CAST(abs(revenue - pred) <= 1 AS DOUBLE)), 6) AS within_1,
       round(avg(CAST(abs(revenue - pred) <= 2 AS DOUBLE)), 6) AS within_2
FROM p GROUP BY split
UNION ALL
SELECT split, 'mean_baseline', count(*),
       round(1 - sum((revenue - ybar) ^ 2) / (count(*) * var_pop(revenue)), 6),
       round(sqrt(avg((revenue - ybar) ^ 2)), 6), round(avg(abs(revenue - ybar)), 6),
       round(stddev_samp(revenue - ybar), 6),
       round(avg(CAST(abs(revenue - ybar) <= 1 AS DOUBLE)), 6), round(avg(CAST(abs(revenue - ybar) <= 2 AS DOUBLE)), 6)
FROM p GROUP BY split
""")
def regression_scores(spark, sf):
    p = _split_predictions(spark, sf)
    r = MP.regression_report(p, "revenue", {"linear": "prediction", "mean_baseline": "baseline"}, ["split"])
    return r.select("split", "model", "n", *[rnd(c).alias(c) for c in ["r2", "rmse", "mae", "resid_sd"]],
                    rnd("within_1").alias("within_1"), rnd("within_2").alias("within_2"))


@register("largest_test_errors", "W7,J4", sql=_SPLIT + """
SELECT l_orderkey, round(revenue, 3) AS y, round(pred, 3) AS prediction, round(abs(revenue - pred), 3) AS abs_error
FROM p WHERE split = 'test' ORDER BY abs(revenue - pred) DESC, l_orderkey LIMIT 10
""")
def largest_test_errors(spark, sf):
    p = _split_predictions(spark, sf).where(F.col("split") == "test")
    p = p.select("l_orderkey", "revenue", "prediction", F.abs(F.col("revenue") - F.col("prediction")).alias("__e"))
    t = R.top_k(p, "__e", 10, tiebreak=["l_orderkey"])
    return t.select("l_orderkey", F.round("revenue", 3).alias("y"), F.round("prediction", 3).alias("prediction"),
                    F.round("__e", 3).alias("abs_error"))


_PI_FEATS = ["sum_qty", "avg_retail"]
_PI_REPEATS = 15


def _swept_sql(features, table: str) -> str:
    """CTEs ``z0..zp`` that sweep the covariances of ``features`` and the
    revenue in ``table`` one feature at a time, and ``coef(b0, b1..bp)``, the
    least-squares coefficients that stand in the last column."""
    p = len(features)
    cols = [*features, "revenue"]
    every = [(i, j) for i in range(p + 1) for j in range(p + 1)]
    ctes = ["z0 AS (SELECT " + ", ".join(f"covar_pop({cols[i]}, {cols[j]}) AS s{i}_{j}" for i, j in every)
            + "".join(f", avg({c}) AS m{i}" for i, c in enumerate(cols)) + f" FROM {table})"]
    for k in range(p):
        def entry(i, j, k=k):
            if i == k and j == k:
                return f"1 / s{k}_{k}"
            if i == k:
                return f"s{k}_{j} / s{k}_{k}"
            if j == k:
                return f"-s{i}_{k} / s{k}_{k}"
            return f"s{i}_{j} - s{i}_{k} * s{k}_{j} / s{k}_{k}"
        ctes.append(f"z{k + 1} AS (SELECT " + ", ".join(f"{entry(i, j)} AS s{i}_{j}" for i, j in every)
                    + "".join(f", m{i}" for i in range(p + 1)) + f" FROM z{k})")
    slopes = "".join(f", s{i}_{p} AS b{i + 1}" for i in range(p))
    ctes.append(f"coef AS (SELECT m{p} - " + " - ".join(f"s{i}_{p} * m{i}" for i in range(p)) + f" AS b0{slopes} FROM z{p})")
    return ",\n     ".join(ctes)


def _linear_sql(names) -> str:
    return "b0 + " + " + ".join(f"b{i + 1} * {c}" for i, c in enumerate(names))


_PI_COLS = ORDER_FEATURE_COLS
_PI_SWAPPED = ",\n       ".join(
    f"(SELECT '{f}' AS f, r, 1 - sum((revenue - ({_linear_sql([f'd_{c}' if c == f else c for c in _PI_COLS])})) ^ 2) / (count(*) * var_pop(revenue)) AS r2"
    f" FROM pairs, coef GROUP BY r)" for f in _PI_COLS).replace(",\n       (SELECT", "\n       UNION ALL (SELECT")


def _ols_model(d, features):
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"),
                            MP.make_regressor("linear", "features", "revenue")])
    return pipe.fit(d)


@register("permutation_importance_orders", "M21", sql=f"""
WITH d AS {_OF},
     {_swept_sql(_PI_COLS, 'd')},
     nat AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(l_orderkey AS VARCHAR))) AS pos FROM d),
     don AS (SELECT CAST(t.r AS INTEGER) AS r, {', '.join(f'{c} AS d_{c}' for c in _PI_COLS)},
                    row_number() OVER (PARTITION BY t.r ORDER BY md5(CAST(t.r AS VARCHAR) || ':42:' || CAST(l_orderkey AS VARCHAR))) AS pos
             FROM d, range({_PI_REPEATS}) t(r)),
     pairs AS (SELECT nat.*, don.* EXCLUDE (pos) FROM nat JOIN don ON nat.pos = don.pos),
     base AS (SELECT 1 - sum((revenue - ({_linear_sql(_PI_COLS)})) ^ 2) / (count(*) * var_pop(revenue)) AS r2 FROM d, coef),
     per AS ({_PI_SWAPPED})
SELECT f AS feature, round(avg(base.r2 - per.r2), 6) AS importance_mean,
       round(stddev_pop(base.r2 - per.r2), 6) AS importance_std
FROM per, base GROUP BY f
""")
def permutation_importance_orders(spark, sf):
    d = cut_lineage(order_features(spark, sf).select("l_orderkey", "revenue", *_PI_COLS))
    summ, _ = X.permutation_importance(_ols_model(d, _PI_COLS), d, _PI_COLS, "revenue", "l_orderkey", _PI_REPEATS, 42)
    return summ.select("feature", rnd("importance_mean").alias("importance_mean"),
                       rnd("importance_std").alias("importance_std"))


@register("shapley_linear_orders", "M22", sql=f"""
WITH d AS {_OF},
     {_swept_sql(_PI_COLS, 'd')},
     bg AS (SELECT {', '.join(f'avg({c}) AS z_{c}' for c in _PI_COLS)} FROM (
              SELECT * FROM d QUALIFY row_number() OVER (ORDER BY md5('42:' || CAST(l_orderkey AS VARCHAR))) <= 100))
{' UNION ALL '.join(f"SELECT '{c}' AS feature, round(avg(abs(b{i + 1} * ({c} - z_{c}))), 4) AS mean_abs_phi FROM d, coef, bg" for i, c in enumerate(_PI_COLS))}
""")
def shapley_linear_orders(spark, sf):
    d = cut_lineage(order_features(spark, sf).select("l_orderkey", "revenue", *_PI_COLS))
    bg = R.seeded_sample(d, ["l_orderkey"], 100, 42)
    phi = X.shapley_values(_ols_model(d, _PI_COLS), d, _PI_COLS, "l_orderkey", bg, n_permutations=1, seed=42)
    return X.mean_abs_attribution(phi).select("feature", F.round("mean_abs_phi", 4).alias("mean_abs_phi"))


@register("shapley_trees_orders", "M22,M15")
def shapley_trees_orders(spark, sf):
    """Boosted trees on the five features: mean |phi|, and how far the sum of a
    row's values is from its prediction less the background's mean."""
    m = FF.fold_moments(R.kfold_assign(order_features(spark, sf), ["l_orderkey"], 5, 42), _PI_COLS, "revenue", "fold")
    model = TF.fit_trees(m, "gbt", {**MP.DEFAULTS["gbt"], "n_estimators": 100}, None, None)
    d = cut_lineage(order_features(spark, sf).select("l_orderkey", *_PI_COLS))
    bg = R.seeded_sample(d, ["l_orderkey"], 100, 42)
    phi = cut_lineage(X.tree_shapley(model, d, "l_orderkey", bg))
    mean = float(model.transform(bg).agg(F.avg("prediction")).first()[0])
    gap = (phi.groupBy("l_orderkey").agg(F.sum("phi").alias("s")).join(model.transform(d).select("l_orderkey", "prediction"), "l_orderkey")
           .agg(F.max(F.abs(F.col("s") - F.col("prediction") + mean)).alias("largest_gap")))
    return X.mean_abs_attribution(phi).crossJoin(F.broadcast(gap)).select("feature", rnd("mean_abs_phi").alias("mean_abs_phi"),
                                                                          (F.col("largest_gap") < 1e-6).alias("adds_up"))


# ---- rows-only model-selection queries (no SQL twin: fitted ML models) ---- #

def _folded(spark, sf):
    return R.kfold_assign(order_features(spark, sf), ["l_orderkey"], 5, 42)


def _moments(spark, sf, features=ORDER_FEATURE_COLS):
    return FF.fold_moments(_folded(spark, sf), features, "revenue", "fold")


@register("cv_candidates_orders", "M10,M14,M15,M16,M18,M2,M4,M6,I7")
def cv_candidates_orders(spark, sf):
    """The six candidates with the library's defaults on identical folds."""
    m, shared = _moments(spark, sf), {"alpha": 0.0055, "n_components": 3}
    ridge, net, svr = MP.DEFAULTS["ridge"], MP.DEFAULTS["elasticnet"], MP.DEFAULTS["svr_rbf"]
    rows = FF.cross_validate_linear(m, {"linear": {"kind": "linear", **shared}, "ridge": {"kind": "ridge", "penalty": ridge["alpha"], **shared},
                                        "elasticnet": {"kind": "elasticnet", "penalty": net["alpha"], "l1_ratio": net["l1_ratio"], **shared}})
    rows += SF.cross_validate_svr(m, {"svr_rbf": {"c": svr["C"], "epsilon": svr["epsilon"]}}, **shared)
    rows += TF.cross_validate_trees(m, {"forest": ("forest", MP.FOREST), "gbt": ("gbt", MP.DEFAULTS["gbt"])}, **shared)
    summary = FF.score_summary(m, rows)
    return summary.select("model", *[rnd(c).alias(c) for c in summary.columns if c not in ("model", "rank")], "rank")


@register("grid_search_orders", "M19,M25,W6")
def grid_search_orders(spark, sf):
    """Every set of the reference's union of grids for boosting, and the best one refitted."""
    model, ranking = TF.grid_search_trees(_moments(spark, sf), "gbt", MP.SHARED_GRIDS, MP.REGRESSOR_GRIDS["gbt"], MP.DEFAULTS["gbt"], keep=None)
    return ranking.withColumn("refit_trees", F.when(F.col("rank") == 1, F.lit(len(model.trees))))


@register("component_sweep_orders", "M26,M25")
def component_sweep_orders(spark, sf):
    return FF.component_sweep(_moments(spark, sf), range(1, 31))


_FOLDS2 = f"""d AS (SELECT *, (row_number() OVER (ORDER BY {_MD5}) - 1) % 5 AS fold FROM {_OF}),
     t AS (SELECT v.f, avg(sum_qty) AS m1, avg(avg_retail) AS m2, avg(revenue) AS my, var_pop(sum_qty) AS s11, var_pop(avg_retail) AS s22,
                  covar_pop(sum_qty, avg_retail) AS s12, covar_pop(sum_qty, revenue) AS s1y, covar_pop(avg_retail, revenue) AS s2y
           FROM (SELECT DISTINCT fold AS f FROM d) v JOIN d ON d.fold <> v.f GROUP BY v.f),
     ols AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2,
                    sign(s12) AS sg FROM t)"""
_SCORED2 = """per AS (SELECT variant, fold, 1 - sum((revenue - p) ^ 2) / (count(*) * var_pop(revenue)) AS r2,
                    sqrt(avg((revenue - p) ^ 2)) AS rmse FROM scored GROUP BY variant, fold)"""


@register("component_sweep_two_orders", "M26,M18,M6,M2", sql=f"""
WITH {_FOLDS2},
     one AS (SELECT *, (s1y / sqrt(s11) + sg * s2y / sqrt(s22)) / (2 + 2 * abs(s12) / sqrt(s11 * s22)) AS slope FROM ols),
     scored AS (
       SELECT 1 AS variant, d.fold, revenue, my + slope * ((sum_qty - m1) / sqrt(s11) + sg * (avg_retail - m2) / sqrt(s22)) AS p
       FROM d JOIN one ON f = fold
       UNION ALL SELECT 2, d.fold, revenue, my + b1 * (sum_qty - m1) + b2 * (avg_retail - m2) FROM d JOIN one ON f = fold),
     {_SCORED2}
SELECT variant AS n_components, round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std, round(avg(rmse), 6) AS rmse_mean,
       CAST(rank() OVER (ORDER BY avg(r2) DESC) AS INTEGER) AS rank
FROM per GROUP BY variant
""")
def component_sweep_two_orders(spark, sf):
    sweep = FF.component_sweep(_moments(spark, sf, _PI_FEATS), [1, 2], alpha=None)
    return sweep.select("n_components", *[rnd(c).alias(c) for c in ("r2_mean", "r2_std", "rmse_mean")], "rank")


@register("block_sensitivity_two_orders", "M24", sql=f"""
WITH {_FOLDS2},
     scored AS (
       SELECT 'all' AS variant, d.fold, revenue, my + b1 * (sum_qty - m1) + b2 * (avg_retail - m2) AS p FROM d JOIN ols ON f = fold
       UNION ALL SELECT 'without_size', d.fold, revenue, my + s2y / s22 * (avg_retail - m2) FROM d JOIN ols ON f = fold
       UNION ALL SELECT 'without_price', d.fold, revenue, my + s1y / s11 * (sum_qty - m1) FROM d JOIN ols ON f = fold),
     {_SCORED2}
SELECT variant, round(avg(r2), 6) AS r2_mean, round(avg(rmse), 6) AS rmse_mean FROM per GROUP BY variant
""")
def block_sensitivity_two_orders(spark, sf):
    got = FF.without_blocks(_moments(spark, sf, _PI_FEATS), {"size": ["sum_qty"], "price": ["avg_retail"]}, alpha=None, n_components=None)
    return got.select("variant", rnd("r2_mean").alias("r2_mean"), rnd("rmse_mean").alias("rmse_mean"))


@register("pca_loadings_orders", "M9,M6,M7")
def pca_loadings_orders(spark, sf):
    d = order_features(spark, sf)
    pipe = MP.make_pipeline(ORDER_FEATURE_COLS, "revenue", "linear", select=False, n_components=3)
    m = pipe.fit(d)
    from ..models.transformers import CentredPCAModel
    return X.pca_loadings(MP.stage_of(m, CentredPCAModel), ORDER_FEATURE_COLS)


@register("lasso_coefficients_orders", "M29,M3,M4")
def lasso_coefficients_orders(spark, sf):
    d = order_features(spark, sf)
    pipe = MP.make_pipeline(ORDER_FEATURE_COLS, "revenue", "lasso", select=False, reduce=False, alpha=0.01)
    m = pipe.fit(d)
    return X.coefficient_table(m.stages[-1].coefficients, ORDER_FEATURE_COLS)


@register("lasso_cv_orders", "M5")
def lasso_cv_orders(spark, sf):
    d = _folded(spark, sf)
    path, best, _ = MP.lasso_cv(d, ORDER_FEATURE_COLS, "revenue", "fold", n_alphas=100, scale=True)
    return path.withColumn("best", F.col("alpha") == F.lit(best))


@register("block_pca_orders", "M8")
def block_pca_orders(spark, sf):
    d = R.exact_split(order_features(spark, sf), ["l_orderkey"], 0.2, 42)
    tr, te, _ = MP.block_pca(d.where("split = 'train'"), d.where("split = 'test'"),
                             ["avg_disc", "avg_tax", "avg_retail"], k=2)
    return tr.unionByName(te)


@register("block_sensitivity_orders", "M24,M30,M25")
def block_sensitivity_orders(spark, sf):
    return FF.without_blocks(_moments(spark, sf), {"size": ["sum_qty", "n_lines"], "rates": ["avg_disc", "avg_tax"]}, n_components=3, stages=True)
