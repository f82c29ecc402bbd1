"""Regressor factory, the shared impute -> scale -> select -> reduce -> regress
pipeline (M10), cross-validation (M18), grid search (M19), metrics (A27, A28,
M28, M31) and the interactive retrain (M27).

Penalty mapping from the sklearn objectives to Spark's (probed, see SURVEY):
ridge ``regParam = alpha * sd_pop(y) / n``; elastic net
``regParam = alpha * (rho + sd_pop(y) * (1 - rho))``,
``elasticNetParam = alpha * rho / regParam``; lasso ``regParam = alpha`` —
all with ``standardization=False`` and the normal-equation solver.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .svrfits import EpsilonInsensitiveRegression
from .transformers import (CentredPCA, ImputeScale, LassoSelector, LassoSelectorModel, MedianImputer,
                           PopulationScaler, RandomFourierFeatures)


class _PenaltyParams(Params):
    kind = Param(Params._dummy(), "kind", "ridge | elasticnet | lasso | linear", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "sklearn alpha", TypeConverters.toFloat)
    l1Ratio = Param(Params._dummy(), "l1Ratio", "sklearn l1_ratio", TypeConverters.toFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)


class PenalizedLinearRegression(Estimator, _PenaltyParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear regression with sklearn's penalty conventions.

    The Spark penalty depends on n and the population sd of the training
    label, so both are measured at fit time (one aggregate) before the
    distributed normal-equation fit."""

    @keyword_only
    def __init__(self, kind="linear", alpha=0.0, l1Ratio=0.5, featuresCol="features", labelCol="label",
                 predictionCol="prediction"):
        super().__init__()
        self._setDefault(kind="linear", alpha=0.0, l1Ratio=0.5, featuresCol="features", labelCol="label",
                         predictionCol="prediction")
        self._set(**self._input_kwargs)

    def spark_params(self, n: int, sd: float) -> tuple[float, float]:
        kind, a, rho = self.getOrDefault(self.kind), self.getOrDefault(self.alpha), self.getOrDefault(self.l1Ratio)
        if kind == "linear" or a == 0:
            return 0.0, 0.0
        if kind == "ridge":
            return a * sd / n, 0.0
        if kind == "lasso":
            return a, 1.0
        lam = a * (rho + sd * (1 - rho))
        return lam, a * rho / lam

    def _fit(self, dataset: DataFrame):
        y = self.getOrDefault(self.labelCol)
        kind, a = self.getOrDefault(self.kind), self.getOrDefault(self.alpha)
        if kind in ("ridge", "elasticnet") and a > 0:     # only these penalties depend on n and sd(y)
            st = dataset.agg(F.count(F.col(y)).alias("n"), F.stddev_pop(F.col(y)).alias("sd")).first()
            reg, enet = self.spark_params(int(st["n"]), float(st["sd"] or 0.0))
        else:
            reg, enet = self.spark_params(1, 1.0)
        lr = LinearRegression(featuresCol=self.getOrDefault(self.featuresCol), labelCol=y,
                              predictionCol=self.getOrDefault(self.predictionCol), regParam=reg,
                              elasticNetParam=enet, standardization=False, solver="normal",
                              maxIter=1000, tol=1e-12)
        return lr.fit(dataset)


# The reference's default hyper-parameters per candidate.
DEFAULTS = {
    "linear": {},
    "ridge": {"alpha": 1.0},
    "elasticnet": {"alpha": 0.01, "l1_ratio": 0.5},
    "svr_rbf": {"C": 10.0, "epsilon": 0.1},
    "forest": {"n_estimators": 400, "min_samples_leaf": 2, "max_depth": 30},
    "gbt": {"n_estimators": 400, "max_depth": 6, "learning_rate": 0.05, "subsample": 0.8, "colsample": 0.8},
}

#: the forest without a bound on its depth, as ``treefits`` grows it
FOREST = {"n_estimators": DEFAULTS["forest"]["n_estimators"], "min_samples_leaf": DEFAULTS["forest"]["min_samples_leaf"], "max_depth": None}


def make_regressor(kind: str, features_col: str = "features", label: str = "label", seed: int = 42,
                   **params) -> Estimator:
    """Spark estimator for one reference candidate."""
    p = {**DEFAULTS.get(kind, {}), **params}
    if kind in ("linear", "ridge", "lasso"):
        return PenalizedLinearRegression(kind=kind, alpha=float(p.get("alpha", 0.0)), featuresCol=features_col,
                                         labelCol=label)
    if kind == "elasticnet":
        return PenalizedLinearRegression(kind="elasticnet", alpha=float(p["alpha"]), l1Ratio=float(p["l1_ratio"]),
                                         featuresCol=features_col, labelCol=label)
    if kind == "forest":
        if int(p["max_depth"]) > 30:
            raise ValueError("a forest in a Spark pipeline is at most 30 levels deep; treefits has no such bound")
        return RandomForestRegressor(featuresCol=features_col, labelCol=label, numTrees=int(p["n_estimators"]),
                                     minInstancesPerNode=int(p["min_samples_leaf"]),
                                     maxDepth=int(p["max_depth"]), featureSubsetStrategy="all", seed=seed)
    if kind == "gbt":
        return GBTRegressor(featuresCol=features_col, labelCol=label, maxIter=int(p["n_estimators"]),
                            maxDepth=int(p["max_depth"]), stepSize=float(p["learning_rate"]),
                            subsamplingRate=float(p["subsample"]), featureSubsetStrategy=str(p["colsample"]),
                            seed=seed)
    raise ValueError(f"unknown regressor {kind!r}")


def make_pipeline(features: Sequence[str], label: str, kind: str = "linear", alpha: float = 0.0055,
                  n_components: int = 15, select: bool = True, reduce: bool = True, **params) -> Pipeline:
    """The shared pipeline (M10): train-fitted median impute (I7) and
    population scaling (M2) in one fitted stage -> assemble -> lasso selection
    (M4) -> centred PCA (M6) -> regressor. Every stage is
    refitted inside each CV fold, so nothing leaks across folds."""
    features = list(features)
    stages = [ImputeScale(inputCols=features), VectorAssembler(inputCols=features, outputCol="assembled")]
    cur = "assembled"
    if select:
        stages.append(LassoSelector(featuresCol=cur, labelCol=label, outputCol="selected", alpha=alpha))
        cur = "selected"
    if reduce:
        stages.append(CentredPCA(k=n_components, inputCol=cur, outputCol="pca"))
        cur = "pca"
    if kind == "svr_rbf":
        stages.append(RandomFourierFeatures(inputCol=cur, outputCol="rff", numFeatures=int(params.pop("n_random_features", 200))))
        p = {**DEFAULTS["svr_rbf"], **params}
        stages.append(EpsilonInsensitiveRegression(featuresCol="rff", labelCol=label, c=float(p["C"]), epsilon=float(p["epsilon"])))
    else:
        stages.append(make_regressor(kind, cur, label, **params))
    return Pipeline(stages=stages)


# --------------------------------------------------------------------------- #
# metrics
# --------------------------------------------------------------------------- #

def stage_of(pipeline_or_model, cls):
    """The first stage of a (fitted) pipeline that is an instance of ``cls``."""
    stages = pipeline_or_model.getStages() if hasattr(pipeline_or_model, "getStages") else pipeline_or_model.stages
    return next(s for s in stages if isinstance(s, cls))


def regression_metrics(df: DataFrame, label: str, pred: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """R², RMSE and MAE (A27) per group in one aggregate:
    ``1 - SSE / (n * var_pop(y))``, ``sqrt(SSE / n)``, ``avg(|y - p|)``."""
    e = F.col(label) - F.col(pred)
    d = df.where(F.col(label).isNotNull() & F.col(pred).isNotNull())
    a = d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("__sse"),
                           F.var_pop(label).alias("__v"), F.avg(F.abs(e)).alias("mae"))
    return a.select(*by, "n", (F.lit(1.0) - F.try_divide(F.col("__sse"), F.col("n") * F.col("__v"))).alias("r2"),
                    F.sqrt(F.col("__sse") / F.col("n")).alias("rmse"), "mae")


def residual_summary(df: DataFrame, label: str, pred: str = "prediction", by: Sequence[str] = (),
                     limits: Sequence[float] = (1.0, 2.0)) -> DataFrame:
    """Residual sample sd and the share of |residual| <= each limit."""
    r = F.col(label) - F.col(pred)
    return df.groupBy(*by).agg(F.stddev_samp(r).alias("resid_sd"),
                               *[F.avg((F.abs(r) <= k).cast("double")).alias(f"within_{k:g}") for k in limits])


def regression_report(df: DataFrame, label: str, preds: Mapping[str, str], by: Sequence[str] = (),
                      limits: Sequence[float] = (1.0, 2.0)) -> DataFrame:
    """A27 + A28 for several prediction columns in **one** aggregate pass:
    rows (by..., model, n, r2, rmse, mae, resid_sd, within_<k>...). Each
    column is scored on the rows where it and the label are present."""
    y = F.col(label)
    aggs = []
    for i, (name, col) in enumerate(preds.items()):
        e = y - F.col(col)
        ok = y.isNotNull() & F.col(col).isNotNull()
        ee = F.when(ok, e)
        aggs += [F.count_if(ok).alias(f"n{i}"), F.var_pop(F.when(ok, y)).alias(f"v{i}"), F.sum(ee * ee).alias(f"sse{i}"), F.avg(F.abs(ee)).alias(f"mae{i}"),
                 F.stddev_samp(ee).alias(f"sd{i}"),
                 *[F.avg(F.when(ok, (F.abs(e) <= k).cast("double"))).alias(f"w{i}_{j}") for j, k in enumerate(limits)]]
    a = df.groupBy(*by).agg(*aggs)
    names = ["model", "n", "r2", "rmse", "mae", "resid_sd", *[f"within_{k:g}" for k in limits]]
    rows = []
    for i, name in enumerate(preds):
        n = F.col(f"n{i}")
        rows.append(F.struct(F.lit(name).alias(names[0]), n.alias(names[1]),
                             (F.lit(1.0) - F.try_divide(F.col(f"sse{i}"), n * F.col(f"v{i}"))).alias(names[2]),
                             F.sqrt(F.try_divide(F.col(f"sse{i}"), n)).alias(names[3]), F.col(f"mae{i}").alias(names[4]),
                             F.col(f"sd{i}").alias(names[5]),
                             *[F.col(f"w{i}_{j}").alias(names[6 + j]) for j in range(len(limits))]))
    return a.select(*by, F.explode(F.array(*rows)).alias("__s")).select(*by, "__s.*")


def mean_baseline(train: DataFrame, df: DataFrame, label: str, pred: str = "prediction") -> DataFrame:
    """Mean-prediction baseline (M31): predict the training mean everywhere."""
    m = train.agg(F.avg(label)).first()[0]
    return df.withColumn(pred, F.lit(float(m)))


# --------------------------------------------------------------------------- #
# cross-validation and grid search
# --------------------------------------------------------------------------- #

def cross_validate(df: DataFrame, candidates: Mapping[str, Estimator], label: str, fold_col: str = "fold",
                   k: int | None = None, parallelism: int = 2) -> tuple[DataFrame, DataFrame]:
    """Evaluate candidates on identical folds (M18). Returns (per-fold table,
    summary with mean and population sd of R², RMSE, MAE and fit seconds).

    Each (candidate, fold) fit is an ordinary distributed Spark job; the
    driver only schedules them (``parallelism`` at a time) and reads one
    metrics row per fit. The input is checkpointed once so all fits read the
    same materialised rows.
    """
    from ..session import cut_lineage
    from pyspark import StorageLevel
    spark = df.sparkSession
    data = cut_lineage(df).persist(StorageLevel.MEMORY_AND_DISK)   # many fits scan it; recomputed from the checkpoint if lost
    folds = k if k is not None else [r[0] for r in data.select(fold_col).distinct().collect()]
    folds = list(range(folds)) if isinstance(folds, int) else sorted(folds)

    def run(item):
        name, est, f = item
        train, valid = data.where(F.col(fold_col) != f), data.where(F.col(fold_col) == f)
        t0 = time.time()
        model = est.fit(train)
        fit_sec = time.time() - t0
        m = regression_metrics(model.transform(valid), label).first()
        return (name, int(f), float(m["r2"]), float(m["rmse"]), float(m["mae"]), float(fit_sec), int(m["n"]))

    work = [(n, e, f) for n, e in candidates.items() for f in folds]
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            rows = list(ex.map(run, work))
    finally:
        data.unpersist()
    per_fold = spark.createDataFrame(rows, "model string, fold int, r2 double, rmse double, mae double, "
                                           "fit_sec double, n long")
    from ..operators.ranking import competition_rank
    summary = per_fold.groupBy("model").agg(
        *[F.avg(c).alias(f"{c}_mean") for c in ["r2", "rmse", "mae", "fit_sec"]],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in ["r2", "rmse", "mae", "fit_sec"]])
    return per_fold, competition_rank(summary, "r2_mean")   # one row per candidate


def grid_search(df: DataFrame, estimator: Estimator, grids: Sequence[list], label: str, fold_col: str = "fold",
                parallelism: int = 2, keep: int | None = 10):
    """Grid search over a **union** of grids (M19): the param-map lists are
    concatenated, scored by mean CV R² on the fold column, ranked with
    competition ties (W6) and the best refitted on all rows.
    Returns (cv_model, ranking DataFrame)."""
    from ..operators.ranking import competition_rank
    from ..session import cut_lineage
    from pyspark import StorageLevel
    maps = [m for g in grids for m in g]
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")
    data = cut_lineage(df).persist(StorageLevel.MEMORY_AND_DISK)
    n_folds = data.select(fold_col).distinct().count()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev, foldCol=fold_col,
                        numFolds=n_folds, parallelism=parallelism, collectSubModels=False)
    try:
        model = cv.fit(data)
    finally:
        data.unpersist()
    rows = [(i, "; ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)),
             float(model.avgMetrics[i]), float(model.stdMetrics[i]) if model.stdMetrics else None)
            for i, m in enumerate(maps)]
    table = df.sparkSession.createDataFrame(rows, "param_set int, params string, r2_mean double, r2_std double")
    return model, competition_rank(table, "r2_mean", keep=keep)


def train_and_evaluate(train: DataFrame, test: DataFrame, estimator: Estimator, label: str, key: str):
    """Interactive retrain (M27): fit on train, metrics on test (A27) and the
    residual table (key, y, prediction, residual, abs_error) (J4, W7)."""
    model = estimator.fit(train)
    pred = model.transform(test)
    resid = pred.select(key, F.col(label).alias("y"), "prediction",
                        (F.col(label) - F.col("prediction")).alias("residual"),
                        F.abs(F.col(label) - F.col("prediction")).alias("abs_error"))
    return model, regression_metrics(pred, label), resid


def score_table(parts: Mapping[str, DataFrame], label: str, pred: str = "prediction") -> DataFrame:
    """Final score table (M28): one A27 row per named prediction set."""
    out = None
    for name, d in parts.items():
        m = regression_metrics(d, label, pred).withColumn("split", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out


def cap_components(df: DataFrame, features: Sequence[str], label: str, fold_col: str, alpha: float,
                   tuned_n: int) -> int:
    """Cap the component count at the smallest per-fold selection size."""
    sizes = []
    for f in [r[0] for r in df.select(fold_col).distinct().collect()]:
        pipe = make_pipeline(features, label, "linear", alpha=alpha, reduce=False)
        m = pipe.fit(df.where(F.col(fold_col) != f))
        sel = next(st for st in m.stages if isinstance(st, LassoSelectorModel))
        sizes.append(len(sel.getOrDefault("indices")))
    return min(tuned_n, min(sizes))


# --------------------------------------------------------------------------- #
# M5 LassoCV from per-fold sufficient statistics, M8 block PCA, M24 sensitivity
# --------------------------------------------------------------------------- #

def lasso_cv(df: DataFrame, features: Sequence[str], label: str, fold_col: str = "fold", n_alphas: int = 100,
             eps: float = 1e-3, alphas: Sequence[float] | None = None, scale: bool = False):
    """Lasso with a cross-validated alpha (M5), like ``LassoCV``: alpha grid of
    ``n_alphas`` log-spaced values from ``alpha_max`` down to ``eps*alpha_max``,
    mean validation MSE per alpha over the folds, best alpha refitted on all.

    One distributed pass gathers per-fold sufficient statistics (XᵀX, Xᵀy,
    sums, n — p x p per fold); every fit and every validation error then
    follows from them on the driver (train = total minus fold). Rows with a
    null feature or label are dropped. ``scale`` divides every feature by its
    population sd over all rows first (from the same moments). Returns (path
    DataFrame (alpha, mse_mean, mse_std), best alpha, coefficients on all rows).
    """
    import numpy as np

    from .transformers import MOMENTS_SCHEMA, collect_moments, lasso_coordinate_descent, moments_partition
    feats = list(features)
    p = len(feats)
    d = df.select(*[F.col(c).cast("double") for c in feats], F.col(label).cast("double"),
                  F.col(fold_col).cast("int")).na.drop()
    per_fold = collect_moments(d.mapInArrow(moments_partition(p, with_groups=True), MOMENTS_SCHEMA), p)
    rows = [per_fold[f] for f in sorted(per_fold)]

    def stats(rs):
        return tuple(sum(r[i] for r in rs) for i in range(6))

    def centred(st):
        xtx, xty, sx, sy, syy, n = st
        mx, my = sx / n, sy / n
        return xtx / n - np.outer(mx, mx), xty / n - mx * my, mx, my

    total = stats(rows)
    C_all, c_all, _, _ = centred(total)
    if scale:
        sd = np.sqrt(np.maximum(np.diag(C_all), 0.0))
        sd[sd == 0] = 1.0
        rows = [(xtx / np.outer(sd, sd), xty / sd, sx / sd, sy, syy, n) for xtx, xty, sx, sy, syy, n in rows]
        total = stats(rows)
        C_all, c_all, _, _ = centred(total)
    if alphas is None:
        a_max = float(np.max(np.abs(c_all)))
        alphas = np.logspace(np.log10(a_max * eps), np.log10(a_max), n_alphas)[::-1]
    mse = np.zeros((len(alphas), len(rows)))
    for fi, r in enumerate(rows):
        fold = r
        train = tuple(t - f for t, f in zip(total, fold))
        C, c, mx, my = centred(train)
        xtx, xty, sx, sy, syy, n = fold
        for ai, a in enumerate(alphas):
            w = lasso_coordinate_descent(C, c, float(a), tol=1e-10)
            b = my - mx @ w
            # validation SSE of y - b - Xw expanded in the fold's moments
            sse = syy - 2 * (b * sy + w @ xty) + b * b * n + 2 * b * (w @ sx) + w @ xtx @ w
            mse[ai, fi] = sse / n
    best = int(np.argmin(mse.mean(1)))
    w_best = lasso_coordinate_descent(C_all, c_all, float(alphas[best]))
    path = df.sparkSession.createDataFrame(
        [(float(a), float(mse[i].mean()), float(mse[i].std())) for i, a in enumerate(alphas)],
        "alpha double, mse_mean double, mse_std double")
    return path, float(alphas[best]), w_best


def block_pca(train: DataFrame, test: DataFrame, family: Sequence[str], k: int = 2, prefix: str = "block_pc"):
    """Block PCA (M8): replace a column family by its first ``k`` principal
    components, fitted on train only (median-imputed, centred, unscaled), as
    plain columns ``<prefix>1..k``; the family columns are dropped.
    Returns (train_out, test_out, fitted PipelineModel)."""
    from pyspark.ml.functions import vector_to_array
    fam = list(family)
    pipe = Pipeline(stages=[MedianImputer(inputCols=fam), VectorAssembler(inputCols=fam, outputCol="__fam"),
                            CentredPCA(k=k, inputCol="__fam", outputCol="__pcs")])
    model = pipe.fit(train)

    def apply(d):
        t = model.transform(d)
        arr = vector_to_array(F.col("__pcs"))
        keep = [c for c in d.columns if c not in set(fam)]
        return t.select(*keep, *[arr[i].alias(f"{prefix}{i + 1}") for i in range(k)])
    return apply(train), apply(test), model


def block_sensitivity(df: DataFrame, features: Sequence[str], block: Sequence[str], label: str,
                      fold_col: str = "fold", kind: str = "linear", **pipe_params) -> DataFrame:
    """Sensitivity to a block of predictors (M24): CV with all features and
    without the block on identical folds; rows (variant, r2_mean, rmse_mean).
    The component count is capped per variant (M25)."""
    def variant(cols):
        settings = dict(pipe_params)
        if settings.get("select", True) and settings.get("reduce", True):
            settings["n_components"] = cap_components(df, cols, label, fold_col, settings.get("alpha", 0.0055),
                                                      settings.get("n_components", 15))
        return make_pipeline(cols, label, kind, **settings)

    cands = {"all": variant(list(features)), "without_block": variant([c for c in features if c not in set(block)])}
    _, summary = cross_validate(df, cands, label, fold_col)
    return summary.select(F.col("model").alias("variant"), "r2_mean", "rmse_mean")


# The reference's tuning grids (shared selection/PCA grids and
# one grid per regressor), in its parameter names.
SHARED_GRIDS = [
    {"selection_alpha": [0.0055, 0.01], "n_components": [10, 15, 25]},
    {"selection_alpha": [0.05], "n_components": [10, 15, 20]},
]
REGRESSOR_GRIDS = {
    "linear": {},
    "ridge": {"alpha": [0.1, 1.0, 10.0]},
    "elasticnet": {"alpha": [0.005, 0.01, 0.05], "l1_ratio": [0.2, 0.5, 0.8]},
    "svr_rbf": {"C": [1.0, 10.0, 50.0], "epsilon": [0.05, 0.1, 0.3]},
    "forest": {"n_estimators": [400, 800], "min_samples_leaf": [1, 2, 5]},
    "gbt": {"learning_rate": [0.03, 0.05, 0.1], "n_estimators": [300, 600], "max_depth": [4, 6, 8]},
}


def reference_param_grid(pipeline: Pipeline, kind: str, max_components: int | None = None) -> list[list]:
    """The reference's union of grids (M19) as Spark param maps for a pipeline
    from ``make_pipeline`` (one list per shared grid, for ``grid_search``).

    Component counts above ``max_components`` are capped (and de-duplicated),
    as the reference caps them so no fold asks for more components than it
    has features."""
    from pyspark.ml.tuning import ParamGridBuilder
    stages = pipeline.getStages()
    sel = next(s for s in stages if isinstance(s, LassoSelector))
    pca = next(s for s in stages if isinstance(s, (PCA, CentredPCA)))
    reg = stages[-1]
    spark_name = {"alpha": "alpha", "C": "c", "epsilon": "epsilon", "l1_ratio": "l1Ratio", "n_estimators": "numTrees" if kind == "forest" else "maxIter",
                  "min_samples_leaf": "minInstancesPerNode", "learning_rate": "stepSize", "max_depth": "maxDepth"}
    grids = []
    for shared in SHARED_GRIDS:
        b = ParamGridBuilder().addGrid(sel.alpha, shared["selection_alpha"])
        ks = shared["n_components"]
        if max_components is not None:
            ks = sorted({min(k, max_components) for k in ks})
        b = b.addGrid(pca.k, ks)
        for name, values in REGRESSOR_GRIDS[kind].items():
            b = b.addGrid(reg.getParam(spark_name[name]), values)
        grids.append(b.build())
    return grids
