"""Model explanation as single distributed jobs: permutation importance (M21),
Shapley sampling (M22), PCA loadings (M9) and coefficient tables (M29).

Rows are replicated, never jobs: every (feature, repeat) or (row,
permutation, prefix, background) combination is a row of one DataFrame that
goes through ``model.transform`` once; metrics come from one ``groupBy``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import seeded_rank

MAX_REGIONS = 4096  # regions of a group of leaves whose Shapley values are tabulated


def permuted_copies(df: DataFrame, features: Sequence[str], key: str, n_repeats: int = 15,
                    seed: int | str = 42) -> DataFrame:
    """Rows x (feature, repeat) with that feature permuted.

    In each repeat the row at natural position i (rank of ``md5('<seed>:key')``)
    meets the row at position i of the order ``md5('<repeat>:<seed>:key')``, an
    exact random permutation computed with the skew-safe seeded rank. A row is
    shuffled once by its position, where it meets its donors of all repeats;
    only donors are shuffled rows x repeats: each brings all its features at
    once, and the copies with one feature taken from it are made after the join.
    """
    features = list(features)
    n = df.count()
    repeats = F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))).alias("perm_repeat")
    rep = seeded_rank(df, [key], seed, rank_col="__pos", n_rows=n)
    donors = df.select(key, *[F.col(f).cast("double").alias(f"__d{i}") for i, f in enumerate(features)], repeats)
    order = F.md5(F.concat_ws(":", F.col("perm_repeat").cast("string"), F.lit(str(seed)), F.col(key).cast("string")))
    donors = seeded_rank(donors, [key], seed, partition_cols=["perm_repeat"], rank_col="__pos", check_unique=False,
                         order_expr=order, n_rows=n, n_groups=n_repeats).drop(key)
    j = rep.join(donors, "__pos", "inner").select(
        "*", F.explode(F.array(*[F.lit(i) for i in range(len(features))])).alias("__fi"))
    idx = {f: i for i, f in enumerate(features)}
    names = F.array(*[F.lit(f) for f in features])
    return j.select(*[F.when(F.col("__fi") == idx[f], F.col(f"__d{idx[f]}")).otherwise(F.col(f).cast("double")).alias(f)
                      if f in idx else F.col(f) for f in df.columns],
                    F.element_at(names, F.col("__fi") + 1).alias("perm_feature"), "perm_repeat")


def permutation_importance(model, df: DataFrame, features: Sequence[str], label: str, key: str,
                           n_repeats: int = 15, seed: int | str = 42, pred: str = "prediction"):
    """Permutation importance through a fitted model (M21): R² drop per
    (feature, repeat), then mean and population sd over repeats.
    Returns (summary, per_repeat)."""
    from ..models.pipeline import regression_metrics
    base = regression_metrics(model.transform(df), label, pred).select(F.col("r2").alias("__base"))
    perm = permuted_copies(df, features, key, n_repeats, seed)
    scored = regression_metrics(model.transform(perm), label, pred, ["perm_feature", "perm_repeat"])
    b = base.first()["__base"]
    per = scored.select(F.col("perm_feature").alias("feature"), F.col("perm_repeat").alias("repeat"),
                        (F.lit(b) - F.col("r2")).alias("r2_drop"))
    summ = per.groupBy("feature").agg(F.avg("r2_drop").alias("importance_mean"),
                                      F.stddev_pop("r2_drop").alias("importance_std"))
    return summ, per


def shapley_values(model, df: DataFrame, features: Sequence[str], key: str, background: DataFrame,
                   n_permutations: int = 1, seed: int | str = 42, pred: str = "prediction") -> DataFrame:
    """Shapley sampling values (Štrumbelj & Kononenko 2014) of every row.

    For each row x, permutation π (seeded per row) and background row z, the
    prefixes S_0 ⊂ ... ⊂ S_p of π define hybrids (x on S_k, z elsewhere); one
    ``transform`` scores all hybrids and φ_π(k) averages f(h_k) - f(h_{k-1}).
    The background is the caller's bounded sample (the reference uses 100
    rows), all of it read once as literals — no join with the data. A linear
    regression on the features themselves needs the background's mean only.
    Returns (key, feature, phi); Σφ = f(x) - mean f(background) per row.
    """
    features = list(features)
    p = len(features)
    bg = [tuple(None if v is None else float(v) for v in r) for r in background.select(*features).collect()]
    if not bg:
        raise ValueError("empty background")
    if _affine(model, features) and all(v is not None and math.isfinite(v) for r in bg for v in r):
        bg = [tuple(math.fsum(v) / len(bg) for v in zip(*bg, strict=True))]
    spark = df.sparkSession
    schema = ", ".join(f"`{f}` double" for f in features)
    start = model.transform(spark.createDataFrame(bg, schema)).agg(F.avg(pred)).first()[0]  # of the empty prefix, the same for every row
    bg_arr = F.array(*[F.struct(*[F.lit(v).cast("double").alias(f"__z{j}") for j, v in enumerate(r)]) for r in bg])
    d = df.select(key, *[F.col(f).cast("double").alias(f) for f in features])
    d = d.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_permutations - 1))).alias("__perm"))
    # permutation of feature indices for (row, perm): sort by a digest
    order = F.transform(F.array_sort(F.array(*[F.struct(
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col("__perm").cast("string"),
                          F.lit(f))).alias("h"), F.lit(j).alias("j")) for j, f in enumerate(features)])), lambda s: s["j"])
    d = d.withColumn("__order", order)
    d = d.select("*", F.explode(F.sequence(F.lit(1), F.lit(p))).alias("__k"))
    # the whole row holds nothing of the background: once
    d = d.select("*", F.explode(F.when(F.col("__k") < p, bg_arr).otherwise(F.slice(bg_arr, 1, 1))).alias("__bg")).select("*", "__bg.*").drop("__bg")
    inS = {j: F.array_contains(F.slice(F.col("__order"), 1, F.col("__k")), F.lit(j)) for j in range(p)}
    hyb = d.select(key, "__perm", "__k", *[F.when(inS[j], F.col(f)).otherwise(F.col(f"__z{j}")).alias(f) for j, f in enumerate(features)])
    scored = model.transform(hyb).select(key, "__perm", "__k", F.col(pred).alias("__f"))
    # the background is averaged where the copies are made: what is shuffled is one row per (row, permutation)
    means = scored.groupBy(key, "__perm").agg(*[F.avg(F.when(F.col("__k") == k, F.col("__f"))).alias(f"__m{k}") for k in range(1, p + 1)])
    means = means.withColumn("__m0", F.lit(start).cast("double")).withColumn("__order", order)
    names = F.array(*[F.lit(f) for f in features])
    steps = F.explode(F.array(*[F.struct(F.element_at(names, F.col("__order")[k] + 1).alias("feature"),
                                         (F.col(f"__m{k + 1}") - F.col(f"__m{k}")).alias("phi")) for k in range(p)])).alias("__s")
    diffs = means.select(key, steps).select(key, "__s.*")
    if n_permutations == 1:  # one value of each (key, feature)
        return diffs
    return diffs.groupBy(key, "feature").agg(F.avg("phi").alias("phi"))


def _affine(model, features: Sequence[str]) -> bool:
    """Whether the model is a linear regression straight on the features: then
    its mean over a background is its value at the background's mean."""
    stages = getattr(model, "stages", None) or []
    return (len(stages) == 2 and isinstance(stages[0], VectorAssembler) and isinstance(stages[1], LinearRegressionModel)
            and set(stages[0].getInputCols()) <= set(features) and stages[1].getFeaturesCol() == stages[0].getOutputCol())


def tree_shapley(model, df: DataFrame, key: str, background: DataFrame) -> DataFrame:
    """Exact interventional Shapley values of a ``treefits.TreeModel`` whose
    trees stand on the features themselves (no PCA) (M22): (key, feature, phi).

    A leaf is reached by a mix of a row x and a background row z if every
    feature on its path is satisfied by the one it is taken from; with ``a``
    features that only x satisfies and ``b`` that only z does, the leaf's value
    counts for each of the former ``(a-1)! b! / (a+b)!`` and against each of
    the latter ``a! (b-1)! / (a+b)!``. Background rows of one pattern of
    satisfied features are counted together, so the work per row does not grow
    with the background. The cuts of neighbouring leaves part the bins into at
    most ``MAX_REGIONS`` regions of equal values; the values of every region
    are worked out once, here, and a row looks up its region in each group of
    leaves. Only a leaf with more regions than that is worked out for every
    batch of rows. The background is the caller's bounded sample.
    """
    names, weights = model.features, model.projection.weights
    if any(np.count_nonzero(weights[:, i]) != 1 for i in range(weights.shape[1])):
        raise ValueError("the trees stand on mixed components; use shapley_values")
    of = [int(np.flatnonzero(weights[:, i])[0]) for i in range(weights.shape[1])]  # component -> feature
    back = np.array([[np.nan if v is None else float(v) for v in r] for r in background.select(*names).collect()])
    if not len(back):
        raise ValueError("empty background")
    back_bins = model.bins(back)
    p = len(names) + 1
    weight = np.array([[math.factorial(a - 1) * math.factorial(b) / math.factorial(a + b) if a else 0.0 for b in range(p)] for a in range(p)])
    share = 1.0 / (len(model.trees) if model.averaged else 1)

    def inside(bins, lo, hi, component):
        return (bins[:, component] > lo) & (bins[:, component] <= hi)

    def attributed(leaves, bins: np.ndarray) -> np.ndarray:
        """Shares of the leaves' values per row of bins and feature."""
        out = np.zeros((len(bins), len(names)))
        for value, path in leaves:  # path: component -> bins (lo, hi]
            d = len(path)
            if not d:
                continue
            codes = [sum(inside(b, lo, hi, c).astype(np.int64) << i for i, (c, (lo, hi)) in enumerate(path.items())) for b in (bins, back_bins)]
            seen, counts = np.unique(codes[1], return_counts=True)
            mine, at = np.unique(codes[0], return_inverse=True)
            m, z, bit = mine[:, None, None], seen[None, :, None], 1 << np.arange(d)
            only_x, only_z = (m & ~z & bit) > 0, (z & ~m & bit) > 0
            a, b = only_x.sum(axis=2), only_z.sum(axis=2)
            met = np.where((m | z)[:, :, 0] == (1 << d) - 1, counts, 0)[:, :, None]
            table = (met * (only_x * weight[a, b][:, :, None] - only_z * weight[b, a][:, :, None])).sum(axis=1)
            table *= value * share / len(back)
            for i, c in enumerate(path):
                out[:, of[c]] += table[at, i]
        return out

    def ends_of(path) -> dict[int, set]:
        return {c: {e for e in ends if 0 <= e < 10 ** 6} for c, ends in path.items()}

    groups, others = [], []  # neighbouring leaves and their cuts; leaves with too many regions of their own
    for leaves in model.leaves_by_tree():
        for leaf in filter(lambda leaf: leaf[1], leaves):
            own = ends_of(leaf[1])
            joint = {c: own.get(c, set()) | (groups[-1][1].get(c, set()) if groups else set()) for c in range(len(of))}
            if groups and math.prod(len(e) + 1 for e in joint.values()) <= MAX_REGIONS:
                groups[-1][0].append(leaf)
                groups[-1] = groups[-1][0], joint
            elif math.prod(len(e) + 1 for e in own.values()) <= MAX_REGIONS:
                groups.append(([leaf], own))
            else:
                others.append(leaf)
    looked_up = []  # of each group: the cuts and strides of its components and the values of every region
    for leaves, ends in groups:
        cuts, strides, regions = {c: np.array(sorted(e)) for c, e in ends.items() if e}, {}, 1
        for c, e in cuts.items():
            strides[c], regions = regions, regions * (len(e) + 1)
        bins = np.zeros((regions, len(of)), np.int64)
        for c, e in cuts.items():  # a row of bins in each region
            bins[:, c] = np.r_[e, e[-1] + 1][np.arange(regions) // strides[c] % (len(e) + 1)]
        looked_up.append((cuts, strides, attributed(leaves, bins)))

    def values(x: np.ndarray) -> np.ndarray:
        bins = model.bins(x)
        out = attributed(others, bins)
        every = {c: np.arange(bins[:, c].max(initial=0) + 1) for c in range(bins.shape[1])}
        for cuts, strides, table in looked_up:
            region = sum((np.searchsorted(e, every[c], side="left") * strides[c])[bins[:, c]] for c, e in cuts.items())
            out += table[region]
        return out

    def run(batches):
        import pyarrow as pa
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names])
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(list(values(x)), pa.list_(pa.float64()))], names=[key, "phi"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in names]).mapInArrow(run, f"`{key}` {kind}, phi array<double>")
    return rows.select(key, F.explode(F.arrays_zip(F.array(*map(F.lit, names)).alias("feature"), "phi")).alias("__s")).select(key, "__s.feature", "__s.phi")


def mean_abs_attribution(phi: DataFrame) -> DataFrame:
    """Mean |φ| per feature (the global Shapley ranking)."""
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))


def pca_loadings(pca_model, names: Sequence[str]) -> DataFrame:
    """Loadings as long rows (feature, component, loading) (M9); each
    component's sign is fixed so that its largest |entry| is positive."""
    pc = pca_model.pc.toArray()  # p x k (Spark PCAModel or CentredPCAModel)
    rows = []
    for c in range(pc.shape[1]):
        v = pc[:, c]
        s = 1.0 if v[int(np.argmax(np.abs(v)))] >= 0 else -1.0
        rows += [(names[i], c + 1, float(s * v[i])) for i in range(len(names))]
    spark = _active()
    return spark.createDataFrame(rows, "feature string, component int, loading double")


def coefficient_table(coefs, names: Sequence[str], threshold: float = 1e-5) -> DataFrame:
    """Coefficients sorted by value with a kept flag."""
    arr = np.asarray(coefs.toArray() if hasattr(coefs, "toArray") else coefs, dtype=float)
    rows = [(names[i], float(arr[i]), bool(abs(arr[i]) >= threshold)) for i in np.argsort(-arr, kind="stable")]
    return _active().createDataFrame(rows, "feature string, coef double, kept boolean")


def _active():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


__all__ = ["permuted_copies", "permutation_importance", "shapley_values", "tree_shapley", "mean_abs_attribution",
           "pca_loadings", "coefficient_table"]
