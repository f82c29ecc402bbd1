"""Correlation family: pairwise-complete correlations, masked Gram matrices,
VIF, PCA reconstruction error and Spearman rank correlation.

The Gram matrix of many columns is accumulated per partition with NumPy
(``mapInArrow``: X with nulls as 0 and its null mask M give MᵀM, XᵀM, (X²)ᵀM
and XᵀX in four matrix products). A task hands on one array of all four, which
are added up in ``LANES`` groups and then once more, so what is shuffled is one
row per task — the only thing that ever reaches the driver is a p x p matrix.
Undefined values (zero variance) are NULL, never an ANSI error.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import _join_side, broadcast_if_small, value_ranks

LANES = 64  # groups in which the tasks' matrices are added up
_PART_SCHEMA = "lane int, sums array<double>"
_GRAM_SCHEMA = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def _means(df: DataFrame, cols: Sequence[str]) -> list[float]:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return [row[f"m{i}"] or 0.0 for i in range(len(cols))]


def _gram_partition(p: int):
    def fn(batches):
        N = np.zeros((p, p)); SX = np.zeros((p, p)); SXX = np.zeros((p, p)); SXY = np.zeros((p, p))
        seen = False
        for b in batches:
            if b.num_rows == 0:
                continue
            seen = True
            X = np.column_stack([b.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(p)])
            M = (~np.isnan(X)).astype(float)
            X = np.nan_to_num(X, nan=0.0)
            N += M.T @ M
            SX += X.T @ M          # SX[i, j] = sum of x_i over rows where i and j present
            SXX += (X * X).T @ M
            SXY += X.T @ X
        if seen:
            sums = np.concatenate([N.ravel(), SX.ravel(), SXX.ravel(), SXY.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % LANES], pa.int32()),
                                              pa.array([sums.tolist()], pa.list_(pa.float64()))], names=["lane", "sums"])
    return fn


def _lane_sum(frame: pd.DataFrame) -> pd.DataFrame:
    out = frame.iloc[:1][["lane"]].copy()
    out["sums"] = [np.sum(np.stack(frame["sums"].to_list()), axis=0)]
    return out


def _unfolded(p: int):
    def fn(frame: pd.DataFrame) -> pd.DataFrame:
        n, sx, sxx, sxy = np.sum(np.stack(frame["sums"].to_list()), axis=0).reshape(4, p, p)
        ii, jj = np.nonzero(np.ones((p, p)))
        return pd.DataFrame({"i": ii, "j": jj, "n": n[ii, jj], "sx": sx[ii, jj], "sy": sx[jj, ii], "sxx": sxx[ii, jj],
                             "syy": sxx[jj, ii], "sxy": sxy[ii, jj]})
    return fn


def gram(df: DataFrame, cols: Sequence[str], center: bool = True) -> DataFrame:
    """Pairwise-complete co-moment sums for every ordered pair (i, j):
    (i, j, n, sx, sy, sxx, syy, sxy) over rows where both are non-null, on
    data shifted by the column means (shift-invariant, better conditioned)."""
    cols = list(cols)
    mu = _means(df, cols) if center else [0.0] * len(cols)
    x = df.select(*[(F.col(c).cast("double") - F.lit(m)).alias(f"x{k}") for k, (c, m) in enumerate(zip(cols, mu))])
    # nulls -> NaN so the Arrow batch is a plain float matrix
    x = x.select(*[F.coalesce(F.col(f"x{k}"), F.lit(float("nan"))).alias(f"x{k}") for k in range(len(cols))])
    lanes = x.mapInArrow(_gram_partition(len(cols)), _PART_SCHEMA).groupBy("lane").applyInPandas(_lane_sum, _PART_SCHEMA)
    return lanes.groupBy(F.lit(0).alias("all")).applyInPandas(_unfolded(len(cols)), _GRAM_SCHEMA)   # at most LANES rows


def _r_from_sums(n, sx, sy, sxx, syy, sxy):
    cxy = sxy - sx * sy / n
    vx = sxx - sx * sx / n
    vy = syy - sy * sy / n
    den = F.sqrt(vx * vy)
    return F.when((n > 1) & (vx > 0) & (vy > 0), F.try_divide(cxy, den))


def corr_matrix(df: DataFrame, cols: Sequence[str], lower_only: bool = True,
                keep_diagonal: bool = False) -> DataFrame:
    """Pearson correlation matrix, pairwise complete (A15), as long rows
    (col_a, col_b, a_idx, b_idx, n, r); lower triangle ``a_idx > b_idx``."""
    cols = list(cols)
    g = gram(df, cols)
    names = F.array(*[F.lit(c) for c in cols])
    r = _r_from_sums(F.col("n"), F.col("sx"), F.col("sy"), F.col("sxx"), F.col("syy"), F.col("sxy"))
    out = g.select(F.element_at(names, F.col("i") + 1).alias("col_a"), F.element_at(names, F.col("j") + 1).alias("col_b"),
                   F.col("i").alias("a_idx"), F.col("j").alias("b_idx"), F.col("n").cast("long").alias("n"),
                   r.alias("r"))
    if lower_only:
        out = out.where(F.col("a_idx") >= F.col("b_idx") if keep_diagonal else F.col("a_idx") > F.col("b_idx"))
    return out


def corr_with_target(df: DataFrame, target: str, cols: Sequence[str], drop_undefined: bool = True) -> DataFrame:
    """Pearson r of each column with the target, pairwise complete (A14):
    (column_name, position, n, r).

    One JVM aggregate pass: per column ``covar_samp`` and ``var_samp`` over the
    rows where both values are present (Spark's merge-stable co-moment
    aggregates), so no separate pass for means. Zero-variance columns give NULL
    (guarded ``try_divide``, never an ANSI error) and are dropped."""
    cols = [c for c in cols if c != target]
    y = F.col(target).cast("double")
    aggs = []
    for k, c in enumerate(cols):
        x = F.col(c).cast("double")
        both = x.isNotNull() & y.isNotNull()
        xx, yy = F.when(both, x), F.when(both, y)
        aggs += [F.count_if(both).alias(f"n{k}"), F.covar_samp(xx, yy).alias(f"c{k}"),
                 F.var_samp(xx).alias(f"vx{k}"), F.var_samp(yy).alias(f"vy{k}")]
    row = df.agg(*aggs)

    def r(k):
        vx, vy = F.col(f"vx{k}"), F.col(f"vy{k}")
        return F.when((F.col(f"n{k}") > 1) & (vx > 0) & (vy > 0), F.try_divide(F.col(f"c{k}"), F.sqrt(vx * vy)))
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("position"), F.col(f"n{k}").cast("long").alias("n"),
                 r(k).alias("r"))
        for k, c in enumerate(cols)]))
    out = row.select(rows.alias("s")).select("s.*")
    return out.where(F.col("r").isNotNull()) if drop_undefined else out


def leakage_screen(corr: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Columns whose |r| with the target exceeds ``threshold``."""
    return corr.where(F.abs(F.col("r")) > threshold)


def top_correlations(corr: DataFrame, k: int) -> DataFrame:
    """Top ``k`` columns by |r| (W2); display order ascending by r is the
    caller's ``orderBy('r')``."""
    return corr.orderBy(F.abs(F.col("r")).desc(), F.col("position")).limit(k)


def heatmap_columns(ordered: Sequence[str], k: int = 10, target: str | None = None,
                    by: str = "position", strengths: dict | None = None) -> list[str]:
    """Columns for the correlation heat map (W10): the first ``k`` and last
    ``k`` of the list by position (the reference, quirk Q5) or, with
    ``by='strength'``, the ``2k`` strongest by |r|; the target appended."""
    if by == "strength" and strengths:
        pick = sorted(ordered, key=lambda c: -abs(strengths.get(c, 0.0)))[: 2 * k]
    else:
        pick = list(ordered[:k]) + [c for c in ordered[-k:] if c not in ordered[:k]]
    return pick + ([target] if target else [])


def _complete_corr(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, int]:
    """List-wise complete correlation matrix (p x p) on the driver."""
    cols = list(cols)
    d = df.na.drop("any", subset=cols)
    g = gram(d, cols).collect()
    p = len(cols)
    R = np.eye(p)
    n = 0
    for row in g:
        i, j = row["i"], row["j"]
        nn = row["n"]
        n = max(n, int(nn))
        cxy = row["sxy"] - row["sx"] * row["sy"] / nn
        vx = row["sxx"] - row["sx"] ** 2 / nn
        vy = row["syy"] - row["sy"] ** 2 / nn
        R[i, j] = cxy / np.sqrt(vx * vy) if vx > 0 and vy > 0 else np.nan
    return R, n


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation factor per column on list-wise complete rows (M1):
    the diagonal of the inverse correlation matrix (equal to 1/(1-R²) of each
    column on the others, with intercept). Singular -> +inf."""
    cols = list(cols)
    R, _ = _complete_corr(df, cols)
    p = len(cols)
    d = np.full(p, np.nan)
    for k in range(p):
        idx = [j for j in range(p) if j != k]
        if np.isnan(R[k]).any():
            continue
        Rm, r = R[np.ix_(idx, idx)], R[idx, k]
        r2 = float(r @ np.linalg.pinv(Rm) @ r) if idx else 0.0
        d[k] = np.inf if 1.0 - r2 <= 1e-12 else 1.0 / (1.0 - r2)
    spark = df.sparkSession
    return spark.createDataFrame([(c, k, float(d[k])) for k, c in enumerate(cols)],
                                 "column_name string, position int, vif double")


def pca_reconstruction(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Reconstruction error of standardised data vs number of components
    (M7), closed form from one eigendecomposition of the correlation matrix
    (population scaling): MSE(k) = sum of the eigenvalues beyond k / p, with
    explained-variance ratio and its running total (W5)."""
    cols = list(cols)
    R, _ = _complete_corr(df, cols)
    lam = np.sort(np.linalg.eigvalsh(R))[::-1]
    lam = np.clip(lam, 0.0, None)
    p = len(cols)
    rows = []
    for k in range(p + 1):
        rows.append((k, float(lam[k:].sum() / p),
                     float(lam[k - 1] / lam.sum()) if k > 0 else None,
                     float(lam[:k].sum() / lam.sum())))
    return df.sparkSession.createDataFrame(rows, "k int, mse double, explained_ratio double, cumulative double")


def average_ranks(df: DataFrame, col: str, rank_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Average (tie-aware) rank of every row's value, skew-safe: ranks of the
    distinct values come from ``value_ranks`` and are joined back on the value."""
    vr = value_ranks(df, col).select(col, (F.col("below") + (F.col("cnt") + 1) / 2.0).alias(rank_col))
    # one row per distinct value: broadcast when the checked count allows, so a
    # value repeated in a third of the rows never lands in one join task
    return _join_side(df.where(F.col(col).isNotNull()), broadcast_if_small(vr), [col], null_safe=False)


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Spearman rho of two columns on complete pairs (M23): Pearson r of the
    average ranks. Returns one row (n, rho)."""
    d = df.select(a, b).na.drop("any")
    ra = average_ranks(d, a, "__ra")
    rb = average_ranks(ra, b, "__rb")
    x, y = F.col("__ra"), F.col("__rb")
    n = F.count(F.lit(1)).cast("double")
    return rb.agg(n.alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"),
                  F.sum(y * y).alias("syy"), F.sum(x * y).alias("sxy")).select(
        F.col("n").cast("long").alias("n"),
        _r_from_sums(F.col("n"), F.col("sx"), F.col("sy"), F.col("sxx"), F.col("syy"), F.col("sxy")).alias("rho"))


def pair_consistency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson r between two estimates of one quantity on the rows that have
    both (A30): (n, r)."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return df.where(both).agg(F.count(F.lit(1)).alias("n"), F.corr(a, b).alias("r"))
