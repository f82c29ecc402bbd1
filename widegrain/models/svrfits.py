"""Epsilon-insensitive regression on random Fourier features.

The objective is that of support vector regression, ``|w|² / 2 + C * sum of
max(0, |y - z·w - b| - epsilon)``, with the RBF kernel replaced by random
features (Rahimi & Recht 2007). Its kinks are rounded over a width that shrinks
from round to round, and each round is solved by Newton steps: one pass over
the rows gives loss, gradient and Hessian of all splits together, added up per
lane before they reach the driver, which solves systems of the size of the
feature map. A step that raises the loss is halved.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .foldfits import _SUMS, FoldMoments, Projection, added_up, columns_of, handed_on, held_errors

ROUNDING = (1.0, 0.2, 0.04, 0.01)  # widths of the rounded kinks, in standard deviations of the label
STEPS = 12  # Newton steps per width at most
CLOSE = 1e-5  # relative gain below which a width is done
PART = 16_000  # values of which the cosine is taken at a time, few enough to stay in the processor's cache
VALUES = 100_000  # values of a feature map worked on at a time
_TURN = (6.283184051513671875, 1.255665914601925286766559e-6)  # 2 pi in parts; whole multiples of the first one are exact
_SINE = np.polynomial.Chebyshev.interpolate(lambda t: np.sinc(np.sqrt(t) / math.pi), 7, [0.0, (math.pi / 2) ** 2]).convert(kind=np.polynomial.Polynomial).coef


def scaled_cosine(a: np.ndarray, scale: float) -> np.ndarray:
    """``scale * cos(a)`` in place, to about 1e-15 for the angles of a feature
    map, several times faster than NumPy's: ``1 - 2 sin²(a / 2)`` of the angle
    less its whole turns, the sine by a polynomial."""
    flat = a.reshape(-1)
    for at in range(0, flat.size, PART):
        x = flat[at:at + PART]
        turns = x * (0.5 / math.pi)
        np.rint(turns, out=turns)
        for part in _TURN:
            x -= turns * part
        x *= 0.5
        t = np.multiply(x, x, out=turns)
        sine = t * _SINE[-1]
        for c in _SINE[-2:0:-1]:
            sine += c
            sine *= t
        sine += _SINE[0]
        sine *= x
        np.multiply(sine, sine, out=x)
        x *= -2.0 * scale
        x += scale
    return a


def newton(rows: DataFrame, design: Callable[[pa.RecordBatch, Iterable[int]], Iterable[tuple[int, np.ndarray, np.ndarray]]], starts: Mapping[int, np.ndarray],
           spread: Mapping[int, float], c: float, epsilon: float) -> dict[int, np.ndarray]:
    """The weights and intercept of every split. ``design`` yields (split,
    features, labels) of a batch for the splits asked for, ``starts`` holds where each split begins
    (weights, then the intercept)."""
    if c <= 0 or epsilon < 0:
        raise ValueError("C must be positive and epsilon not negative")
    width = len(next(iter(starts.values())))
    upper = np.triu_indices(width)

    def measured(at: Mapping[int, np.ndarray], rounding: Mapping[int, float]):
        def run(batches):
            sums = {split: (np.zeros(1 + width), np.zeros((width, width))) for split in at}  # loss and slopes; second derivatives
            met = set()
            for b in batches:
                for split, z, y in design(b, at):
                    met.add(split)
                    (first, second), w = sums[split], at[split]
                    r, mu = y - z @ w[:-1] - w[-1], rounding[split]
                    over = np.maximum(np.abs(r) - epsilon, 0.0)
                    slope = np.sign(r) * np.minimum(over / mu, 1.0)
                    band = z[np.flatnonzero((over > 0) & (over < mu))]
                    first[0] += np.where(over < mu, over * over / (2 * mu), over - mu / 2).sum()
                    first[1:-1] += slope @ z
                    first[-1] += slope.sum()
                    second[:-1, :-1] += band.T @ band
                    second[:-1, -1] += band.sum(axis=0)
                    second[-1, -1] += len(band)
            yield from handed_on({(split, True): np.concatenate([sums[split][0], sums[split][1][upper] / rounding[split]]) for split in sorted(met)})

        got = added_up(rows.mapInArrow(run, _SUMS), ["split"])
        out = {}
        for split, w in at.items():
            v = got[(split,)]
            h = np.zeros((width, width))
            h[upper] = v[1 + width:]
            own = np.r_[w[:-1], 0.0]
            hessian = c * (h + np.triu(h, 1).T) + np.diag(np.r_[np.ones(width - 1), 1e-6])
            out[split] = (own @ own / 2 + c * v[0], own - c * v[1:1 + width], hessian)
        return out

    weights = {s: np.array(w, float) for s, w in starts.items()}
    for share in ROUNDING:
        rounding = {s: max(share * spread[s], 1e-12) for s in weights}
        state = measured(weights, rounding)
        step = {s: -np.linalg.solve(state[s][2], state[s][1]) for s in weights}
        live = set(weights)
        for _ in range(STEPS):
            tried = {s: weights[s] + step[s] for s in live}
            new = measured(tried, rounding)
            for s in sorted(live):
                before, after = state[s][0], new[s][0]
                if after <= before:
                    weights[s], state[s] = tried[s], new[s]
                    step[s] = -np.linalg.solve(new[s][2], new[s][1])
                    if before - after <= CLOSE * abs(before):
                        live.discard(s)
                else:
                    step[s] = step[s] / 2
                    if np.abs(step[s]).max() <= 1e-9 * max(1.0, np.abs(weights[s]).max()):
                        live.discard(s)
            if not live:
                break
    return weights


@dataclass
class FourierFit:
    """A fitted pipeline with the epsilon-insensitive regressor on top."""

    projection: Projection
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        angles = self.projection(x) @ self.frequencies
        angles += self.phases
        return scaled_cosine(angles, math.sqrt(2.0 / len(self.phases)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out, step = np.empty(len(x)), max(1, VALUES // len(self.phases))
        for at in range(0, len(x), step):
            out[at:at + step] = self.features(x[at:at + step]) @ self.weights[:-1] + self.weights[-1]
        return out


def fit_svr(moments: FoldMoments, splits: Sequence[int], alpha: float | None = 0.0055, n_components: int | None = 15, c: float = 10.0,
            epsilon: float = 0.1, n_features: int = 200, seed: int = 42) -> dict[int, FourierFit]:
    """The shared pipeline with the regressor on ``n_features`` random features
    of its components, for all splits together. The kernel's width is one over
    the number of components times their mean variance."""
    fits, starts, spread = {}, {}, {}
    for s in splits:
        p = moments.project(s, alpha, n_components)
        k = p.weights.shape[1]
        gamma = 1.0 / max(k * float(np.mean(p.variances)), 1e-12)
        rng = np.random.default_rng(seed)
        fits[s] = FourierFit(p, rng.normal(0.0, math.sqrt(2 * gamma), size=(k, n_features)), rng.uniform(0, 2 * math.pi, n_features), None)
        a = moments.train[s]
        starts[s] = np.r_[np.zeros(n_features), a[0, -1] / a[0, 0] + moments.shift[-1]]
        spread[s] = math.sqrt(max(a[-1, -1] / a[0, 0] - (a[0, -1] / a[0, 0]) ** 2, 0.0))
    features, label, fold_col = moments.features, moments.label, moments.fold_col

    def design(b, splits):
        x, y, own = columns_of(b, features), b.column(label).to_numpy(zero_copy_only=False), b.column(fold_col).to_numpy(zero_copy_only=False)
        step = max(1, VALUES // n_features)
        for s in splits:
            fit, rows = fits[s], np.flatnonzero(own != s)
            for k in range(0, len(rows), step):
                at = rows[k:k + step]
                yield s, fit.features(x[at]), y[at]

    for s, w in newton(moments.rows, design, starts, spread, c, epsilon).items():
        fits[s] = FourierFit(fits[s].projection, fits[s].frequencies, fits[s].phases, w)
    return fits


def cross_validate_svr(moments: FoldMoments, candidates: Mapping[str, Mapping], **shared) -> list[tuple]:
    """Rows (model, fold, r2, rmse, mae, n); a candidate holds settings of
    ``fit_svr`` (``c``, ``epsilon``, ``n_features``)."""
    fits = {name: fit_svr(moments, moments.folds, **{**shared, **settings}) for name, settings in candidates.items()}
    errors = held_errors(moments, fits)
    out = []
    for (name, fold), (sae, sse) in errors.items():
        a = moments.held[fold]
        n, spread = a[0, 0], a[-1, -1] - a[0, -1] ** 2 / a[0, 0]
        out.append((name, fold, float(1.0 - sse / spread), math.sqrt(sse / n), float(sae / n), int(n)))
    return out


class _InsensitiveParams(Params):
    c = Param(Params._dummy(), "c", "weight of the loss", TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "errors up to this are free", TypeConverters.toFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "input vector", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "fitted weights, then the intercept", TypeConverters.toListFloat)


class EpsilonInsensitiveModel(Model, _InsensitiveParams, DefaultParamsReadable, DefaultParamsWritable):
    """``features · weights + intercept``."""

    @keyword_only
    def __init__(self, featuresCol="rff", predictionCol="prediction", weights=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        *w, b = self.getOrDefault(self.weights)
        products = F.zip_with(vector_to_array(F.col(self.getOrDefault(self.featuresCol))), F.array(*[F.lit(x) for x in w]), lambda x, y: x * y)
        return dataset.withColumn(self.getOrDefault(self.predictionCol), F.aggregate(products, F.lit(float(b)), lambda a, x: a + x))


class EpsilonInsensitiveRegression(Estimator, _InsensitiveParams, DefaultParamsReadable, DefaultParamsWritable):
    """The regressor as a stage of a Spark ML pipeline, on a vector column."""

    @keyword_only
    def __init__(self, featuresCol="rff", labelCol="label", predictionCol="prediction", c=10.0, epsilon=0.1):
        super().__init__()
        self._setDefault(c=10.0, epsilon=0.1, featuresCol="rff", labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> EpsilonInsensitiveModel:
        from pyspark.ml.functions import vector_to_array

        from ..session import cut_lineage
        y = F.col(self.getOrDefault(self.labelCol)).cast("double")
        rows = cut_lineage(dataset.select(vector_to_array(F.col(self.getOrDefault(self.featuresCol))).alias("z"), y.alias("y")).where(y.isNotNull()))
        told = rows.agg(F.max(F.size("z")).alias("p"), F.avg("y").alias("mean"), F.stddev_pop("y").alias("sd")).first()
        if told["p"] is None:
            raise ValueError("no rows to fit")
        p = int(told["p"])

        def design(b, splits):
            yield 0, np.asarray(b.column("z").flatten().to_numpy(zero_copy_only=False), float).reshape(-1, p), b.column("y").to_numpy(zero_copy_only=False)

        w = newton(rows, design, {0: np.r_[np.zeros(p), told["mean"]]}, {0: told["sd"] or 0.0}, self.getOrDefault(self.c), self.getOrDefault(self.epsilon))[0]
        return EpsilonInsensitiveModel(featuresCol=self.getOrDefault(self.featuresCol), predictionCol=self.getOrDefault(self.predictionCol),
                                       weights=w.tolist())
