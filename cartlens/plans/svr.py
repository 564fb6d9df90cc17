"""M11, second served regressor: support-vector regression with an RBF kernel.

The kernel is expanded in random Fourier features (orthogonal frequencies, a cosine and a sine
each), drawn from a seed, so the model is linear in ``n_features`` numbers of a row that tasks
compute themselves.  The epsilon-insensitive loss is minimised by iteratively reweighted least
squares: a pass over the rows adds up the weighted normal equations per partition, partial sums are
added in a tree of small groups, and the driver solves one system of ``n_features + 1`` unknowns.
A second pass prices several step lengths at once, so the objective never rises.

What reaches the driver is bounded by ``n_features`` and ``FAN``, not by the rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.session import cut_lineage, target_partitions

# Tasks get these functions with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN = 32                                 # partial sums that one task, and at last the driver, adds up
STEPS = 0.5 ** np.arange(8)              # step lengths priced in one pass


def frequencies(dims: int, pairs: int, gamma: float, seed: int) -> np.ndarray:
    """``pairs`` frequencies of the kernel exp(-gamma |x - y|^2), orthogonal in blocks of ``dims``."""
    rng, blocks = np.random.default_rng(seed), []
    for _ in range(-(-pairs // dims)):
        q, r = np.linalg.qr(rng.standard_normal((dims, dims)))
        length = np.sqrt(rng.chisquare(dims, dims))
        blocks.append(q * np.sign(np.diag(r)) * length)
    return math.sqrt(2 * gamma) * np.concatenate(blocks, axis=1)[:, :pairs]


def expand(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Random Fourier features of the rows of ``x``, then a 1 for the intercept."""
    angle = x @ w
    return np.concatenate((np.cos(angle) / math.sqrt(w.shape[1]), np.sin(angle) / math.sqrt(w.shape[1]),
                           np.ones((len(x), 1))), axis=1)


def insensitive_loss(residual: np.ndarray, epsilon: float, delta: float) -> np.ndarray:
    """|r| - epsilon above 0, rounded off below ``delta`` so that it has a curvature."""
    over = np.maximum(np.abs(residual) - epsilon, 0)
    return np.where(over < delta, over * over / (2 * delta), over - delta / 2)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def _summed(rows: DataFrame, partial: Callable[[np.ndarray, np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """Sum over all rows (x array, y double) of ``partial(x, y)``, added up in a tree."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(_matrix(batch.column("x")), batch.column("y").to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_py()) for p in table.column("part"))
        return pa.table({"part": pa.array([np.asarray(total).tobytes()], pa.binary())})

    parts, left = rows.mapInArrow(per_task, "part binary"), n
    while left > FAN:
        left = -(-left // FAN)
        parts = (parts.withColumn("g", F.pmod(F.monotonically_increasing_id() / (1 << 33), F.lit(left)).cast("int"))
                 .groupBy("g").applyInArrow(add, "part binary"))
    found = [np.frombuffer(p.as_py()) for p in parts.toArrow().column("part")]
    return sum(found) if found else None


class _Shared(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    pass


class KernelSVR(_Shared, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Epsilon-SVR; ``gamma`` 0 stands for 1 / (columns * variance of all entries)."""

    C = Param(Params._dummy(), "C", "weight of the loss", TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "half width of the tube without loss", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "kernel width, 0 to scale", TypeConverters.toFloat)
    nFeatures = Param(Params._dummy(), "nFeatures", "random Fourier features", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "rounds at most", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "relative gain of a round that ends the fit", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the frequencies", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, C=10000.0, epsilon=0.1, gamma=0.0, nFeatures=256, maxIter=15, tol=1e-4, seed=0,
                 featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(C=10000.0, epsilon=0.1, gamma=0.0, nFeatures=256, maxIter=15, tol=1e-4, seed=0,
                         featuresCol="features", labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "KernelSVRModel":
        get = self.getOrDefault
        n = target_partitions(df.sparkSession)
        features, label = get("featuresCol"), get("labelCol")
        rows = cut_lineage(df.where(F.col(label).isNotNull()).select(
            vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")).repartition(n))
        moments = _summed(rows, lambda x, y: np.concatenate(([len(x), y.sum(), (y * y).sum(), (x * x).sum()], x.sum(0))), n)
        if moments is None:
            raise ValueError("no rows to fit")
        count, y_sum, y_square, x_square = moments[:4]
        center, dims = moments[4:] / count, len(moments) - 4
        spread = x_square / (count * dims) - (moments[4:].sum() / (count * dims)) ** 2
        gamma = get("gamma") or (1 / (dims * spread) if spread > 0 else 1.0)
        w = frequencies(dims, get("nFeatures") // 2, gamma, get("seed"))
        c, epsilon = get("C"), get("epsilon")
        y_mean = y_sum / count
        deviation = math.sqrt(max(y_square / count - y_mean ** 2, 0.0))
        size = 2 * w.shape[1] + 1
        theta = np.zeros(size)
        theta[-1] = y_mean
        ridge = np.ones(size)
        ridge[-1] = 0.0
        floor = max(epsilon / 10, 1e-3 * deviation, 1e-9)
        delta, last = max(deviation, floor), math.inf
        for _ in range(get("maxIter")):
            def normal(x, y, theta=theta, delta=delta):
                z = expand(x - center, w)
                r = y - z @ theta
                over = np.abs(r) - epsilon
                a = np.where(over > 0, 1 / np.maximum(over, delta), 0.0)
                za = z * a[:, None]
                return np.concatenate(((z.T @ za).ravel(), za.T @ (y - np.sign(r) * epsilon)))

            sums = _summed(rows, normal, n)
            left = c * sums[:size * size].reshape(size, size) + np.diag(ridge)
            left[-1, -1] += 1e-9                    # all rows inside the tube: the intercept stays free
            step = np.linalg.solve(left, c * sums[size * size:] + 1e-9 * np.append(np.zeros(size - 1), theta[-1])) - theta

            def price(x, y, theta=theta, step=step, delta=delta):
                z = expand(x - center, w)
                r, move = y - z @ theta, z @ step
                return np.array([insensitive_loss(r - t * move, epsilon, delta).sum() for t in (0.0, *STEPS)])

            tried = np.array([theta + t * step for t in (0.0, *STEPS)])
            value = c * _summed(rows, price, n) + (ridge * tried ** 2).sum(1) / 2
            best = int(np.argmin(value))
            theta = tried[best]
            settled = value[0] - value[best] <= get("tol") * max(value[0], 1e-300)
            if settled and delta <= floor:
                break
            delta = max(delta / 4, floor)
        model = KernelSVRModel(featuresCol=features, predictionCol=get("predictionCol"))
        return model._set(center=center.tolist(), weights=theta.tolist(), frequency=w.ravel().tolist(), gammaUsed=float(gamma))


class KernelSVRModel(_Shared, Model, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted regressor; saved with its parameters like any other stage of a pipeline."""

    center = Param(Params._dummy(), "center", "means of the columns", TypeConverters.toListFloat)
    weights = Param(Params._dummy(), "weights", "weights of the features, then the intercept", TypeConverters.toListFloat)
    frequency = Param(Params._dummy(), "frequency", "frequencies, a row a column", TypeConverters.toListFloat)
    gammaUsed = Param(Params._dummy(), "gammaUsed", "kernel width", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        """Adds the prediction; one Arrow batch is scored at a time, null features give null."""
        out = self.getOrDefault("predictionCol")
        center, theta = np.array(self.getOrDefault("center")), np.array(self.getOrDefault("weights"))
        w = np.array(self.getOrDefault("frequency")).reshape(len(center), -1)

        @F.pandas_udf("double")
        def score(x):
            import pandas as pd
            known = x.notna().to_numpy()
            value = np.full(len(x), np.nan)
            if known.any():
                value[known] = expand(np.stack(x[known].to_numpy()).astype(float) - center, w) @ theta
            return pd.Series(value).where(known, None)

        return df.withColumn(out, score(vector_to_array(self.getOrDefault("featuresCol"))))
