from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from cartlens.plans.svr import KernelSVR, _summed, expand, frequencies


def exact_svr(x, y, gamma, c, epsilon, rounds=200):
    """Exact kernel solution by reweighting with a shrinking rounding; returns f(x) and the duality gap."""
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    n, beta, b, delta = len(y), np.zeros(len(y)), y.mean(), y.std()
    for _ in range(rounds):
        r = y - k @ beta - b
        over = np.abs(r) - epsilon
        act = np.flatnonzero(over > 0)
        a = 1 / np.maximum(over[act], delta)
        left = np.zeros((len(act) + 1,) * 2)
        left[:-1, :-1] = k[np.ix_(act, act)] + np.diag(1 / (c * a))
        left[-1, :-1] = left[:-1, -1] = 1
        sol = np.linalg.solve(left, np.append(y[act] - np.sign(r[act]) * epsilon, 0))
        new = np.zeros(n)
        new[act] = sol[:-1]

        def value(t):
            bt, it = beta + t * (new - beta), b + t * (sol[-1] - b)
            u = np.maximum(np.abs(y - k @ bt - it) - epsilon, 0)
            return bt @ k @ bt / 2 + c * np.where(u < delta, u * u / (2 * delta), u - delta / 2).sum()

        t = min((0.0, *0.5 ** np.arange(12)), key=value)
        beta, b = beta + t * (new - beta), b + t * (sol[-1] - b)
        delta = max(delta * .8, 1e-5)
    dual = np.clip(beta, -c, c)
    primal = beta @ k @ beta / 2 + c * np.maximum(np.abs(y - k @ beta - b) - epsilon, 0).sum()
    gap = primal - (-dual @ k @ dual / 2 + y @ dual - epsilon * np.abs(dual).sum())
    return k @ beta + b, gap / primal, (beta, b)


def _frame(spark, x, y):
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, ", ".join([*(f"x{i} double" for i in range(x.shape[1])), "target double"]))
    return VectorAssembler(inputCols=[f"x{i}" for i in range(x.shape[1])], outputCol="features").transform(df)


def test_kernel_is_approximated():
    x = np.random.default_rng(1).normal(size=(60, 5))
    z = expand(x, frequencies(5, 4000, .3, 2))[:, :-1]
    exact = np.exp(-.3 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < .05


@pytest.mark.parametrize("c", [5.0, 100.0])
def test_fit_is_near_the_exact_kernel_solution(spark, c):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    y = 3 * np.sin(x[:, 0]) + x[:, 1] ** 2 + rng.normal(scale=.2, size=300)
    want, gap, _ = exact_svr(x, y, .5, c, .1)
    assert gap < 1e-3                                     # the yardstick itself is optimal
    data = _frame(spark, x, y)
    model = KernelSVR(C=c, epsilon=.1, gamma=.5, nFeatures=1200, maxIter=20, tol=1e-6, labelCol="target").fit(data)
    got = np.array([r.prediction for r in model.transform(data).select("prediction").collect()])
    assert np.sqrt(((got - want) ** 2).mean()) < .04 * y.std()


def test_gamma_by_scale_repeatable_and_saved(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3)) * [1, 5, 20] + [2000, 0, 0]
    y = x[:, 1] * 2 + rng.normal(size=200)
    data = _frame(spark, x, y).drop("features")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features"),
                            KernelSVR(labelCol="target", nFeatures=64)])
    one, two = pipe.fit(data), pipe.fit(data.repartition(7))
    assert one.stages[-1].getOrDefault("gammaUsed") == pytest.approx(1 / (3 * x.var()))
    one.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))

    def scores(model):
        return {r.x1: r.prediction for r in model.transform(data).collect()}

    assert scores(again) == scores(one)
    other = scores(two)
    assert all(other[k] == pytest.approx(v, rel=1e-3, abs=.05) for k, v in scores(one).items())


def test_partial_sums_in_a_tree(spark):
    rows = spark.range(5000).selectExpr("array(CAST(id AS double), 1D) AS x", "CAST(id AS double) AS y").repartition(70)
    got = _summed(rows, lambda x, y: np.array([len(x), x[:, 0].sum(), y.sum()]), 70)
    assert got.tolist() == [5000, 5000 * 4999 / 2, 5000 * 4999 / 2]


def test_rows_without_a_target_are_left_out_and_empty_input_raises(spark):
    data = _frame(spark, np.arange(8.0).reshape(4, 2), np.arange(4.0))
    with pytest.raises(ValueError, match="no rows"):
        KernelSVR(labelCol="target").fit(data.limit(0))
    flat = KernelSVR(labelCol="target", nFeatures=8).fit(data.selectExpr("features", "CAST(1 AS double) AS target"))
    assert [round(r.prediction, 1) for r in flat.transform(data).collect()] == [1.0] * 4
