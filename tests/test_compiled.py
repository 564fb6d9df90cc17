from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, RandomForestRegressor

from cartlens.plans import models as ML
from cartlens.plans.compiled import compile_model

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for k in range(400):
        a, b, c = rng.gauss(0, 1), rng.uniform(1990, 2000), float(rng.randrange(4))
        out.append((k, a, b, c, int(a + (c > 1) * (b - 1995) / 3 + rng.gauss(0, .5) > 0), 3 * a + c * c))
    return out


@pytest.fixture(scope="module")
def data(spark, rows):
    return spark.createDataFrame(rows, "id int, a double, b double, c double, label int, spend_third double")


def _check(spark, rows, data, model, classifier=True):
    """Spark's own predictions, the expression in Spark and the text in another engine agree."""
    text = compile_model(model)
    own = model.transform(data)
    if classifier and "rawPrediction" in own.columns:
        own = ML.with_score(own, margin=type(model.stages[-1]).__name__ in ("NaiveBayesModel", "LinearSVCModel"))
    want = {r.id: (r["score"] if "score" in own.columns else r.prediction, r.prediction) for r in own.collect()}
    got = {r.id: (r.score, r.prediction) for r in text.columns(data).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id INT, a DOUBLE, b DOUBLE, c DOUBLE, label INT, spend_third DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?)", rows)
    other = {r[0]: r[1:] for r in con.execute(f"SELECT id, {text.score}, {text.prediction} FROM t").fetchall()}
    for k, (score, prediction) in want.items():
        for have in (got[k], other[k]):
            assert have[0] == pytest.approx(score, rel=1e-9, abs=1e-9)
            if classifier:
                assert have[1] == prediction


@pytest.mark.parametrize("scaler", ["none", "standard", "minmax"])
@pytest.mark.parametrize("kind", ["gnb", "logreg", "svc"])
def test_linear_models_and_naive_bayes(spark, rows, data, kind, scaler):
    model = ML.build(kind, scaler, features=COLUMNS).fit(data)
    if kind == "svc":
        text, own = compile_model(model), model.transform(data)
        want = {r.id: (r.rawPrediction[1], r.prediction) for r in own.collect()}
        got = {r.id: (r.score, r.prediction) for r in text.columns(data).collect()}
        assert all(got[k][1] == want[k][1] and got[k][0] == pytest.approx(want[k][0]) for k in want)
    else:
        _check(spark, rows, data, model)


@pytest.mark.parametrize("make", [lambda: DecisionTreeClassifier(maxDepth=4), lambda: RandomForestClassifier(numTrees=7, maxDepth=4, seed=1),
                                  lambda: GBTClassifier(maxIter=5, maxDepth=3, seed=1)])
def test_trees(spark, rows, data, make):
    model = Pipeline(stages=[VectorAssembler(inputCols=COLUMNS, outputCol="features"), make()]).fit(data)
    _check(spark, rows, data, model)


@pytest.mark.parametrize("make", [lambda: RandomForestRegressor(labelCol="spend_third", numTrees=5, maxDepth=4, seed=1),
                                  lambda: GeneralizedLinearRegression(labelCol="spend_third")])
def test_regressions(spark, rows, data, make):
    model = Pipeline(stages=[VectorAssembler(inputCols=COLUMNS, outputCol="features"), make()]).fit(data)
    _check(spark, rows, data, model, classifier=False)
    _check(spark, rows, data, ML.build_regression("linear", features=COLUMNS).fit(data), classifier=False)


def test_what_cannot_be_compiled_raises(data):
    forest = ML.build("forest", features=COLUMNS, trees=20, depth=8).fit(data)
    with pytest.raises(ValueError, match="max_nodes"):
        compile_model(forest, max_nodes=50)
    with pytest.raises(ValueError, match="no expression"):
        compile_model(ML.build("mlp", features=COLUMNS).fit(data))
