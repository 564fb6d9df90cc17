"""Scoring of fitted classifiers, whatever the session was used for before."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cartlens.plans import models as ML


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows = []
    for k in range(120):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((a, b, int(a + rng.gauss(0, 0.5) > 0), "train" if k % 3 else "val"))
    return spark.createDataFrame(rows, "a double, b double, label int, split string").repartition(2)


@pytest.mark.parametrize("kind", ["logreg", "forest", "svc", "mlp"])
def test_classifiers_score_in_a_session_with_an_observation(spark, data, kind):
    seen = Observation()
    spark.range(5).observe(seen, F.max("id").alias("top")).collect()
    assert seen.get == {"top": 4}
    params = {"trees": 3, "depth": 3} if kind == "forest" else {}
    model = ML.build(kind, features=["a", "b"], **params).fit(data.where("split = 'train'"))
    got = {r.split: r.rows for r in ML.evaluate(model, data, kind).collect()}
    assert got == {"train": 80, "val": 40}
    assert sum(r["rows"] for r in ML.confusion_by_split(model, data, kind).collect()) == 120
    assert model.stages[-1].hasSummary                  # the caller's model is unchanged


def test_training_rows_are_spread_over_the_cores_and_kept(spark, data):
    one = data.coalesce(1)
    staged = ML.staged_rows(one)
    assert staged.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert all(n > 0 for n in staged.rdd.glom().map(len).collect())
    assert sorted(staged.collect()) == sorted(one.collect())


def test_grid_entries_fitted_together_equal_those_fitted_alone(spark, data):
    rows = data.toDF("buying_events_month_first", "spent_money_first_month", "label", "split")
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(0.0).alias(c) for c in ML.FEATURES], "label", "split")
    grid = (("logreg", "none"), ("logreg", "standard"), ("svc", "minmax"), ("gnb", "none"))
    got, alone = ([(r.model, r.split, r.rows, r.auc, r.chosen) for r in ML.model_selection(rows, grid, parallelism=n)
                   .orderBy("model", "split").collect()] for n in (4, 1))
    assert got == alone and len(got) == 8
