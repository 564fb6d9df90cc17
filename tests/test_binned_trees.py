"""Trees fitted on counts of binned rows: the same rows, trees and scores as over the rows themselves."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cartlens.plans import models as ML

A, B = "buying_events_month_first", "spent_money_first_month"


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = []
    for k in range(600):
        a, b = rng.randrange(4), round(rng.gauss(0, 3), 1)
        rows.append((a, b, int(a + b + rng.gauss(0, 2) > 2), "train" if k % 3 else "val"))
    df = spark.createDataFrame(rows, f"{A} int, {B} double, label int, split string")
    return df.select(*[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in ML.FEATURES], "label", "split")


def metrics(df):
    return sorted((r.model, r.split, r.rows, round(r.accuracy, 9), round(r.auc, 9), r.predicted_positive) for r in df.collect())


def test_thresholds_are_those_of_few_values_or_part_many_evenly():
    assert ML.bin_thresholds([3, 1, 1, 2]) == [1.5, 2.5]
    assert ML.bin_thresholds([7, 7]) == []
    many = ML.bin_thresholds(range(320))
    assert len(many) == 31 and {b - a for a, b in zip(many, many[1:])} == {10.0}


@pytest.mark.parametrize("scaler", ["none", "standard", "minmax"])
def test_counts_hold_every_row(data, scaler):
    counts = ML.binned_counts(data, 400, scaler).collect()
    assert sum(r.n for r in counts if r.split == "train") == 400
    assert sum(r.n for r in counts) == 600 > len(counts)
    assert sum(r.n for r in counts if r.label) == data.where("label = 1").count()


@pytest.mark.parametrize("scaler", ["none", "standard", "minmax"])
def test_boosted_trees_on_counts_equal_those_on_rows(data, scaler, monkeypatch):
    on_rows = metrics(ML.fit_and_score(data, "gbt", scaler))
    monkeypatch.setattr(ML, "ROWS_PER_TREE", 100)
    monkeypatch.setattr(ML, "build", None)               # nothing is fitted on the rows
    assert metrics(ML.fit_and_score(data, "gbt", scaler)) == on_rows


def test_forest_on_counts_does_not_depend_on_partitions(spark, data):
    counts = ML.binned_counts(data, 400)
    got = [metrics(ML.evaluate(ML.fit_binned(counts.repartition(n), "forest", trees=6, depth=4), counts, "forest", weight="n")) for n in (1, 5)]
    assert got[0] == got[1]
    assert [r[2] for r in got[0]] == [400, 200] and all(r[4] > 0.7 for r in got[0])


def test_forest_on_counts_has_all_its_trees_and_draws(spark, data):
    names = [f"bin_{i}" for i in range(2)]
    rows = spark.createDataFrame([(float(i), float(i % 3), i % 2, n) for i, n in enumerate([*[2] * 39, 1950])], "bin_0 double, bin_1 double, label int, n long")
    model = ML.binned_forest(rows, VectorAssembler(inputCols=names, outputCol="features"), 32, trees=7, depth=3, seed=1)
    assert len(model.trees) == 7 == len({t.toDebugString.split("\n", 1)[1] for t in model.trees})
    assert max(t.depth for t in model.trees) == 3
    keyed = rows.select("n", F.xxhash64("bin_0", "label").alias("key")).toPandas()
    drawn = next(ML._drawn(400, 0)(iter([keyed])))
    assert abs(drawn.iloc[39].mean() - 1950) < 15 and 1600 < drawn.iloc[39].var() < 2300


def test_model_selection_shares_the_counts_of_a_scaler(data, monkeypatch):
    monkeypatch.setattr(ML, "ROWS_PER_TREE", 100)
    seen, plain = [], ML.binned_counts
    monkeypatch.setattr(ML, "binned_counts", lambda d, rows, scaler: seen.append((rows, scaler)) or plain(d, rows, scaler))
    grid = (("gbt", "none"), ("logreg", "none"), ("gbt", "minmax"))
    got = ML.model_selection(data, grid).collect()
    assert seen == [(400, "none"), (400, "minmax")]
    assert sorted((r.model, r.split, r.rows) for r in got) == [
        (m, s, n) for m in ("gbt", "gbt+minmax", "logreg") for s, n in (("train", 400), ("val", 200))]
    assert len({r.model for r in got if r.chosen}) == 1
