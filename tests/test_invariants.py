"""SURVEY section 5.3: invariants between independent formulations."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartlens.operators import monthly as M
from cartlens.operators.ordered import positions, slope_from_sums, trend_sums
from cartlens.plans import metrics as X
from cartlens.sources.adapters import Tables
from conftest import rows

SF = "/root/testdata/sf0.001"


def test_window_form_equals_self_join_form(spark):
    t = Tables(spark, SF)
    facts = M.user_month_facts(t.line_sessions(), t.products())
    a = rows(M.user_month_next(facts))
    b = rows(M.user_month_next_selfjoin(facts))
    assert a == b


def test_global_dedupe_equals_per_month_dedupe(spark):
    from cartlens.plans.features import V3_COLUMNS, user_month_rows
    t = Tables(spark, SF)
    r = user_month_rows(t.line_sessions(), t.products(), "1996-01-01", "1997-12-31")
    glob = rows(r.select(*V3_COLUMNS).dropDuplicates())
    per = rows(r.select("month_idx", *V3_COLUMNS).dropDuplicates().drop("month_idx"))
    assert glob == per


def _skewed(spark, n_hot=3000, n_cold=200, seed=3):
    rnd = random.Random(seed)
    data = [(1, i // 3, rnd.randint(1, 9) * 1.5) for i in range(n_hot)]  # one hot user, ties in key
    data += [(rnd.randint(2, 40), rnd.randint(0, 50), rnd.randint(-3, 9) * 2.0) for _ in range(n_cold)]
    return spark.createDataFrame(data, "g long, k long, y double")


def test_positions_equal_row_number_across_partitions(spark):
    df = _skewed(spark)
    mine = positions(df, "g", ["k", "y"], "pos", partitions=7)
    w = Window.partitionBy("g").orderBy("k", "y")
    ref = df.withColumn("pos", F.row_number().over(w) - 1)
    assert rows(mine, "g", "k", "y", "pos") == rows(ref, "g", "k", "y", "pos")


def test_positions_spread_hot_group_over_partitions(spark):
    df = _skewed(spark)
    parts = (df.repartitionByRange(7, "g", "k", "y").where(F.col("g") == 1)
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_trend_sums_equal_window_regression(spark):
    df = _skewed(spark)
    mine = trend_sums(df, "g", ["k", "y"], "y", partitions=7).select(
        "g", slope_from_sums().alias("slope"))
    w = Window.partitionBy("g").orderBy("k", "y")
    ref = (df.withColumn("pos", (F.row_number().over(w) - 1).cast("double"))
           .groupBy("g").agg(F.count("y").alias("n"), F.regr_slope("y", "pos").alias("s"))
           .select("g", F.when(F.col("n") < 2, 0.0).otherwise(F.col("s")).alias("slope")))
    a = dict(rows(mine))
    b = dict(rows(ref))
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-6)


def test_auc_equals_spark_evaluator_on_tie_free_scores(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rnd = random.Random(11)
    data = [(i / 997.0 + rnd.random() * 1e-6, int(rnd.random() < 0.3 + 0.4 * (i / 997.0)))
            for i in range(997)]
    df = spark.createDataFrame(data, "score double, label int")
    mine = X.auc(df, partitions=4).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC", numBins=0)
    ref = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert mine == pytest.approx(ref, abs=1e-9)


def test_one_plan_splits_equal_separate_windows(spark):
    from cartlens.plans.features import training_set_v3, training_sets
    t = Tables(spark, SF)
    s, p = t.line_sessions(), t.products()
    windows = {"a": ("1996-01-01", "1997-06-30"), "b": ("1997-09-01", "1998-12-31"),
               "c": ("1997-01-01", "1997-12-31")}          # c overlaps a and b
    together = training_sets(s, p, windows)
    for name, (b, e) in windows.items():
        one = rows(together.where(F.col("split") == name).drop("split"))
        assert one == rows(training_set_v3(s, p, b, e)), name
