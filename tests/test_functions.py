"""F1-F13, M1, M5 parameters, net price option and the month-partitioned layout."""

from __future__ import annotations

import datetime as dt
import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from cartlens.functions import timefeat as tf
from cartlens.operators import filters as P
from cartlens.plans import features as C
from cartlens.plans import models as ML
from cartlens.sources import schemas as S
from cartlens.sources import sinks as SK
from conftest import rows


def test_parse_timestamp_and_date(spark):
    df = spark.createDataFrame([("2022-01-03 09:00:00",), ("not a time",)], "s string")
    got = df.select(tf.parse_timestamp("s").alias("t"), tf.parse_date(F.lit("2022.01.03".replace(".", "-"))).alias("d")).collect()
    assert got[0].t == dt.datetime(2022, 1, 3, 9, 0) and got[1].t is None
    assert got[0].d == dt.date(2022, 1, 3)


def test_month_starts_and_steps(spark):
    ms = [r.month_start for r in tf.month_starts(spark, "2021.11.01", "2022.02.10").orderBy("month_idx").collect()]
    assert ms == [dt.date(2021, 11, 1), dt.date(2021, 12, 1), dt.date(2022, 1, 1), dt.date(2022, 2, 1)]
    df = spark.createDataFrame([(dt.date(2021, 12, 1),)], "m date")
    r = df.select(tf.next_month_start("m", 1).alias("a"), tf.next_month_start("m", 2).alias("b")).first()
    assert (r.a, r.b) == (dt.date(2022, 1, 1), dt.date(2022, 2, 1))


def test_time_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 2, 23, 5, 7),)], "timestamp timestamp_ntz")
    r = tf.time_parts(df).first()
    assert (r.date, r.time, r.day, r.month, r.year, r.hour, r.weekday) == (
        dt.date(2022, 1, 2), "23:05:07", 2, 1, 2022, 23, 0)


def test_prediction_time_format(spark):
    r = spark.range(1).select(tf.now_formatted().alias("t")).first().t
    dt.datetime.strptime(r, "%m/%d/%Y %H:%M:%S:%f")


def test_arm_is_the_parity_of_md5(spark):
    import hashlib
    users = [0, 1, 7, 102, 1499, 123456789, 2**62]
    df = spark.createDataFrame([(u,) for u in users], "user_id long")
    got = [r.a for r in df.select(tf.arm_of("user_id", 3).alias("a")).collect()]
    assert got == [int(hashlib.md5(f"3:{u}".encode()).hexdigest()[:8], 16) % 2 for u in users]


def test_arms_of_different_salts_are_independent(spark):
    arms = spark.range(4000).select(*[tf.arm_of("id", s).alias(f"s{s}") for s in (0, 1, 2)])
    same = arms.selectExpr("avg(int(s0 = s1)) a", "avg(int(s0 = s2)) b", "avg(s0) c").first()
    assert all(0.45 < x < 0.55 for x in same)


def test_assemble_vector_label_last(spark, sessions, products):
    ts = C.training_set_v3(sessions, products, "2021-11-01", "2022-01-31")
    vec = ML.assemble(ts)
    first = vec.select("features", "label").first()
    assert len(first.features) == len(ML.FEATURES) == 9


def test_forest_reference_setting_builds():
    est = ML.build("forest", trees=100, depth=16, seed=0).getStages()[-1]
    assert (est.getNumTrees(), est.getMaxDepth(), est.getSeed()) == (100, 16, 0)


def test_net_price_option(spark):
    data = [(1, dt.datetime(2021, 1, 5), 1, 1, S.BUY, 20, 1)]
    log = spark.createDataFrame(data, S.nullable(S.SESSIONS))
    products = spark.createDataFrame([(1, 50.0)], S.PRODUCTS)
    gross = C.user_month_rows(log, products, "2021-01-01", "2021-01-31").first()
    net = C.user_month_rows(log, products, "2021-01-01", "2021-01-31", net_price=True).first()
    assert (gross.spent_money_first_month, net.spent_money_first_month) == (50.0, 40.0)


def test_month_partitioned_layout_prunes(spark, sessions, tmp_path):
    path = str(tmp_path / "by_month")
    SK.write_sessions_by_month(sessions, path)
    back = SK.read_sessions_by_month(spark, path)
    one = P.filter_month(back, 2021, 12)
    buf = io.StringIO()
    with redirect_stdout(buf):
        one.explain("formatted")
    assert "PartitionFilters: [isnotnull(month_start" in buf.getvalue()
    assert rows(one, "session_id") == rows(P.filter_month(sessions, 2021, 12), "session_id")
    c1a = C.training_set_v3(back.drop("month_start"), spark.createDataFrame(
        [(10, 100.0), (11, 250.0), (12, 600.0), (13, -5.0)], S.PRODUCTS), "2021-11-01", "2022-01-31")
    c1b = C.training_set_v3(back, spark.createDataFrame(
        [(10, 100.0), (11, 250.0), (12, 600.0), (13, -5.0)], S.PRODUCTS), "2021-11-01", "2022-01-31")
    assert rows(c1a) == rows(c1b)


def test_model_selection_marks_one_choice(spark):
    from cartlens.sources.adapters import Tables
    from cartlens.plans.registry import TRAIN, VAL
    t = Tables(spark, "/root/testdata/sf0.001")
    data = ML.labelled_splits(t.line_sessions(), t.products(), ML.Windows(TRAIN, VAL))
    res = ML.model_selection(data, grid=(("logreg", "none"), ("gnb", "none"))).collect()
    assert len(res) == 4
    chosen = {r.model for r in res if r.chosen}
    assert len(chosen) == 1
    val = {r.model: r.auc for r in res if r.split == "val"}
    assert val[chosen.pop()] == max(val.values())


def test_histogram_makes_no_pass_for_its_range(spark):
    from cartlens.functions.stats import histogram
    from cartlens.session import checkpoint_dir
    checkpoint_dir(spark)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("hist", "histogram")
    try:
        out = histogram(spark.range(100).selectExpr("id % 7 AS x"), "x", 7)
        jobs = len(tracker.getJobIdsForGroup("hist"))
        spark.sparkContext.setJobGroup("plain", "checkpoint alone")
        spark.range(100).selectExpr("id % 7 AS x").groupBy("x").count().checkpoint()
        assert jobs == len(tracker.getJobIdsForGroup("plain"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.bin, r["rows"]) for r in out.collect()) == [(0, 15), (1, 15), (2, 14), (3, 14), (4, 14), (5, 14), (6, 14)]
