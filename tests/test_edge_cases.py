"""FIXTURES.md section 3: boundary cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartlens.functions.stats import histogram
from cartlens.operators import filters as P
from cartlens.plans import features as C
from cartlens.plans import metrics as X
from cartlens.sources import schemas as S
from conftest import rows

V, B = S.VIEW, S.BUY


def _log(spark, data):
    return spark.createDataFrame(data, S.nullable(S.SESSIONS))


def test_label_boundary_exactly_100_is_0(spark):
    # m: 200, m+1: 0 -> average 100; m+2: 200 -> third - average = 100 exactly.
    data = [(1, dt.datetime(2021, 1, 5), 1, 1, B, 0, 1), (2, dt.datetime(2021, 1, 6), 1, 1, B, 0, 2),
            (3, dt.datetime(2021, 3, 5), 1, 1, B, 0, 3), (4, dt.datetime(2021, 3, 6), 1, 1, B, 0, 4)]
    products = spark.createDataFrame([(1, 100.0)], S.PRODUCTS)
    r = C.user_month_rows(_log(spark, data), products, "2021-01-01", "2021-01-31")
    assert [x.label for x in r.collect()] == [0]
    # one cent more and the label flips
    products2 = spark.createDataFrame([(1, 100.0), (2, 100.01)], S.PRODUCTS)
    data2 = data[:3] + [(4, dt.datetime(2021, 3, 6), 1, 2, B, 0, 4)]
    r2 = C.user_month_rows(_log(spark, data2), products2, "2021-01-01", "2021-01-31")
    assert [x.label for x in r2.collect()] == [1]


def test_equal_users_merge_after_dedupe(spark):
    data = [(1, dt.datetime(2021, 1, 5), 1, 1, B, 0, 1), (2, dt.datetime(2021, 1, 5), 2, 1, B, 0, 2)]
    products = spark.createDataFrame([(1, 10.0)], S.PRODUCTS)
    out = C.training_set_v3(_log(spark, data), products, "2021-01-01", "2021-01-31")
    assert out.count() == 1
    assert C.training_set_v3(_log(spark, data), products, "2021-01-01", "2021-01-31",
                             dedupe=False).count() == 2


def test_histogram_max_in_last_bin_and_sums(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    h = histogram(df, "x", 5)
    got = rows(h, "bin", "rows")
    assert got == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]
    assert sum(r for _, r in got) == 11


def test_histogram_all_equal_single_bin(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (3.0,)], "x double")
    assert rows(histogram(df, "x", 10)) == [(0, 3.0, 3.0, 3)]


def test_auc_all_tied_is_half(spark):
    df = spark.createDataFrame([(0.3, 1), (0.3, 0), (0.3, 1), (0.3, 0)], "score double, label int")
    assert X.auc(df).first().auc == 0.5


def test_auc_matches_pairwise_definition(spark):
    import random
    rnd = random.Random(7)
    data = [(float(rnd.randint(0, 30)), rnd.randint(0, 1)) for _ in range(400)]
    pos = [s for s, y in data if y == 1]
    neg = [s for s, y in data if y == 0]
    expect = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(data, "score double, label int")
    assert X.auc(df, partitions=5).first().auc == pytest.approx(expect, abs=1e-12)


def test_confusion_keeps_never_predicted_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "label int, prediction int")
    got = rows(X.confusion(df))
    assert got == [(0, 0, 1), (0, 1, 0), (1, 0, 2), (1, 1, 0)]


def test_duplicate_product_reported(spark):
    products = spark.createDataFrame([(1, 5.0), (1, 6.0), (2, -1.0), (3, 1e9)], S.PRODUCTS)
    r = P.price_quality(products).first()
    assert (r.products, r.negative_prices, r.huge_prices, r.duplicated_ids) == (4, 1, 1, 1)


def test_overlapping_windows_raise():
    with pytest.raises(ValueError):
        P.check_windows(("2019-09-01", "2021-12-31"), ("2021-01-01", "2021-03-31"))
    with pytest.raises(ValueError):  # a one-month gap still leaks m+2 labels
        P.check_windows(("2020-01-01", "2020-06-30"), ("2020-08-01", "2020-12-31"))
    P.check_windows(("2020-01-01", "2020-06-30"), ("2020-09-01", "2020-12-31"))
    P.check_windows(("2019-09-01", "2021-12-31"), ("2021-01-01", "2021-03-31"), allow_overlap=True)


def test_month_range_matches_month_start_semantics():
    from cartlens.functions.timefeat import month_range
    assert month_range("2019.09.01", "2021.12.31") == (2019 * 12 + 8, 2021 * 12 + 11)
    lo, hi = month_range("2019-09-15", "2019-12-01")
    assert (lo, hi) == (2019 * 12 + 9, 2019 * 12 + 11)


def test_range_frame_not_lead(spark):
    # user 1 buys in 2021-11 and 2022-01 only: the "next month" of November is empty.
    data = [(1, dt.datetime(2021, 11, 7), 1, 1, B, 0, 1), (2, dt.datetime(2022, 1, 9), 1, 1, B, 0, 2)]
    products = spark.createDataFrame([(1, 10.0)], S.PRODUCTS)
    r = C.user_month_rows(_log(spark, data), products, "2021-11-01", "2021-11-30", keep_third=True)
    x = r.first()
    assert (x.buying_events_month_second, x.spent_money_second_month, x.spend_third) == (0, 0.0, 10.0)


def test_corr_null_for_constant_side(spark):
    from cartlens.functions.stats import guarded_corr
    df = spark.createDataFrame([(1, 0.0, 5), (1, 0.0, 7), (2, 1.0, 3), (2, 2.0, 3), (3, 1.0, 1),
                                (3, 2.0, 2)], "g int, x double, y int")
    got = rows(df.groupBy("g").agg(guarded_corr("x", "y").alias("c")))
    assert got == [(1, None), (2, None), (3, 1.0)]


def test_null_user_group_dropped(sessions, products):
    from cartlens.operators import users as U
    feats = U.user_features(U.purchase_rows(sessions, products))
    assert feats.where(F.col("user_id").isNull()).count() == 0


def test_require_full_window_drops_months_without_m_plus_2(sessions, products):
    from cartlens.functions.timefeat import month_of_idx
    full = C.user_month_rows(sessions, products, "2021-11-01", "2022-01-31")
    strict = C.user_month_rows(sessions, products, "2021-11-01", "2022-01-31",
                               require_full_window=True)
    # the log ends in 2022-02, so January (m+2 = March) is the only month without its whole window
    assert sorted(r.m for r in full.select(month_of_idx("month_idx").alias("m")).collect()) == [1, 1, 11, 11, 12]
    assert sorted(r.m for r in strict.select(month_of_idx("month_idx").alias("m")).collect()) == [11, 11, 12]


def test_approx_distinct_close_to_exact(sessions):
    from cartlens.operators import sessions as A
    exact = A.distinct_counts(sessions).first()
    approx = A.distinct_counts(sessions, approx=True).first()
    assert tuple(exact) == (4, 9, 4) and tuple(approx) == tuple(exact)


def test_duplicate_product_inflates_money_not_counts(spark):
    data = [(1, dt.datetime(2021, 1, 5), 1, 1, B, 0, 1), (2, dt.datetime(2021, 1, 6), 1, 2, V, 0, None)]
    dup = spark.createDataFrame([(1, 10.0), (1, 15.0), (2, 1.0)], S.PRODUCTS)
    r = C.user_month_rows(_log(spark, data), dup, "2021-01-01", "2021-01-31").first()
    assert (r.buying_events_month_first, r.all_events_month_first, r.spent_money_first_month) == (1, 2, 25.0)
