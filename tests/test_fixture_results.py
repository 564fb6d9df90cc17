"""Hand-worked results of FIXTURES.md section 2 on the small session log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cartlens.functions import timefeat as tf
from cartlens.operators import joins as J
from cartlens.operators import sessions as A
from cartlens.operators import users as U
from cartlens.plans import features as C
from conftest import rows


def test_session_summary(sessions):
    got = rows(A.session_summary(sessions),
               "session_id", "n_products", "bought", "seconds_total", "seconds_mod_day")
    assert got == [(1, 3, 1, 390, 390), (2, 2, 1, 87600, 1200), (3, 1, 1, 0, 0), (4, 1, 1, 0, 0),
                   (5, 0, 0, 0, 0), (6, 1, 1, 0, 0), (7, 1, 0, 0, 0), (8, 1, 1, 0, 0),
                   (9, 2, 0, 1800, 1800)]


def test_purchase_prob_by_views(sessions):
    got = rows(A.purchase_prob_by_views(sessions), "n_products", "purchase_prob", "sessions")
    assert got == [(0, 0.0, 1), (1, 0.8, 5), (2, 0.5, 2), (3, 1.0, 1)]


def test_user_features_all_months(sessions, products):
    feats = U.user_features(U.purchase_rows(sessions, products), partitions=3)
    got = rows(feats, "user_id", "total_sum", "mean_discount", "corr_purchase_discount",
               "spending_trend")
    assert got == [(102, 950.0, 3.333333, 0.687513, 175.0),
                   (103, 100.0, 0.0, None, 0.0),
                   (104, -5.0, 7.5, -1.0, 0.0),
                   (105, 0.0, 5.0, None, 0.0)]


def test_training_set_v3_rows_before_drop(sessions, products):
    r = C.user_month_rows(sessions, products, "2021-11-01", "2022-01-31", keep_third=True)
    got = rows(r.withColumn("month", tf.month_of_idx("month_idx")),
               "year", "month", "user_id", "buying_events_month_first", "buying_events_month_second",
               "all_events_month_first", "all_events_month_second", "spent_money_first_month",
               "spent_money_second_month", "spend_third", "label")
    assert got == [(2021, 11, 102, 1, 1, 3, 2, 250.0, 100.0, 600.0, 1),
                   (2021, 11, 103, 1, 0, 1, 1, 100.0, 0.0, 0.0, 0),
                   (2021, 12, 102, 1, 1, 2, 1, 100.0, 600.0, 0.0, 0),
                   (2022, 1, 102, 1, 0, 1, 0, 600.0, 0.0, 0.0, 0),
                   (2022, 1, 104, 1, 0, 1, 0, -5.0, 0.0, 0.0, 0)]


def test_training_set_v3_columns_label_last(sessions, products):
    out = C.training_set_v3(sessions, products, "2021-11-01", "2022-01-31")
    assert out.columns == C.V3_COLUMNS
    assert out.count() == 5


def test_missing_dates(sessions):
    got = [r.date for r in J.missing_dates(sessions, "2022-01-01", "2022-01-05").orderBy("date").collect()]
    assert got == [dt.date(2022, 1, d) for d in (1, 2, 4, 5)]


def test_date_difference_equals_anti_join(sessions):
    a = rows(J.missing_dates(sessions, "2021-11-01", "2022-02-28"))
    b = rows(J.date_difference(sessions, "2021-11-01", "2022-02-28"))
    assert a == b


def test_cyclic_month(spark):
    df = spark.createDataFrame([(11,), (12,), (1,)], "month int")
    s, c = tf.cyclic_month("month")
    got = rows(df.select("month", s.alias("s"), c.alias("c")))
    assert got == [(1, 0.5, 0.866025), (11, -0.5, 0.866025), (12, 0.0, 1.0)]


def test_cyclic_hour_period_23_and_weekday(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 2, 0, 0),), (dt.datetime(2022, 1, 2, 23, 0),)],
                               "timestamp timestamp_ntz")
    s, c = tf.cyclic_hour("timestamp", 23.0)
    got = rows(df.select(s.alias("s"), c.alias("c"), tf.weekday_sunday0("timestamp").alias("w")))
    assert got == [(0.0, 1.0, 0), (0.0, 1.0, 0)]


def test_user_month_spine_keeps_users_without_buys(sessions):
    spine = J.user_month_spine(sessions, "2021-11-01", "2022-02-28")
    assert spine.count() == 4 * 4
    assert spine.where(F.col("user_id").isNull()).count() == 0


def test_features_v2_year_wrap_by_hand(sessions, products):
    # Window (2021-11-01, 2022-02-01): months Nov, Dec, Jan; the third month is January.
    v2 = C.features_v2(sessions, products, "2021-11-01", "2022-02-01")
    assert v2.columns == C.V2_COLUMNS
    got = rows(v2, "year", "month", "buying_sessions", "label", "spent_money",
               "spent_money_first_month", "spent_money_second_month", "buying_events_first_month",
               "buying_events_second_month", "all_events_first_month", "all_events_second_month")
    # 4 users x 3 months = 12 rows; users 104 and 105 are identical in December -> 11.
    assert len(got) == 11
    assert (2021, 11, 2, 1, 350.0, 250.0, 100.0, 1, 0, 3, 0) in got        # user 102
    assert (2021, 12, 2, 1, 350.0, 250.0, 100.0, 0, 1, 0, 2) in got
    assert (2022, 1, 1, 1, 600.0, 250.0, 100.0, 0, 0, 0, 0) in got
    assert (2021, 12, 1, 0, 100.0, 100.0, 0.0, 0, 0, 0, 1) in got         # user 103
    assert (2022, 1, 1, 0, -5.0, 0.0, 0.0, 0, 0, 0, 0) in got             # user 104
    assert got.count((2021, 12, 0, 0, 0.0, 0.0, 0.0, 0, 0, 0, 0)) == 1    # 104 = 105, merged


def test_features_v1_keeps_users(sessions, products):
    v1 = C.features_v1(sessions, products, "2021-11-01", "2022-02-01")
    assert v1.columns == C.V1_COLUMNS
    assert v1.count() == 12
    got = rows(v1.where("user_id = 102"), "month", "buying_sessions", "spent_money", "first_month",
               "second_month", "buying_events_first_month", "buying_events_second_month")
    assert got == [(1, 1, 600.0, 250.0, 100.0, 0, 0), (11, 2, 350.0, 250.0, 100.0, 1, 0),
                   (12, 2, 350.0, 250.0, 100.0, 0, 1)]


def test_purchase_prob_by_duration_bins(sessions):
    got = rows(A.purchase_prob_by_duration(sessions, 10), "bin", "sessions", "purchase_prob")
    assert got[0] == (0, 8, 0.625) and got[9] == (9, 1, 1.0)
    assert all(r[1] == 0 and r[2] is None for r in got[1:9])


def test_missing_fraction_and_periods(sessions):
    mf = {r["column"]: (r.null_share, r.null_share_views, r.null_share_buys)
          for r in A.missing_fraction(sessions).collect()}
    assert mf["purchase_id"] == (7 / 13, 1.0, 0.0)
    assert mf["user_id"][0] == 1 / 13
    kinds = rows(A.distinct_periods(sessions))
    assert ("year", 2021) in kinds and ("month", 2) in kinds and ("user", 105) in kinds
    assert len([k for k in kinds if k[0] == "user"]) == 4
