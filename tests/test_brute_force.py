"""Spark plans against plain-Python brute force on random small logs.

The brute force follows the reference's procedure literally: a loop over
month starts with per-month filters and left merges for C1, the user-month
spine with year counts, window spend and month counts for C2, and numpy's
``corrcoef`` / ``polyfit`` per user for the user features.
"""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartlens.operators import users as U
from cartlens.plans import features as C
from cartlens.sources import schemas as S

BEGIN, END = "2021-10-01", "2022-02-28"
PRICES = {1: 100.0, 2: 250.5, 3: 600.0, 4: -5.25, 5: 1200.0}  # product 6 has no price

row_st = st.tuples(
    st.integers(0, 40),                               # session id
    st.integers(0, 200),                              # day offset from 2021-09-20
    st.integers(0, 23),                               # hour
    st.one_of(st.none(), st.integers(1, 4)),          # user id
    st.one_of(st.none(), st.integers(1, 6)),          # product id
    st.booleans(),                                    # bought?
    st.sampled_from([0, 5, 10, 15]),                  # discount
)


def _log(rows):
    out = []
    for i, (sid, day, hour, user, prod, buy, disc) in enumerate(rows):
        ts = dt.datetime(2021, 9, 20) + dt.timedelta(days=day, hours=hour)
        out.append((sid, ts, user, prod, S.BUY if buy else S.VIEW, disc, 1000 + i if buy else None))
    return out


def _midx(ts):
    return ts.year * 12 + ts.month - 1


def brute_c1(log):
    b = dt.date.fromisoformat(BEGIN)
    e = dt.date.fromisoformat(END)
    first = b.year * 12 + b.month - 1 + (0 if b.day == 1 else 1)
    last = e.year * 12 + e.month - 1
    rows = [r for r in log if r[2] is not None]
    out = []
    for m in range(first, last + 1):
        def in_m(r, k=0):
            return _midx(r[1]) == m + k

        buyers = sorted({r[2] for r in rows if in_m(r) and r[4] == S.BUY})
        month_rows = set()
        for u in buyers:
            mine = [r for r in rows if r[2] == u]
            b0 = sum(1 for r in mine if in_m(r) and r[4] == S.BUY)
            b1 = sum(1 for r in mine if in_m(r, 1) and r[4] == S.BUY)
            e0 = sum(1 for r in mine if in_m(r))
            e1 = sum(1 for r in mine if in_m(r, 1))

            def spend(k):
                return sum((Decimal(str(PRICES[r[3]])) for r in mine
                            if in_m(r, k) and r[4] == S.BUY and r[3] in PRICES), Decimal(0))

            s0, s1, s2 = spend(0), spend(1), spend(2)
            label = 1 if s2 - (s0 + s1) / 2 > 100 else 0
            month = m % 12 + 1
            month_rows.add((m // 12, b0, b1, e0, e1, round(math.sin(2 * math.pi * month / 12), 6),
                            round(math.cos(2 * math.pi * month / 12), 6), float(s0), float(s1), label))
        out.extend(month_rows)
    return sorted(out)


def brute_user_features(log):
    joined = [r for r in log if r[2] is not None and r[3] in PRICES]
    out = {}
    for u in sorted({r[2] for r in joined}):
        mine = [r for r in joined if r[2] == u]
        purchase = [PRICES[r[3]] if r[4] == S.BUY else 0.0 for r in mine]
        disc = [float(r[5]) for r in mine]
        total = float(sum(Decimal(str(p)) for p in purchase))
        mean = sum(disc) / len(disc)
        if len(mine) < 2 or len(set(purchase)) == 1 or len(set(disc)) == 1:
            corr = None
        else:
            corr = float(np.corrcoef(purchase, disc)[0][1])
        ordered = sorted((r[1], r[0], r[3], p) for r, p in zip(mine, purchase) if p != 0)
        ys = [o[3] for o in ordered]
        trend = 0.0 if len(ys) < 2 else float(np.polyfit(np.arange(len(ys)), ys, 1)[-2])
        out[u] = (total, mean, corr, trend)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_st, min_size=1, max_size=60))
def test_c1_equals_month_loop(spark, rows):
    log = _log(rows)
    sessions = spark.createDataFrame(log, S.nullable(S.SESSIONS))
    products = spark.createDataFrame(list(PRICES.items()), S.PRODUCTS)
    got = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                 for r in C.training_set_v3(sessions, products, BEGIN, END).collect())
    assert got == brute_c1(log)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_st, min_size=1, max_size=60))
def test_user_features_equal_numpy(spark, rows):
    log = _log(rows)
    sessions = spark.createDataFrame(log, S.nullable(S.SESSIONS))
    products = spark.createDataFrame(list(PRICES.items()), S.PRODUCTS)
    feats = U.user_features(U.purchase_rows(sessions, products), partitions=3).collect()
    got = {r.user_id: (float(r.total_sum), r.mean_discount, r.corr_purchase_discount, r.spending_trend)
           for r in feats}
    want = brute_user_features(log)
    assert got.keys() == want.keys()
    for u, (total, mean, corr, trend) in want.items():
        g = got[u]
        assert g[0] == total and math.isclose(g[1], mean, abs_tol=1e-9)
        assert (g[2] is None) == (corr is None)
        if corr is not None:
            assert math.isclose(g[2], corr, abs_tol=1e-9)
        assert math.isclose(g[3], trend, abs_tol=1e-6)


V2_BEGIN, V2_END = "2021-11-15", "2022-02-01"


def brute_v2(log):
    b = dt.datetime.fromisoformat(V2_BEGIN)
    e = dt.datetime.fromisoformat(V2_END)
    first = b.year * 12 + b.month - 1
    last_day = e - dt.timedelta(days=1)
    last = last_day.year * 12 + last_day.month - 1
    m0, m1 = first, first + 1
    rows = [r for r in log if r[2] is not None]
    users = sorted({r[2] for r in rows})
    out = set()
    for u in users:
        mine = [r for r in rows if r[2] == u]
        deals = [r for r in mine if r[4] == S.BUY and b < r[1] < e]

        def spend(pred):
            return sum((Decimal(str(PRICES[r[3]])) for r in deals if pred(r) and r[3] in PRICES),
                       Decimal(0))

        s = [spend(lambda r, k=k: _midx(r[1]) == m0 + k) for k in range(3)]
        wb0 = sum(1 for r in deals if _midx(r[1]) == m0)
        label = 1 if wb0 > 0 and s[2] - (s[0] + s[1]) / 2 > 100 else 0
        for m in range(first, last + 1):
            year, month = m // 12, m % 12 + 1
            ys = sum(1 for r in mine if r[4] == S.BUY and r[1].year == year)
            spent = spend(lambda r: r[1].year == year)
            buys = lambda k: sum(1 for r in mine if r[4] == S.BUY and _midx(r[1]) == k)
            events = lambda k: sum(1 for r in mine if _midx(r[1]) == k)
            out.add((year, month, round(math.sin(2 * math.pi * month / 12), 6),
                     round(math.cos(2 * math.pi * month / 12), 6), ys, label, float(spent),
                     float(s[0]), float(s[1]), buys(m0) if m == m0 else 0,
                     buys(m1) if m == m1 else 0, events(m0) if m == m0 else 0,
                     events(m1) if m == m1 else 0))
    return sorted(out)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_st, min_size=1, max_size=60))
def test_features_v2_equals_brute_force(spark, rows):
    log = _log(rows)
    sessions = spark.createDataFrame(log, S.nullable(S.SESSIONS))
    products = spark.createDataFrame(list(PRICES.items()), S.PRODUCTS)
    got = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                 for r in C.features_v2(sessions, products, V2_BEGIN, V2_END).collect())
    assert got == brute_v2(log)
