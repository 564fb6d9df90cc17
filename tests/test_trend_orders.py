from __future__ import annotations

import random

import numpy as np
import pytest

from cartlens.operators import ordered, users


def _fit(y, degree):
    degree = min(degree, len(y) - 1)
    return np.polyfit(np.arange(len(y)), y, degree)[-2] if len(y) > 1 else 0.0


@pytest.mark.parametrize("degree", [1, 2, 3, 4])
def test_linear_coefficient_equals_a_plain_fit(spark, degree):
    rng = random.Random(degree)
    series = {g: [round(rng.uniform(1, 900), 2) for _ in range(n)] for g, n in enumerate([1, 2, 3, 4, 5, 9, 40, 600])}
    rows = [(g, k, y) for g, ys in series.items() for k, y in enumerate(ys)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, k int, y double")
    got = ordered.centred_moments(df, "g", ["k"], "y", degree, partitions=7).select("g", ordered.linear_coefficient(degree).alias("c"))
    for r in got.collect():
        assert r.c == pytest.approx(_fit(series[r.g], degree), rel=1e-9, abs=1e-8), (r.g, degree)


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(g, k, round(rng.uniform(1, 50), 2)) for g in range(3) for k in range(300)]
    df = spark.createDataFrame(rows, "g int, k int, y double")
    out = []
    for size in (64, 7):
        monkeypatch.setattr(ordered, "CHUNK_ROWS", size)
        m = ordered.centred_moments(df, "g", ["k"], "y", 3, partitions=5)
        out.append({r.g: r.c for r in m.select("g", ordered.linear_coefficient(3).alias("c")).collect()})
    assert out[0].keys() == out[1].keys() and all(out[0][g] == pytest.approx(out[1][g], rel=1e-9) for g in out[0])


def test_order_is_checked_and_users_without_buys_keep_zero(spark, sessions, products):
    priced = users.purchase_rows(sessions, products)
    with pytest.raises(ValueError):
        users.user_spending_trend(priced, order=6)
    one = {r.user_id: r.spending_trend for r in users.user_features(priced).collect()}
    two = {r.user_id: r.spending_trend for r in users.user_features(priced, trend_order=2).collect()}
    assert one.keys() == two.keys() and two[105] == 0.0
