from __future__ import annotations

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from cartlens.llm import mixing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=8))
def test_pfair_windows_and_lag(shares):
    period = sum(shares)
    slots = mixing.pfair_period(shares)
    assert sorted(x for s in slots for x in s) == list(range(period))
    for k, mine in zip(shares, slots):
        assert mine == sorted(mine) and len(mine) == k
        for i, at in enumerate(mine):                      # release <= slot < deadline
            assert i * period // k <= at < -(-(i + 1) * period // k)
        for t in range(period + 1):
            assert abs(Fraction(k * t, period) - sum(x < t for x in mine)) < 1


def test_tickets():
    t = mixing.tickets({"a": 0.5, "b": 0.3, "c": 0.2, None: 1e-9}, 1000)
    assert sum(t.values()) == 1000 and t[None] == 1 and t["a"] in (499, 500)


def _table(spark):
    rows = [(i, "big" if i % 3 else f"s{i % 6}", "x", i) for i in range(900)]
    rows += [(5000 + i, None, "n", i) for i in range(7)] + [(None, "big", "q", 1), (4, "big", "x", 4), (4, "big", "x", 4)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, slot long")


def test_mix_covers_every_row_and_keeps_the_weights(spark):
    docs = _table(spark)
    got = mixing.mix(docs, block=8, resolution=100, bucket_rows=50).orderBy("position").collect()
    assert docs.columns[:3] == ["doc_id", "source", "text"] and [r.position for r in got] == list(range(len(got)))
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.collect()}
    n = {r.source: r["count"] for r in docs.groupBy("source").count().collect()}
    share = mixing.tickets({s: c ** 0.7 for s, c in n.items()}, 100)
    count = dict.fromkeys(n, 0)
    for k in range(0, len(got), 8):
        block = got[k:k + 8]
        assert len({(r.source, r.slot, r.block) for r in block}) == 1 and block[0].slot == k // 8
        count[block[0].source] += 1
        for s in n:
            assert abs(share[s] / 100 * (k // 8 + 1) - count[s]) < 1
    for s, c in n.items():                                  # each reading of a source is the same order, whole
        order = [r.doc_id for r in got if r.source == s]
        assert order[:c] != sorted(order[:c], key=str) or c < 4
        assert order[c:2 * c] == order[:len(order[c:2 * c])]
        assert sum(r.epoch == 0 for r in got if r.source == s) == c


def test_mix_does_not_depend_on_partitions(spark):
    a, b = ({(r.position, r.doc_id) for r in mixing.mix(_table(spark).repartition(k), block=8, bucket_rows=64).collect()}
            for k in (1, 9))
    assert a == b


def test_mix_with_given_weights_and_empty(spark):
    docs = _table(spark)
    got = mixing.mix(docs, weights={"s0": 1, "s3": 3, "big": 0}, block=4, resolution=8).collect()
    assert {r.source for r in got} == {"s0", "s3"}
    assert sum(r.source == "s3" for r in got) > 2 * sum(r.source == "s0" for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.where("source = 'none'"), ordered=True).count() == 0
