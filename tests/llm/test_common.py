from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cartlens.llm import common as C


def test_hash_of_longs_is_sparks(spark):
    values = [0, 1, -1, 7, 2**62, -2**63, 123456789]
    rows = spark.createDataFrame([(v,) for v in values], "k long").select(F.xxhash64("k").alias("h")).collect()
    assert [r.h for r in rows] == C.xxhash64_long(np.array(values, np.int64)).tolist()


def test_key_filter_lets_every_key_through(spark):
    keys = [k * 37 - 5000 for k in range(3000)]
    bits = C.key_filter(spark.createDataFrame([(k,) for k in keys], "k long"), "k")
    assert C.passes(bits, np.array(keys)).all()
    others = np.arange(10**6, 10**6 + 20_000)
    assert C.passes(bits, others).mean() < 0.01
    empty = C.key_filter(spark.createDataFrame([], "k long"), "k")
    assert not C.passes(empty, others).any()


def test_words_are_split_at_ascii_white_space_only():
    assert C.split_words("a b c\x0bD\x1ce\tF", lower=True) == ["a b".encode(), b"c", b"d\x1ce", b"f"]
    assert C.split_words(None) == [] and C.split_words(" \n") == []
    h = C.word_hashes(C.split_words("x y x y x"))
    w = C.window_hashes(h, 2)
    assert w[0] == w[2] and w[1] == w[3] and w[0] != w[1] and len(C.window_hashes(h, 6)) == 0


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(k, k + 1) for k in range(1000, 1100)]                    # a long path
    edges += [(5000, 5001 + k) for k in range(200)] + [(7, 7), (None, 3), (3, None)]
    parent: dict[int, int] = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
