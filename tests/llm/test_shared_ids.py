"""Ids that stand on several texts or vectors, and rows without an id."""

from __future__ import annotations

import random

import numpy as np

from cartlens.llm import fm_dedup, hnsw_dedup, mixing, ngram_join


def _words(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_join_keeps_texts_of_one_id_apart(spark):
    rng = random.Random(1)
    a, b, c = (_words(rng, 60) for _ in range(3))
    for shift in (0, 1 << 62):
        rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (4, c), (None, a), (None, None), (4, c), (9, None), (9, "")]
        docs = spark.createDataFrame([(None if i is None else i + shift, t, "x") for i, t in rows], "doc_id long, text string, number string")
        got = sorted(((None if r.doc_id is None else r.doc_id - shift, r.n_shingles, None if r.component_id is None else r.component_id - shift)
                      for r in ngram_join.query(docs).collect()), key=str)
        want = [(1, 56, 1), (1, 56, 1), (2, 57, 1), (3, 57, 1), (4, 56, 4), (4, 56, 4), (9, 0, 9), (9, 0, 9), (None, 56, None), (None, 0, None)]
        assert got == sorted(want, key=str)


def test_repeats_are_cut_from_the_text_that_has_them(spark):
    rng = random.Random(2)
    p, q = _words(rng, 70), _words(rng, 60)
    rows = [(1, p + " | " + q), (2, p + " " + _words(rng, 30)), (2, _words(rng, 80) + " " + q), (None, p), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in fm_dedup.query(docs).collect()), key=str)
    assert got == sorted([(1, 131, 0), (2, 100, 70), (2, 140, 60), (None, 70, 0), (None, 0, 0)], key=str)


def test_vectors_of_one_id_stay_apart(spark):
    e = np.eye(8)
    rows = [(1, e[0], 0), (1, e[1], 0), (2, e[0] + .1 * e[2], 0), (3, e[1] + .1 * e[3], 0), (4, e[4], 0), (4, e[4], 0), (5, e[0], 1)]
    table = spark.createDataFrame([(i, [float(x) for x in v], lab) for i, v, lab in rows], "vec_id long, embedding array<double>, label int")
    for recall in (0.999, 1.0):
        got = sorted((r.vec_id, r.n_links, r.component_id) for r in hnsw_dedup.near_duplicates(table, recall=recall).collect())
        assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (4, 1, 4), (5, 0, 5)]


def test_places_of_rows_without_an_id_depend_on_the_rows_alone(spark):
    rows = [(None if k % 3 else k, f"s{k % 2}", f"text {k}") for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = [sorted((r.text, r.position) for r in mixing.mix(docs.repartition(n), block=4, resolution=20).collect()) for n in (1, 7)]
    assert out[0] == out[1]


def test_graphs_answer_where_near_copies_are_rare(monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1200, 24))
    x[1199] = x[3] + rng.normal(size=24) * .01               # one pair in all
    x /= np.sqrt((x * x).sum(1))[:, None]
    built, exact = [], []
    inside, search = hnsw_dedup.SmallWorld.__init__, hnsw_dedup.exact_search
    monkeypatch.setattr(hnsw_dedup.SmallWorld, "__init__", lambda self, *a: (built.append(len(a[0])), inside(self, *a))[1])
    monkeypatch.setattr(hnsw_dedup, "exact_search", lambda index, queries, radius: (exact.append(len(queries)), search(index, queries, radius))[1])
    got = list(hnsw_dedup.audited_search(x, x, .93, .999, same=True))
    assert built == [1200] and exact == [128]                # answers come from the graph, the audit is bounded
    true = [np.flatnonzero(r) for r in x @ x.T >= .93]
    found = sum(np.isin(t, g).sum() for t, g in zip(true, got))
    assert found >= .9 * sum(map(len, true)) and 3 in got[1199]
