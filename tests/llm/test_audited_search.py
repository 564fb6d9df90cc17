from __future__ import annotations

import itertools

import numpy as np
import pytest

from cartlens.llm import hnsw_dedup


def _unit(x):
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _near(x, rng, by=0.005):
    return _unit(x + rng.normal(size=x.shape) * by)


def _same(got, index, queries, radius):
    return [sorted(g.tolist()) for g in got] == [np.flatnonzero(r).tolist() for r in queries @ index.T >= radius]


def test_audit_without_evidence_does_not_pass(monkeypatch):
    rng = np.random.default_rng(1)
    index, queries = _unit(rng.normal(size=(1500, 32))), _unit(rng.normal(size=(1500, 32)))
    queries[[7, 700, 1301]] = _near(index[[3, 900, 1400]], rng)      # three pairs across two shards
    monkeypatch.setattr(hnsw_dedup.SmallWorld, "within", lambda *a: np.empty(0, np.int64))
    assert _same(hnsw_dedup.audited_search(index, queries, 0.93, 0.999), index, queries, 0.93)


def test_crowd_does_not_outweigh_small_groups(monkeypatch):
    rng = np.random.default_rng(2)
    index = np.concatenate((_near(np.repeat(_unit(rng.normal(size=(1, 32))), 900, axis=0), rng), _unit(rng.normal(size=(300, 32)))))
    queries = _near(index, rng)
    crowd = lambda self, q, radius, ef: np.flatnonzero((self.x @ q >= radius) & (np.arange(1200) < 900))
    monkeypatch.setattr(hnsw_dedup.SmallWorld, "within", crowd)
    assert _same(hnsw_dedup.audited_search(index, queries, 0.93, 0.999), index, queries, 0.93)


def test_vector_without_incoming_links_is_found():
    rng = np.random.default_rng(3)
    graph = hnsw_dedup.SmallWorld(_unit(rng.normal(size=(300, 16))))
    for j in (i for i in range(300) if graph.level[i] == 0 and i != graph.entry):
        held = dict(graph.links[0])
        graph.links[0].update({i: a[a != j] for i, a in held.items()})
        assert j in graph.within(graph.x[j], 0.99, 600)
        graph.links[0].update(held)


@pytest.mark.parametrize("shard", [16384, 30])
def test_recall_of_one_is_exact(spark, shard):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=12) + rng.normal(size=(n, 12)) * 0.2 for n in (1,) * 60 + (2, 3, 20, 50)])
    rows = [(i, [float(a) for a in v], i % 2) for i, v in enumerate(x)]
    links, unit = [0] * len(x), _unit(x)
    for i, j in itertools.combinations(range(len(x)), 2):
        if i % 2 == j % 2 and unit[i] @ unit[j] >= 0.93:
            links[i] += 1
            links[j] += 1
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hnsw_dedup.near_duplicates(table, recall=1.0, shard_rows=shard).collect()
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate(links)) and any(links)
