from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest

from cartlens.llm import fm_dedup, hnsw_dedup, ngram_join


def _near_copies(seed=0):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(70)]
    rows = []
    for i in range(60):
        rows.append([word() for _ in range(rng.randrange(3, 160))])
    for i in range(40):                                # one crowded group of near copies
        base = rows[50][:] if len(rows[50]) > 60 else [word() for _ in range(120)]
        if i == 0:
            rows[50] = base
        copy = base[:]
        for _ in range(rng.randrange(0, 5)):
            copy[rng.randrange(len(copy))] = word()
        rows.append(copy[: len(copy) - rng.randrange(0, 12)])
    for i in range(30):                                # a passage that many texts quote
        own = [word() for _ in range(rng.randrange(0, 120))]
        rows.append(own + passage)
    rows += [rows[3][:], rows[3][:], [], ["solo"], ["solo"], ["A", "b", "C", "d"], ["a", "B", "c", "D"]]
    return [(i * 3 % 997, " ".join(r)) for i, r in enumerate(rows)] + [(5000, None), (5001, " \n")]


def _exact(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x, y in itertools.combinations(sets, 2):
        both = len(sets[x] & sets[y])
        if both and 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
            a, b = root(x), root(y)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("hubs,crowded,block", [(0, 32, 512), (1, 3, 7), (3, 32, 512)])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, hubs, crowded, block):
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    monkeypatch.setattr(ngram_join, "ROWS", block)
    monkeypatch.setattr(ngram_join, "COLUMNS", 64 if block < 512 else 4096)
    rows = _near_copies()
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, hub_rounds=hubs).collect()}
    want = _exact(rows)
    assert got == want and len({c for _, c in want.values()}) < len(rows) - 30


def test_jaccard_of_nothing(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, None)], "doc_id long, text string")
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.query(docs).collect()} == {(1, 0, 1), (None, 2, None)}
    assert ngram_join.query(docs.limit(0)).count() == 0


def test_overlap_gives_up_only_when_the_bound_is_out_of_reach():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 2**64, rng.integers(1, 60), dtype=np.uint64)) for _ in range(2))
        y = np.unique(np.concatenate((y, x[: rng.integers(0, len(x) + 1)])))
        both, need = len(np.intersect1d(x, y)), int(rng.integers(0, 40))
        got = ngram_join.overlap(x, y, need)
        assert got == both if both >= need else got < need


def test_window_owners_equal_brute_force():
    rng = random.Random(3)
    for width in (1, 2, 3, 5, 8):
        runs = [np.array([rng.randrange(1, 5) for _ in range(rng.randrange(width, width + 14))]) for _ in range(40)]
        owner = np.array([rng.randrange(100) for _ in runs])
        least: dict = {}
        for r, o in zip(runs, owner):
            for k in range(len(r) - width + 1):
                w = tuple(r[k:k + width])
                least[w] = min(least.get(w, 10**9), o)
        got = fm_dedup.least_owner_of_windows(runs, owner, width, 5)
        for r, g in zip(runs, got):
            assert g.tolist() == [least[tuple(r[k:k + width])] for k in range(len(r) - width + 1)]


def test_wavelet_tree_ranks():
    rng = np.random.default_rng(2)
    seq = rng.integers(0, 37, 500)
    tree = fm_dedup.WaveletTree(seq, 37)
    for c in range(37):
        at = np.arange(501)
        assert tree.rank(np.full(501, c), at).tolist() == [0, *np.cumsum(seq == c).tolist()]


def test_minimizer_runs_cover_every_window_once(monkeypatch):
    h = fm_dedup.word_hashes([f"w{k % 41}".encode() for k in range(700)])
    for piece in (1 << 20, 50):
        monkeypatch.setattr(fm_dedup, "PIECE", piece)
        first, end, key = fm_dedup.minimizer_runs(h, 12, 4)
        assert [x for a, b in zip(first, end) for x in range(a, b)] == list(range(len(h) - 11))
        by: dict = {}
        for a, b, k in zip(first, end, key):
            for x in range(a, b):
                assert by.setdefault(h[x:x + 12].tobytes(), k) == k       # equal windows, equal minimizer


def _cut(rows, width):
    seen, out = {}, {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        for k in range(len(w) - width + 1):
            seen.setdefault(tuple(w[k:k + width]), i)
    for i, t in rows:
        w = (t or "").encode().split()
        keep = [True] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and seen[tuple(w[k:k + width])] < i:
                keep[k:k + width] = [False] * width
        kept = [x for x, z in zip(w, keep) if z]
        out.setdefault((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()), []).append(i)
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [1, 20_000])
def test_removed_windows_equal_brute_force(spark, hot):
    rng = random.Random(8)
    rows = _near_copies(4) + [(None, "x " * 60), (7000, "same " * 80), (7001, "same " * 90 + "é ü " * 20), (7001, "same " * 90)]
    rows += [(8000 + k, " ".join(rng.choices("ab", k=40))) for k in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (6, 20):
        got = fm_dedup.remove_repeats(docs, width=width, shard_runs=100, hot_docs=hot).collect()
        assert len(got) == len(rows)
        assert sorted({(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got}, key=str) == _cut(rows, width)
        assert all(r.kept_text is None or hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)
    assert fm_dedup.query(docs.limit(0)).count() == 0


def _vectors():
    rng = np.random.default_rng(6)
    rows, n = [], 0
    for label in (0, 1):
        for size in (1,) * 40 + (2, 5, 30, 60):
            centre = rng.normal(size=16)
            for _ in range(size):
                x = centre + rng.normal(size=16) * 0.05
                for _ in range(rng.integers(1, 4) if size == 5 else 1):
                    rows.append((n, [float(np.float32(v)) for v in x], label))
                    n += 1
    odd = [([0.0] * 16, 0), ([], 0), (None, 0), ([float("nan")] * 16, 0), ([float("inf")] + [1.0] * 15, 1),
           ([None] + [1.0] * 15, 1), (rows[0][1], None), ([2 * v for v in rows[0][1]], 0), (rows[0][1][:8], 0)]
    return rows + [(n + k, v, lab) for k, (v, lab) in enumerate(odd)]


@pytest.mark.parametrize("shard", [16384, 40])
def test_embedding_links_equal_brute_force(spark, shard):
    rows = _vectors()
    fine = [(i, np.array(v, float), lab) for i, v, lab in rows if v and lab is not None and None not in v
            and np.isfinite(v).all() and any(v)]
    links, parent = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (i, x, a), (j, y, b) in itertools.combinations(fine, 2):
        if a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
            links[i] += 1
            links[j] += 1
            p, q = root(i), root(j)
            parent[max(p, q)] = min(p, q)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = hnsw_dedup.near_duplicates(table, recall=1.0, shard_rows=shard).collect()
    assert len(got) == len(rows)
    want = {i: (links[i], root(i), root(i) == i) for i in links}
    assert [i for i, r in ((r.vec_id, r) for r in got) if (r.n_links, r.component_id, r.kept) != want[i]] == []
    assert hnsw_dedup.query(table.limit(0)).count() == 0
