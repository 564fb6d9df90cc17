from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from cartlens.llm import spm_sampling as S

PIECES = S.load_pieces()
BYTES = S.piece_bytes()
TEXTS = ["hello world", "a\n\nthe 日本 \U00010348 x  y ", "x" * 60 + " é", " ", "\t\n", "é ﬁ", "word " * 3000, "y" * 3000]


@pytest.fixture(scope="module")
def lat():
    return S.Lattices(S.vocabulary(PIECES))


def _run(lat, text, key, k):
    words = np.array(lat.numbers(S._WORD.findall(S.normalise(text))), np.int64)
    lat.settle()
    return S.sample_paths(lat, [words], np.array([key], np.uint64), k)[0]


def test_distinct_ordered_and_lossless(lat):
    for text in TEXTS:
        t, kappa = _run(lat, text, 99, 4)
        ids = [S._ids(e) for *_, e in t.paths]
        assert len({i.tobytes() for i in ids}) == len(ids)
        assert all(S.decode_ids(i.tobytes(), BYTES) == text for i in ids)
        tops = [p[3] for p in t.paths]
        assert tops == sorted(tops, reverse=True) and (not t.regions or kappa <= tops[-1])


def _segmentations(word, of):
    if not word:
        yield (), 0.0
    for m in range(1, min(16, len(word)) + 1):
        if word[:m] in of:
            for rest, s in _segmentations(word[m:], of):
                yield (of[word[:m]][0], *rest), s + of[word[:m]][1]


def test_samples_follow_the_exact_distribution(lat):
    text, n = "the end", 4000
    every = list(_segmentations(S.normalise(text), S.vocabulary(PIECES)["of"]))
    total = np.logaddexp.reduce([s for _, s in every])
    p = {ids: math.exp(s - total) for ids, s in every}
    first, second, estimate = Counter(), Counter(), Counter()
    for key in S.mix64(np.arange(n, dtype=np.uint64)):
        t, kappa = _run(lat, text, key, 3)
        ids = [tuple(int(i) for i in S._ids(e)) for *_, e in t.paths]
        first[ids[0]] += 1
        second[ids[1]] += 1
        for i, path in zip(ids, t.paths):
            assert abs(path[2] - math.log(p[i])) < 1e-6
            estimate[i] += p[i] / -math.expm1(-math.exp(path[2] - kappa)) / n
    for i in sorted(p, key=p.get)[-4:]:
        expect = sum(p[j] * p[i] / (1 - p[j]) for j in p if j != i)      # drawn second, without replacement
        assert abs(first[i] / n - p[i]) < 0.03 and abs(second[i] / n - expect) < 0.03
        assert abs(estimate[i] - p[i]) < 0.02                            # inclusion scores undo the bias
    assert abs(sum(estimate.values()) - 1) < 0.05


def test_few_segmentations_are_all_found(lat):
    t, kappa = _run(lat, " ", 5, 9)
    assert len(t.paths) == 2 and kappa == -math.inf


def test_encode_and_decode_on_spark(spark):
    rows = [(i, t, "k") for i, t in enumerate(TEXTS)] + [(50, None, "n"), (51, "", "n"), (None, "a b", "z"), (0, TEXTS[0], "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens string")
    for parts in (1, 5):
        got = S.decode(S.encode(docs.repartition(parts), k=3, keep=("tokens",))).collect()
        mine = sorted((r.doc_id is None, r.doc_id or 0, r.sample, bytes(r.tokens), r.n_pieces, r.log_prob, r.inclusion) for r in got)
        if parts == 1:
            before = mine
    assert mine == before                                    # no dependence on partitions
    texts = {r[0]: r[1] or "" for r in rows}
    assert all(r.decoded == texts[r.doc_id] and 0 <= r.inclusion <= 1 for r in got)
    empty = [r for r in got if r.doc_id in (50, 51)]
    assert len(empty) == 2 and all(r.n_pieces == 0 and r.log_prob == 0 and r.inclusion == 1 for r in empty)
    assert S.encode(docs.limit(0)).count() == 0
