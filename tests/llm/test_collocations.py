from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from cartlens.llm import collocations as C

AZ = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _want(rows, max_words, min_count, top, cover=80):
    """Brute force of the contract."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(AZ)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(len(words)):
                for size in range(1, max_words + 1):
                    if k + size <= len(words):
                        f[lang, tuple(words[k:k + size])] += 1
    cands = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    longest = Counter()
    for (lang, words), a in cands.items():
        for size in range(2, len(words)):
            for k in range(len(words) - size + 1):
                key = (lang, words[k:k + size])
                longest[key] = max(longest[key], a)
    out = []
    for lang in sorted(n):
        mine = []
        for (x, words), a in cands.items():
            if x != lang or 100 * longest[x, words] >= cover * a:
                continue
            score, k = min((2000000 * a // (f[x, words[:k]] + f[x, words[k:]]), k) for k in range(1, len(words)))
            mine.append((-score, -a, " ".join(words).encode(), f[x, words[:k]], f[x, words[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def _rows(rng, n=120):
    rows = [("en", None), (None, "x y z x y"), ("en", ""), ("fr", " \t.\n"), ("en", "A É a é İ\x1cb a b"), ("und", "x y")]
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None])
        words = rng.choices(["the", "The", "cat", "sat", "née", "on", "mat", "\U00010348", "a-b"], weights=[9, 3, 4, 4, 2, 3, 2, 1, 1],
                            k=rng.randrange(1, 80))
        rows.append((lang, "".join(w + rng.choice([" ", " ", " ", "\t ", ", ", ". ", "\r\n", "!"]) for w in words)))
    return rows + rows[20:40]


def test_phrases_equal_brute_force(spark):
    rows = _rows(random.Random(1))
    docs = spark.createDataFrame([(lang, t, 1, "p") for lang, t in rows], "lang string, text string, n int, phrase string").repartition(3)
    for max_words, least, top, block in ((4, 5, 2000, 1 << 21), (4, 30, 7, 200), (2, 1, 50, 500), (6, 3, 400, 3000)):
        got = [tuple(r) for r in C.collocations(docs, max_words, least, top=top, block_words=block).collect()]
        want = _want(rows, max_words, least, top)
        assert sorted(got) == sorted(want) and len(want) > 5, (max_words, least)
    assert C.query(docs.limit(0)).count() == 0
    assert C.query(docs.limit(3)).count() == 0


def test_hot_phrase_over_many_partitions(spark):
    rows = [("en", "new york city is new york") for _ in range(400)] + [("en", f"new w{k} york") for k in range(40)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    got = [tuple(r) for r in C.collocations(docs, block_words=64).collect()]
    assert sorted(got) == sorted(_want(rows, 4, 30, 2000))


def test_dense_and_sparse_tiles_agree():
    rng = np.random.default_rng(0)
    left, right = (np.minimum(rng.geometric(.02, 40_000) - 1, 3000).astype(np.int64) for _ in range(2))
    want = Counter(zip(left.tolist(), right.tolist()))
    for tile, dense in ((8, 1), (64, 500), (512, 10**9), (512, 1)):
        i, j, n, number = C.count_pairs(left, right, tile, dense)
        assert dict(zip(zip(i.tolist(), j.tolist()), n.tolist())) == dict(want) and len(i) == len(want)
        assert (i[number] == left).all() and (j[number] == right).all()
    assert [len(x) for x in C.count_pairs(left[:0], right[:0])] == [0, 0, 0, 0]


def test_scores_beyond_64_bits(spark):
    a = 4_000_000_000_000_007
    one = spark.createDataFrame([(a, [a + 1, a], [a + 2, a])], "f long, before array<long>, after array<long>")
    got = one.select(C._score(2).alias("s")).first().s
    assert (got.score, got.k, got.l, got.r) == (2000000 * a // (2 * a + 3), 1, a + 1, a + 2)
