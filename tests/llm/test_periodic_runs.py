from __future__ import annotations

import hashlib
import random
import re
import zlib

from cartlens.llm import periodic_runs


def _runs(words, min_length=6, min_exponent=4):
    """Brute force: maximal stretches of every period, smallest period only."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i:j + q]
            smallest = next(p for p in range(1, q + 1) if stretch[p:] == stretch[:-p])
            if smallest == q and len(stretch) >= max(min_length, min_exponent * q):
                out.append((i, len(stretch), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def _planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def _texts(rng):
    texts = [None, "", " \n ", "a", "a " * 7, "a " * 5, "a b " * 4, "x " + "a b c " * 4 + "a b y", "é x " * 9]
    for _ in range(150):
        words = rng.choices("abcde"[:rng.randrange(1, 6)], k=rng.randrange(1, 60))
        for _ in range(rng.randrange(3)):
            k, q = rng.randrange(len(words)), rng.randrange(1, 6)
            words[k:k] = (words[k:k + q] or ["z"]) * rng.randrange(2, 9)
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(words))
    return texts


def test_runs_equal_brute_force():
    rng = random.Random(3)
    docs = [(t or "").encode().split() for t in _texts(rng)]
    for length, exponent in ((6, 4), (2, 2), (4, 2), (5, 3), (9, 4)):
        got = periodic_runs.runs_of(docs, length, exponent)
        assert got == [_runs(d, length, exponent) for d in docs], (length, exponent)
    assert periodic_runs.runs_of([]) == []


def test_fibonacci_words_and_a_long_text():
    a, b = ["x"], ["x", "y"]
    while len(b) < 400:
        a, b = b, b + a
    words = [w.encode() for w in b]
    assert periodic_runs.runs_of([words], 2, 2) == [_runs(words, 2, 2)]
    long = [b"w"] * 50_000 + [b"end"]
    assert periodic_runs.runs_of([long, [b"w"] * 6]) == [[(0, 50_000, 1)], [(0, 6, 1)]]


def test_query_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i if i % 17 else None, t, i) for i, t in enumerate(_texts(rng) * 4)]
    rows += [(7, "p q r s " * 6, 1), (7, "p q r s " * 6, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    want = []
    for doc_id, text, _ in rows:
        words = _planted(doc_id, text)
        found = _runs(words)
        gone = {k for s, l, p in found for k in range(s + p, s + l)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        want.append((doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
                     hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
                     hashlib.sha256(kept.encode()).hexdigest()))
    got = [tuple(r) for r in periodic_runs.query(docs).collect()]
    order = lambda rows: sorted(rows, key=str)
    assert order(got) == order(want)
    assert any(r[1] for r in got) and periodic_runs.query(docs.limit(0)).count() == 0


def test_small_blocks_give_the_same(spark):
    rows = [(i, t) for i, t in enumerate(_texts(random.Random(6)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    small, large = (sorted(map(str, periodic_runs.find_runs(docs, block_words=n).collect())) for n in (20, 1 << 18))
    assert small == large
