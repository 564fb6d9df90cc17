"""Both classifiers against the formulas in plain Python, with extra columns and repeated rows."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from cartlens.llm import langid, toxicity
from cartlens.llm.common import word_hashes


def _docs(rng, n=60):
    words = {"en": "the cat and dog house of them".split(), "fr": "le chat et chien maison des à".split(), "de": "der hund und katze haus für".split()}
    rows = []
    for k in range(n):
        lang = rng.choice(list(words))
        rows.append((k, " ".join(rng.choices(words[lang], k=rng.randrange(3, 30))), lang))
    return rows + rows[:5] + [(900, None, "en"), (901, "123 --", "fr"), (902, "Ünïted the", None), (903, "", "de")]


def _grams(text):
    """1- to 3-grams of letters and single spaces, a space at both ends (spaces alone do not count)."""
    s = " " + re.sub(r"[^\W\d_]", lambda m: m[0], "".join(c if c.isalpha() else " " for c in text.lower())).replace("  ", " ") + " "
    while "  " in s:
        s = s.replace("  ", " ")
    return [c for c in s if c != " "], [s[i:i + 2] for i in range(len(s) - 1)], [s[i:i + 3] for i in range(len(s) - 2)]


def test_every_gram_is_counted_once():
    for text in ("The Cat, and 2 dogs", "é", "a  b\n\nc", "x1y", "straße über"):
        one, two, three = _grams(text)
        assert langid.ngram_counts(text).sum() == len(one) + len(two) + len(three)
    assert langid.ngram_counts("12 _") is None and langid.ngram_counts(None) is None


def test_languages_equal_the_formula(spark):
    rows = _docs(random.Random(2))
    docs = spark.createDataFrame([(*r, 1.0, "x", True) for r in rows], "doc_id long, text string, lang string, score double, lang_pred string, rejected boolean")
    model = langid.fit(docs)
    # Document frequencies by plain counting; the query learns from all rows with a lang.
    df = np.zeros(langid.DIMS)
    known = [langid.ngram_counts(t) for _, t, lang in rows if lang is not None]
    for c in known:
        if c is not None:
            df += c > 0
    n = sum(c is not None for c in known)
    assert np.allclose(model["idf"], np.log((1 + n) / (1 + df)) + 1, atol=1e-5)
    got = langid.predict(docs, model, keep=tuple(docs.columns))
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"] and got.count() == len(rows)
    for r in got.collect():
        counts = langid.ngram_counts(r.text)
        if counts is None:
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        v = [math.log1p(c) * w for c, w in zip(counts.tolist(), model["idf"].tolist())]
        size = math.sqrt(sum(x * x for x in v))
        cosines = [sum(x * y for x, y in zip(v, c)) / size for c in model["centroids"].tolist()]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert r.score == pytest.approx(max(0.0, cosines[best]), abs=1e-5)
        assert cosines[model["langs"].index(r.lang_pred)] <= cosines[best] + 1e-6
        if min(abs(cosines[best] - c) for k, c in enumerate(cosines) if model["langs"][k] != model["langs"][best]) > 1e-5:
            assert r.lang_pred == model["langs"][best]
            assert abs(1 - cosines[best] - model["radius"][best]) < 1e-5 or r.rejected == (1 - cosines[best] > model["radius"][best])


def test_toxicity_equals_the_formula(spark):
    rng = random.Random(4)
    texts = [(k, " ".join(rng.choices("you are nice muslim women and old friends".split(), k=8) + (["vile", "scum"] if k % 3 == 0 else []))) for k in range(90)]
    texts += texts[:3] + [(200, None), (201, ""), (202, "VILE, scum!")]
    docs = spark.createDataFrame([(i, t, 5, 0.5) for i, t in texts], "doc_id long, text string, predicted int, score double")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(90)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    weight = dict(zip(model["words"].tolist(), model["weights"].tolist()))
    got = toxicity.predict(docs, model, keep=tuple(docs.columns))
    assert got.columns == ["doc_id", "text", "score", "predicted"] and got.count() == len(texts)
    for r in got.collect():
        words = set(re.findall(r"[a-z]+", (r.text or "").lower()))
        total = model["bias"] + sum(weight.get(int(word_hashes([w.encode()])[0]), 0.0) for w in words)
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9) and r.predicted == int(r.score >= .3)
    flags = {r.doc_id: r.predicted for r in got.collect()}
    assert all(flags[k] == int(k % 3 == 0) for k in range(90)) and flags[202] == 1
    # The penalty makes swapped identity terms nearly equal.
    of = lambda w: weight[int(word_hashes([w.encode()])[0])]
    assert abs(of("muslim") - of("christian")) < 0.05 and abs(of("women") - of("men")) < 0.05
