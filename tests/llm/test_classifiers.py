from __future__ import annotations

import random
import zlib

import numpy as np

from cartlens.llm import langid, toxicity

FORMS = {"xx": "ab ba aab bba abab", "yy": "cd dc ccd ddc cdcd", "zz": "éf fé éff ffé éfé"}


def _docs(n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = list(FORMS)[i % 3]
        rows.append((i, " ".join(rng.choices(FORMS[lang].split(), k=30)), lang if i % 10 else None))
    return rows


def test_language_of_every_text(spark):
    odd = [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 !?", "zz"), (1003, "AB, BA! " * 50_000, None),
           (1003, "AB, BA! " * 50_000, None), (None, "cd dc", None)]
    docs = spark.createDataFrame(_docs() + odd, "doc_id long, text string, lang string")
    got = langid.query(docs).collect()
    assert len(got) == 246
    by = {r.doc_id: r for r in got}
    for i, _, lang in _docs():
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert by[i].lang_pred == list(FORMS)[i % 3] and 0 <= by[i].score <= 1
    assert sum(by[i].rejected for i in range(240)) < 12
    for i in (1000, 1001, 1002):
        assert by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected
    assert by[1003].lang_pred == "xx" and by[None].lang_pred == "yy"


def test_language_without_labels_and_far_texts(spark):
    docs = spark.createDataFrame([(1, "ab ba", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.query(docs).collect()} == {"und"}
    assert langid.query(docs.limit(0)).count() == 0
    known = spark.createDataFrame(_docs(), "doc_id long, text string, lang string")
    far = spark.createDataFrame([(1, "жщ щж жж щщ")], "doc_id long, text string")
    row = langid.predict(far, langid.fit(known)).first()
    assert row.rejected and row.lang_pred in FORMS


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "abc déf " * 40
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "LONGEST", 64)
    assert np.abs(langid.ngram_counts(text) - whole).sum() <= 6 * (len(text) // 64 + 1)


def test_toxicity_finds_the_words_and_keeps_the_rest(spark):
    rng = random.Random(2)
    plain = [f"w{k}" for k in range(200)]
    docs, labels = [], []
    for i in range(400):
        words, bad = rng.choices(plain, k=40), i % 5 == 0
        if bad:
            words[rng.randrange(40)] = rng.choice(["nasty", "Vile!"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs += [(900, None), (901, ""), (902, "w1 " * 30_000 + "vile"), (None, "vile")]
    labels += [(5, 1, None), (None, 1, 1), (12345, 1, 1), (10, 1, 7)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.query(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == len(docs)
    missed = [i for i in range(0, 400, 5) if got[i].predicted == 0]
    assert len(missed) <= 4 and not any(got[i].predicted for i in range(400) if i % 5), missed
    assert got[900].score == got[901].score and got[900].predicted == 0
    assert got[902].predicted == 1 and got[None].predicted == 1


def test_toxicity_without_two_classes(spark):
    d = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.query(d, none).collect()} == {0.0}
    assert toxicity.query(d.limit(0), none).count() == 0


def test_counterfactual_penalty_spares_neutral_mentions():
    """Group names occur mostly in toxic sentences; swapped copies must not change the score."""
    rng = random.Random(5)
    texts, y = [], []
    for i in range(300):
        bad = i % 2
        group = rng.choice(["women", "men", "girls", "boys"])
        words = rng.choices([f"w{k}" for k in range(50)], k=10)
        if bad and rng.random() < 0.7 or not bad and rng.random() < 0.05:
            words.append("women" if bad else group)
        if bad and rng.random() < 0.8:
            words.append("awful")
        texts.append(" ".join(words) + ".")
        y.append(bad)
    kinds = toxicity.IDENTITY_TERMS
    kind_of = {t.encode(): (k, i) for k, kind in enumerate(kinds) for i, t in enumerate(kind)}
    mentions: dict = {}
    for t in texts:
        for at, n in toxicity.swapped_sentences(t, kind_of).items():
            mentions[at] = mentions.get(at, 0) + n
    x = [toxicity.word_set(t) for t in texts]
    gap = []
    for strength in (0.0, 5.0):
        m = toxicity.train(x, np.array(y, float), mentions, counterfactual=strength)
        score = lambda t: toxicity.score_words(toxicity.word_set(t), m)
        gap.append(abs(score("the women met today") - score("the men met today")))
        assert score("awful w1 w2") > 0.5
    assert gap[1] < 0.25 * gap[0]
