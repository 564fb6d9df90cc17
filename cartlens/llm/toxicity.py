"""Toxicity: logistic word model with a counterfactual penalty on identity terms.

Labelled sentences that mention a group are copied with the term swapped for the other terms
of its kind; the squared change of the score between a sentence and its copies is added to the
loss.  A group's name then cannot carry blame that belongs to the words around it, so neutral
mentions of the group are not flagged.

The model is fitted on a sample of about ``sample_per_class`` labelled documents of each class
(the documented bound, so the sample fits the driver).  Scoring is one pass over all texts with
the few selected words broadcast; nothing is shuffled.

Defined results: a null or empty text has no words and gets the score of the intercept; labels
other than 0 and 1, labels of unknown documents and null labels teach nothing; a document with
repeated labels teaches once per label; with fewer than two classes every score is the share of
class 1 (0 without labels); repeated rows are scored alike; an empty table gives an empty table;
other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import held_out, texts_of, word_hashes

#: Identity terms that are swapped for one another, by kind.  A parameter of ``fit``.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("old", "young", "elderly"), ("disabled", "blind", "deaf"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)
_NOT_WORD = bytes(32 if not (chr(c).isalnum() or c >= 128) else c for c in range(256))
_SENTENCE = re.compile(r"[.!?\n]+")


def word_set(text: str | None) -> np.ndarray:
    """Hashes of the distinct lower-case words (ASCII punctuation separates)."""
    if not text:
        return np.empty(0, np.uint64)
    words = set(text.lower().encode("utf-8", "surrogatepass").translate(_NOT_WORD).split())
    return word_hashes(list(words))


def swapped_sentences(text: str | None, kind_of: dict[bytes, tuple[int, int]]) -> dict[tuple[int, int], int]:
    """How many sentences mention each identity term (kind, place in the kind)."""
    out: dict[tuple[int, int], int] = {}
    for s in _SENTENCE.split((text or "").lower()):
        for w in set(s.encode("utf-8", "surrogatepass").translate(_NOT_WORD).split()) & kind_of.keys():
            out[kind_of[w]] = out.get(kind_of[w], 0) + 1
    return out


def train(x: list[np.ndarray], y: np.ndarray, mentions: dict[tuple[int, int], int], terms=IDENTITY_TERMS,
          n_features: int = 400, min_z: float = 4.0, ridge: float = 0.06, counterfactual: float = 1.0, rounds: int = 400) -> dict:
    """Weights by word hash: logistic loss + ridge + counterfactual penalty, by Adam on all rows."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return {"words": np.empty(0, np.uint64), "weights": np.empty(0), "bias": share, "flat": True}
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    all_words, inverse = np.unique(np.concatenate([*x, np.empty(0, np.uint64)]), return_inverse=True)
    row = np.repeat(np.arange(len(x)), [len(w) for w in x])
    in1 = np.bincount(inverse, weights=y[row], minlength=len(all_words))
    seen = np.bincount(inverse, minlength=len(all_words))
    p1, p0, p = (in1 + 0.5) / (n1 + 1), (seen - in1 + 0.5) / (n0 + 1), (seen + 1) / (len(y) + 2)
    z = np.abs(p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    z[(seen < 2) | (z < min_z)] = 0          # words that either class could have by chance
    term_hash = {(k, i): word_hashes([t.encode()])[0] for k, kind in enumerate(terms) for i, t in enumerate(kind)}
    chosen = np.argsort(-z, kind="stable")[:n_features]
    chosen = np.sort(chosen[z[chosen] > 0])
    words = np.union1d(all_words[chosen], np.array(list(term_hash.values()), np.uint64))
    at = np.searchsorted(words, all_words)
    known = (at < len(words)) & (words[np.minimum(at, len(words) - 1)] == all_words)
    use = known[inverse]
    row, col = row[use], at[inverse[use]]
    # Each sentence with a term a is compared with its copies that have b instead: w_a - w_b.
    pair_a, pair_b, pair_n = [], [], []
    for (k, i), n in mentions.items():
        for j in range(len(terms[k])):
            if j != i:
                pair_a.append(np.searchsorted(words, term_hash[k, i]))
                pair_b.append(np.searchsorted(words, term_hash[k, j]))
                pair_n.append(n / (len(terms[k]) - 1))
    a, b, share = np.array(pair_a, int), np.array(pair_b, int), np.array(pair_n) / max(1, sum(mentions.values()))
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)       # both classes count alike
    w, bias, l2 = np.zeros(len(words) + 1), len(words), ridge / len(y)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        logit = np.bincount(row, weights=w[col], minlength=len(y)) + w[bias]
        err = weight * (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y)
        g = np.bincount(col, weights=err[row], minlength=len(w)) + l2 * w
        g[bias] = err.sum()
        if len(a):
            d = 2 * counterfactual * share * (w[a] - w[b])
            g += np.bincount(a, weights=d, minlength=len(w)) - np.bincount(b, weights=d, minlength=len(w))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return {"words": words, "weights": w[:-1], "bias": float(w[bias]), "flat": False}


def score_words(words: np.ndarray, model: dict) -> float:
    if model["flat"]:
        return model["bias"]
    known, total = model["words"], model["bias"]
    if len(words):
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        total += float(model["weights"][at[known[at] == words]].sum())
    return float(1 / (1 + np.exp(-min(40.0, max(-40.0, total)))))


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = 4000, terms=IDENTITY_TERMS, **options) -> dict:
    """Model of the labelled documents: docs (doc_id, text), labels (doc_id, toxic)."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    sizes = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col("toxic") == value, min(1.0, sample_per_class / n)).otherwise(share)
    sample = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20))
    kind_of = {t.encode(): (k, i) for k, kind in enumerate(terms) for i, t in enumerate(kind)}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, spoken = [], []
            for t in texts_of(batch, "text"):
                words.append(word_set(t).tobytes())
                spoken.append([x for (k, i), n in swapped_sentences(t, kind_of).items() for x in (k, i, n)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(words, pa.binary()),
                                              pa.array(spoken, pa.list_(pa.int64()))], names=["doc_id", "toxic", "words", "spoken"])

    # At most about 2 x sample_per_class rows of two numbers: safe to broadcast.
    got = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
           .mapInArrow(features, "doc_id long, toxic int, words binary, spoken array<long>")
           .orderBy("doc_id", "toxic").collect())
    mentions: dict[tuple[int, int], int] = {}
    for r in got:
        for k, i, n in zip(r.spoken[::3], r.spoken[1::3], r.spoken[2::3]):
            mentions[k, i] = mentions.get((k, i), 0) + n
    return train([np.frombuffer(r.words, np.uint64) for r in got], np.array([r.toxic for r in got], float),
                 mentions, terms, **options)


def predict(docs: DataFrame, model: dict, text: str = "text", threshold: float = 0.3,
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus score (0 to 1) and predicted (1 from the threshold up), which replace
    columns of their names."""
    keep = tuple(c for c in keep if c.lower() not in ("score", "predicted"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([score_words(word_set(t), sent.value) for t in texts_of(batch, "__text")], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep]
                                             + [pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=[*keep, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(label, f"{fields}, score double, predicted int")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = held_out(F.col("doc_id"))
    model = fit(docs, labels.where(~held))
    return predict(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")
