"""Language identification by the nearest clustered centroid of TF-IDF character n-grams.

A text becomes the counts of its hashed 1- to 3-grams of letters (other characters are one
space), damped, weighted by inverse document frequency and scaled to length 1.  Each language
has several centroids, found by spherical k-means; a text goes to the language of the centroid
with the largest cosine and is marked rejected when it lies farther from that centroid than
the texts the centroid was made of.

Document frequencies cover every labelled row.  The centroids are fitted on a sample of about
``sample_per_lang`` rows of each language (the documented bound).  Scoring is one pass over the
texts without a shuffle; only the model (languages x clusters x DIMS floats) is broadcast.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected;
without any labelled row every text is ``und``; rows with a null label teach nothing; repeated
rows are scored alike; a tie goes to the first centroid in the order of (language, cluster);
an empty table gives an empty table; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import held_out, texts_of

DIMS = 1 << 14
LONGEST = 1 << 20        # characters handled at once; longer texts are counted piece by piece
UNKNOWN = "und"
MOST_LANGS = 10_000


LETTERS = np.array([chr(c).isalpha() for c in range(0x110000)])


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed 1- to 3-grams; None if there is no letter."""
    if not text:
        return None
    counts, seen = np.zeros(DIMS, np.int64), False
    for at in range(0, len(text), LONGEST):
        a = np.frombuffer(text[at:at + LONGEST].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = LETTERS[a]
        if not letter.any():
            continue
        seen = True
        a = np.where(letter, a, np.uint32(32))
        a = a[np.append(True, letter[1:] | letter[:-1])]
        a = np.concatenate(([np.uint32(32)], a, [np.uint32(32)]))
        h = a * np.uint32(0x9E3779B1)
        counts += np.bincount(h[a != 32] >> np.uint32(18), minlength=DIMS)
        for _ in range(2):
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + a[len(a) - len(h) + 1:] * np.uint32(0xC2B2AE3D)
            counts += np.bincount((h * np.uint32(0x9E3779B1)) >> np.uint32(18), minlength=DIMS)
    return counts if seen else None


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts.astype(np.float32)) * idf
    return v / max(float(np.sqrt(v @ v)), 1e-12)


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the texts each n-gram bucket occurs, and how many texts have a letter."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for text in texts_of(batch, "text"):
                if (c := ngram_counts(text)) is not None:
                    df += c > 0
                    n += 1
        yield pa.RecordBatch.from_pydict({"bucket": np.arange(DIMS + 1), "df": np.append(df, n)})

    total = (rows.select("text").mapInArrow(count, "bucket long, df long")
             .groupBy("bucket").agg(F.sum("df").alias("df")).toArrow())
    out = np.zeros(DIMS + 1, np.int64)
    out[total.column("bucket").to_numpy()] = total.column("df").to_numpy()
    return out[:-1], int(out[-1])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and each row's cluster; starts from rows far from one another."""
    mean = x.mean(axis=0)
    c = [x[int(np.argmax(x @ mean))]]
    while len(c) < min(k, len(x)):
        c.append(x[int(np.argmin(np.max(x @ np.array(c).T, axis=1)))])
    c = np.array(c)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].sum(axis=0)
                c[j] = m / max(float(np.linalg.norm(m)), 1e-12)
    return c, np.argmax(x @ c.T, axis=1)


def fit(rows: DataFrame, clusters: int = 3, sample_per_lang: int = 400, slack: float = 1.25) -> dict:
    """Model of the labelled ``rows`` (doc_id, text, lang)."""
    rows = rows.where("lang IS NOT NULL")
    df, n = document_frequencies(rows)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    sizes = rows.sparkSession.createDataFrame(sizes, "lang string, n long")
    share = F.least(F.lit(1.0), F.lit(float(sample_per_lang)) / F.col("n"))
    sample = (rows.join(F.broadcast(sizes), "lang")                # at most MOST_LANGS short rows
              .where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < share * (1 << 20))
              .select("lang", "text"))

    def centroids(group: pa.Table) -> pa.Table:
        x = [vector(c, idf) for t in group.column("text") if (c := ngram_counts(t.as_py())) is not None]
        lang = group.column("lang")[0].as_py()
        if not x:
            c, far = np.empty((0, DIMS), np.float32), []
        else:
            x = np.array(x)
            c, own = spherical_kmeans(x, clusters)
            near = x @ c.T
            far = [float(1 - near[own == j, j].min()) if (own == j).any() else 0.0 for j in range(len(c))]
        return pa.table({"lang": pa.array([lang] * len(c), pa.string()), "cluster": pa.array(range(len(c)), pa.int32()),
                         "radius": pa.array(far, pa.float64()),
                         "centroid": pa.array([row.astype(np.float32).tobytes() for row in c], pa.binary())})

    got = (sample.groupBy("lang").applyInArrow(centroids, "lang string, cluster int, radius double, centroid binary")
           .orderBy("lang", "cluster").collect())
    return {"idf": idf, "langs": [r.lang for r in got], "radius": np.array([r.radius * slack for r in got]),
            "centroids": np.array([np.frombuffer(r.centroid, np.float32) for r in got]).reshape(len(got), DIMS)}


def predict(docs: DataFrame, model: dict, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus lang_pred, score (cosine, 0 to 1) and rejected, which replace columns of
    their names."""
    keep = tuple(c for c in keep if c.lower() not in ("lang_pred", "score", "rejected"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            langs, scores, rejected = [], [], []
            for t in texts_of(batch, "__text"):
                counts = ngram_counts(t) if m["langs"] else None
                if counts is None:
                    langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                near = m["centroids"] @ vector(counts, m["idf"])
                best = int(np.argmax(near))
                langs.append(m["langs"][best])
                scores.append(float(min(1.0, max(0.0, near[best]))))
                rejected.append(bool(1 - near[best] > m["radius"][best]))
            cols = [batch.column(c) for c in keep] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                                      pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "lang_pred", "score", "rejected"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(
        label, f"{fields}, lang_pred string, score double, rejected boolean")


def query(docs: DataFrame) -> DataFrame:
    held = held_out(F.col("doc_id"))
    model = fit(docs.where(~held).select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
