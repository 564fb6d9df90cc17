"""Periodic runs of words: descending-LCP Kruskal over the suffixes of each document.

A run is a stretch of consecutive words with smallest period q, at least ``min_exponent`` periods
and ``min_length`` words long, that no neighbouring word extends.

The suffixes of a block of whole documents are sorted by prefix doubling; suffixes that no other
one shares its first words with leave the rounds early, and the ranks of the rounds give the exact
longest common prefix (LCP) of neighbours.  Neighbouring suffixes are the edges of a path, which a
Kruskal pass takes by decreasing LCP: it unites the classes at both ends, each an ordered set of
places (the smaller is put into the larger).  Two places that become neighbours in a united set at
LCP l and stand d <= l words apart are an occurrence of period d that goes on for exactly d + l
words, and d is its smallest period: a smaller one would put a third place between the two.  The
pair whose left neighbours differ is the start of the run, so each run is found once.

Documents are independent: there is no shuffle, and memory is bounded by ``block_words`` or by the
longest text.  Defined results: a null or empty text has no words, no runs and an empty
collapsed text; repeated rows and rows without an id each give their row; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import WORD, split_words, texts_of

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_neighbours(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share ``least`` words or more, and how many they share.

    ``ids`` ends with a separator and every separator is a number of its own, so no shared
    stretch reaches beyond its document.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)

    def split(slots: np.ndarray, places: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Rank groups by their first slot; the slots of groups of two or more."""
        first = np.append(True, key[1:] != key[:-1])
        starts = np.flatnonzero(first)
        rank[places] = np.repeat(slots[starts], np.diff(np.append(starts, len(key))))
        return slots[~(first & np.append(first[1:], True))]

    slots = split(np.arange(n), order, ids[order])
    levels, h = [(1, rank.astype(np.int32))], 1
    while len(slots):
        places = order[slots]
        key = rank[places] * n + rank[places + h]
        by = np.argsort(key, kind="stable")
        places = places[by]
        order[slots] = places
        slots = split(slots, places, key[by])
        h *= 2
        levels.append((h, rank.astype(np.int32)))
    # Only neighbours that share the largest power of two up to ``least`` can share ``least``.
    shared = next((r for size, r in reversed(levels) if size <= least), levels[0][1])
    at = np.flatnonzero(shared[order[1:]] == shared[order[:-1]])
    a, b = order[at], order[at + 1]
    lcp = np.zeros(len(at), np.int64)
    for size, r in reversed(levels):
        same = r[np.minimum(a + lcp, n - 1)] == r[np.minimum(b + lcp, n - 1)]
        lcp[same] += size
    keep = lcp >= least
    return a[keep], b[keep], lcp[keep]


def kruskal_pairs(a: np.ndarray, b: np.ndarray, lcp: np.ndarray, exponent: int) -> list[tuple[int, int, int]]:
    """(place, distance, LCP) of places that become neighbours at ``distance <= LCP / (exponent - 1)``."""
    by = np.argsort(-lcp, kind="stable")
    home: dict[int, list[int]] = {}
    pairs: list[tuple[int, int, int]] = []
    for x, y, l in zip(a[by].tolist(), b[by].tolist(), lcp[by].tolist()):
        reach = l // (exponent - 1)
        large, small = home.get(x), home.get(y)
        if large is None:
            home[x] = large = [x]
        if small is None:
            home[y] = small = [y]
        if len(large) < len(small):
            large, small = small, large
        k, last, end = 0, -1, len(small) - 1
        for i, place in enumerate(small):
            k = bisect_left(large, place, k)
            # A neighbour that came from the small set too was its neighbour before.
            if k and large[k - 1] != last and place - large[k - 1] <= reach:
                pairs.append((large[k - 1], place - large[k - 1], l))
            if k < len(large) and (i == end or small[i + 1] > large[k]) and large[k] - place <= reach:
                pairs.append((place, large[k] - place, l))
            large.insert(k, place)
            home[place] = large
            last = place
    return pairs


def runs_of(words: list[list[bytes]], min_length: int = 6, min_exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each word list, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(sizes + 1) - sizes                # a separator stands before each document
    ids = np.empty(int(begin[-1] + sizes[-1]) + 1 if words else 1, np.int64)
    ids[-1] = top = 0
    for at, doc in zip(begin.tolist(), words):
        numbers: dict[bytes, int] = {}
        ids[at - 1] = top + 1
        ids[at:at + len(doc)] = [numbers.setdefault(w, len(numbers)) for w in doc]
        ids[at:at + len(doc)] += top + 2
        top += 1 + len(numbers)
    # Least LCP that the first two periods of a run can have.
    least = min(max(q * (min_exponent - 1), min_length - q) for q in range(1, min_length + 1))
    pairs = kruskal_pairs(*suffix_neighbours(ids, least), min_exponent)
    if not pairs:
        return out
    start, period, lcp = np.array(pairs, np.int64).T
    ok = (ids[start - 1] != ids[start - 1 + period]) & (period + lcp >= min_length)
    start, period, length = start[ok], period[ok], (period + lcp)[ok]
    doc = np.searchsorted(begin, start, "right") - 1
    by = np.lexsort((period, start))
    for d, s, l, p in zip(doc[by].tolist(), (start - begin[doc])[by].tolist(), length[by].tolist(), period[by].tolist()):
        out[d].append((s, l, p))
    return out


def _block(ids: list, words: list[list[bytes]], min_length: int, min_exponent: int) -> pa.RecordBatch:
    runs = runs_of(words, min_length, min_exponent)
    texts = []
    for doc, found in zip(words, runs):
        if found:
            keep = np.ones(len(doc), bool)
            for s, l, p in found:
                keep[s + p:s + l] = False
            doc = [doc[k] for k in np.flatnonzero(keep)]
        texts.append(b" ".join(doc).decode("utf-8", "replace"))
    flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
    ends = np.concatenate(([0], np.cumsum([len(found) for found in runs])))
    spans = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(d) for d in words], pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans), pa.array(texts, pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"])


def _blocks(batches: Iterator[pa.RecordBatch], min_length: int, min_exponent: int, block_words: int) -> Iterator[pa.RecordBatch]:
    ids: list = []
    words: list[list[bytes]] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
            ids.append(doc_id)
            words.append(split_words(text))
            held += len(words[-1]) + 16
            if held >= block_words:
                yield _block(ids, words, min_length, min_exponent)
                ids, words, held = [], [], 0
    if ids:
        yield _block(ids, words, min_length, min_exponent)


def find_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4, block_words: int = 1 << 18) -> DataFrame:
    """One row per document: n_words, its ``runs`` (by start, then period; places count words from
    0) and ``collapsed``, the words that no run has after its first period, joined by one space."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda it: _blocks(it, min_length, min_exponent, block_words), SCHEMA)


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """The contract's test input: in a tenth of the documents (crc32 of the id) the words from a
    place on repeat with a period; the rest, and rows without an id or a word, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    tenth = docs.withColumn("__g", F.when(h % 10 == 0, F.floor(h / 10)))
    g, n = F.col("__g"), F.size("__w")
    a = (g % n).cast("int")
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
    text = F.array_join(F.transform("__w", lambda w, i: F.when(i < a, w).otherwise(F.get("__w", a + F.pmod(i - a, p)))), " ")
    return (tenth.withColumn("__w", F.when(g.isNotNull(), words))
            .withColumn("text", F.when(g.isNotNull() & (n > 0), text).otherwise(F.col("text")))
            .drop("__g", "__w"))


def query(docs: DataFrame) -> DataFrame:
    """Runs of all documents with planted tails: counts, the longest run and digests."""
    found = find_runs(with_planted_tails(docs.select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
                    F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                    F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
