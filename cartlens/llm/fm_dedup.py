"""Substring dedup with a compressed FM-index per shard.

A window is ``width`` consecutive words.  Each window belongs to its minimizer (the least hash
of its short word runs); equal windows have equal minimizers.  Consecutive windows with the same
minimizer occurrence form one run of words, and runs meet in the shard of their minimizer, so
equal windows always meet and each shard gets a bounded share of the corpus.  Only runs whose
minimizer occurs in two documents or more are sent (a bounded bitmap tells; its false positives
cost shuffle, not correctness).

A shard holds its distinct runs in one FM-index: the Burrows-Wheeler transform of their words in
a wavelet tree of bit vectors with sampled ranks.  All runs are streamed through it together,
right to left, one backward-search step a word; the interval is cut back to width - 1 words
before each step, so after it stands the interval of the window that starts there, and the
smallest document of that interval is looked up.  Words are compared as text, not by hash.

Runs of a minimizer that over ``hot_docs`` documents have go window by window to shards picked
by the window's own hash, so a hot passage is spread however many documents quote it.

Defined results: a null text has no words (kept text empty); texts shorter than a window keep
all; rows without an id are no place of occurrence and stay whole; rows that share a doc_id count
as one place of occurrence (no smaller id), each text is cut on its own; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import key_filter, passes, shared_ids, split_words, staged, texts_of, window_hashes, word_hashes

PIECE = 1 << 20           # windows handled at once in a very long text
SAMPLE = 8                # words of the short runs that minimizers are chosen from


def minimizer_runs(hashes: np.ndarray, width: int, short: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimizer: first window, end (exclusive) and the minimizer's hash."""
    short = min(short, width)
    first, end, key = [], [], []
    n = len(hashes) - width + 1
    for at in range(0, n, PIECE):
        h = window_hashes(hashes[at:at + PIECE + width - 1], short)
        span = width - short + 1
        low = (h & ~np.uint64((1 << 21) - 1)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size < span:                          # sliding minimum by doubling
            step = min(size, span - size)
            low = np.minimum(low[:-step], low[step:])
            size += step
        place = (low & np.uint64((1 << 21) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        first.append(at + cut)
        end.append(at + np.append(cut[1:], len(place)))
        key.append(h[place[cut]])
    if not first:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(first), np.concatenate(end), np.concatenate(key)


class BitRank:
    """Bit vector in 64-bit words with the rank of each word's start."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words))[:-1])).astype(np.int64)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Number of set bits before each place."""
        w = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletTree:
    """Rank of symbols in a sequence, one bit vector a level (most significant bit first)."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        self.bits = max(1, int(symbols - 1).bit_length())
        order = seq
        for b in range(self.bits - 1, -1, -1):
            bit = ((order >> b) & 1).astype(bool)
            self.levels.append(BitRank(bit))
            self.zeros.append(int((~bit).sum()))
            order = np.concatenate((order[~bit], order[bit]))
        # Where each symbol's block begins once all bits are dealt.
        self.first = self._descend(np.zeros(symbols, np.int64), np.arange(symbols))

    def _descend(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for k, level in enumerate(self.levels):
            ones = level.ones(at)
            bit = (symbol >> (self.bits - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(at, symbol) - self.first[symbol]


class FMIndex:
    """FM-index of word runs (arrays of word numbers from 1): suffix order, LF steps, match groups."""

    def __init__(self, runs: list[np.ndarray], owner: np.ndarray, symbols: int):
        text = np.concatenate([np.append(r, 0) for r in runs])
        n = len(text)
        self.run_of = np.repeat(np.arange(len(runs)), [len(r) + 1 for r in runs])
        # Suffix order by prefix doubling; each run's end mark is a symbol of its own.
        rank = text.astype(np.int64) + len(runs)
        rank[text == 0] = np.arange(len(runs))
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        self.by_length = {1: rank}
        size = 1
        while rank.max() < n - 1:
            nxt = np.zeros(n, np.int64)
            nxt[:-size] = rank[size:] + 1
            key = rank * (n + 1) + nxt
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(0, key[order][1:] != key[order][:-1]))
            size *= 2
            self.by_length[size] = rank
        self.sa = np.empty(n, np.int64)
        self.sa[rank] = np.arange(n)
        self.tree = WaveletTree(text[self.sa - 1], symbols)            # the transform
        self.start = np.searchsorted(text[self.sa], np.arange(symbols + 1))
        self.owner = owner[self.run_of[self.sa]]

    def groups(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Group of each suffix (equal first ``length`` words) and the starts of the groups."""
        half = max(s for s in self.by_length if s <= length)
        rank, n = self.by_length[half], len(self.sa)
        a, b = self.sa[:-1], self.sa[1:]
        shift = length - half
        same = (rank[a] == rank[b]) & (rank[np.minimum(a + shift, n - 1)] == rank[np.minimum(b + shift, n - 1)])
        new = np.append(True, ~same)
        return np.cumsum(new) - 1, np.append(np.flatnonzero(new), n)

    def extend(self, lo: np.ndarray, hi: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of the patterns with one word put before them."""
        base = self.start[word]
        return base + self.tree.rank(word, lo), base + self.tree.rank(word, hi)


def least_owner_of_windows(runs: list[np.ndarray], owner: np.ndarray, width: int, symbols: int) -> list[np.ndarray]:
    """For every window of every run the smallest owner among the runs that hold that window."""
    index = FMIndex(runs, owner, symbols)
    group, bounds = index.groups(width)
    least = np.minimum.reduceat(index.owner, bounds[:-1])
    shorter, short_bounds = index.groups(width - 1) if width > 1 else (np.zeros(len(index.sa), np.int64), np.array([0, len(index.sa)]))
    lengths = np.array([len(r) for r in runs])
    order = np.argsort(-lengths, kind="stable")            # the longest first: the active ones are a prefix
    longest = int(lengths[order[0]])
    words = np.zeros((len(runs), longest), np.int64)       # words[k, t]: t-th word from the right
    for k, o in enumerate(order):
        words[k, :lengths[o]] = runs[o][::-1]
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    lo, hi = np.zeros(len(runs), np.int64), np.full(len(runs), len(index.sa))
    out = np.zeros((len(runs), longest), np.int64)
    for t in range(longest):
        k = active[t]
        if t >= width:                                     # keep width - 1 words, then add one
            g = shorter[lo[:k]]
            lo[:k], hi[:k] = short_bounds[g], short_bounds[g + 1]
        lo[:k], hi[:k] = index.extend(lo[:k], hi[:k], words[:k, t])
        if t >= width - 1:
            out[:k, t] = least[group[lo[:k]]]
    result: list[np.ndarray] = [np.empty(0, np.int64)] * len(runs)
    for k, o in enumerate(order):
        result[o] = out[k, width - 1:lengths[o]][::-1]
    return result


def _scan(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        found = [np.unique(minimizer_runs(word_hashes(split_words(t)), width)[2]) for t in texts_of(batch, "text")]
        yield pa.RecordBatch.from_pydict({"mini": np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64),
                                          "doc_id": np.repeat(ids, [len(f) for f in found])})


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _split(batches: Iterator[pa.RecordBatch], width: int, shared: np.ndarray, hot: np.ndarray, apart: bool) -> Iterator[pa.RecordBatch]:
    """Kind 0: a document (done if it has no shared run); kind 1: a run of it; kind 2: a window
    of a hot minimizer's run.  A run's words come once a task, copies have its hash only.
    ``th`` tells texts ``apart`` that share an id; it is 0 where ids are unique."""
    names = ["kind", "doc_id", "th", "mini", "start", "n_words", "body", "sha"]
    types = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    sent: set[bytes] = set()

    def run(kind: int, doc: int, th: int, mini: int, start: int, body: bytes) -> tuple:
        sha = xxhash.xxh128_digest(body)
        known = sha in sent
        if not known:
            if len(sent) > 2_000_000:
                sent.clear()
            sent.add(sha)
        return kind, doc, th, mini, start, None, None if known else body, sha

    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        rows: list[tuple] = []
        for doc, text in zip(ids.tolist(), texts_of(batch, "text")):
            words = split_words(text)
            th = xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63) if apart else 0
            first, end, mini = minimizer_runs(word_hashes(words), width)
            mini = mini.view(np.int64)
            use = np.flatnonzero(passes(shared, mini)) if len(mini) else []
            for k, many in zip(use, passes(hot, mini[use]) if len(use) else ()):
                if many:
                    rows += [run(2, doc, th, int(mini[k]), j, b" ".join(words[j:j + width])) for j in range(int(first[k]), int(end[k]))]
                else:
                    rows.append(run(1, doc, th, int(mini[k]), int(first[k]), b" ".join(words[first[k]:end[k] + width - 1])))
            rows.append((0, doc, th, None, None, len(words), b" ".join(words) if len(use) else None,
                         None if len(use) else _sha(words).encode()))
            if len(rows) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _shard(group: pa.Table, width: int) -> pa.Table:
    """Stretches of each distinct run's windows with the smallest document that has them."""
    numbers: dict[bytes, int] = {}
    runs = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in body.as_py().split(b" ")], np.int64)
            for body in group.column("body")]
    owner = group.column("doc").to_numpy()
    least = least_owner_of_windows(runs, owner, width, len(numbers) + 1)
    which, lo, hi, doc = [], [], [], []
    for k, x in enumerate(least):
        cut = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        which.append(np.full(len(cut), k))
        lo.append(cut)
        hi.append(np.append(cut[1:], len(x)))
        doc.append(x[cut])
    which = np.concatenate(which)
    return pa.table({"sha": group.column("sha").take(pa.array(which)), "lo": np.concatenate(lo).astype(np.int64),
                     "hi": np.concatenate(hi).astype(np.int64), "least": np.concatenate(doc)})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, shas, texts = [], [], []
        for n, body, sha, spans in zip(batch.column("n_words").to_pylist(), batch.column("body"), batch.column("sha"),
                                       batch.column("spans").to_pylist()):
            if not body.is_valid:
                removed.append(0), shas.append(sha.as_py().decode()), texts.append(None)
                continue
            words = body.as_py().split(b" ")
            keep = np.ones(n, bool)
            for s in spans or ():
                keep[s["lo"]:s["hi"]] = False
            kept = [w for w, k in zip(words, keep) if k]
            removed.append(n - len(kept)), shas.append(_sha(kept))
            texts.append(b" ".join(kept).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()),
                                          pa.array(shas, pa.string()), batch.column("spans"), pa.array(texts, pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept_text"])


def _uncut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [split_words(t) for t in texts_of(batch, "text")]
        n = len(words)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.array(map(len, words), pa.int64()), pa.array([0] * n, pa.int64()), pa.array(map(_sha, words), pa.string()),
             pa.nulls(n, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))), pa.nulls(n, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept_text"])


def remove_repeats(docs: DataFrame, width: int = 50, shard_runs: int = 8000, hot_docs: int = 20_000) -> DataFrame:
    """One row per document: n_words, n_removed, kept_sha256, the removed ``spans`` (word places,
    end exclusive) and ``kept_text`` (null where nothing could be removed: the text as it is)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    whole_rows = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<lo:long,hi:long>>, kept_text string"
    none = docs.where("doc_id IS NULL").mapInArrow(_uncut, whole_rows)
    docs = docs.where("doc_id IS NOT NULL")
    apart = not shared_ids(docs).isEmpty()
    met = staged(docs.mapInArrow(lambda it: _scan(it, width), "mini long, doc_id long").groupBy("mini")
                 .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
                 .where("lo <> hi").select("mini", "n"))
    shared = spark.sparkContext.broadcast(key_filter(met, "mini"))
    hot = spark.sparkContext.broadcast(key_filter(met.where(F.col("n") > hot_docs), "mini"))
    parts = staged(docs.mapInArrow(lambda it: _split(it, width, shared.value, hot.value, apart),
                                   "kind byte, doc_id long, th long, mini long, start long, n_words long, body binary, sha binary"))
    runs = parts.where("kind > 0").select("kind", "mini", "doc_id", "th", "start", "body", "sha")
    n = {r.kind: -(-r.n // shard_runs) for r in runs.groupBy("kind").agg(F.count("body").alias("n")).collect()}
    shard = F.when(F.col("kind") == 1, F.pmod(F.xxhash64("mini", F.lit(3)), F.lit(n.get(1) or 1))).otherwise(
        -1 - F.pmod(F.xxhash64("sha", F.lit(3)), F.lit(n.get(2) or 1)))
    # One row per distinct run of a shard (equal windows share their minimizer, so their shard).
    distinct = (runs.withColumn("shard", shard).groupBy("shard", "sha")
                .agg(F.min("doc_id").alias("doc"), F.first("body", ignorenulls=True).alias("body")))
    found = distinct.groupBy("shard").applyInArrow(lambda group: _shard(group, width), "sha binary, lo long, hi long, least long")
    spans = (runs.select("sha", "doc_id", "th", "start").join(found, "sha").where("least < doc_id")
             .groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct(
                 (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + width - 1).alias("hi")))).alias("spans")))
    whole = parts.where("kind = 0").select("doc_id", "th", "n_words", "body", "sha")
    return (whole.join(spans, ["doc_id", "th"], "left").select("doc_id", "n_words", "body", "sha", "spans")
            .mapInArrow(_cut, whole_rows).unionByName(none))


def query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
