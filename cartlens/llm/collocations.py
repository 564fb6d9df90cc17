"""Phrase collocations: counts of word sequences by direct-address tiles over frequency-ranked ids.

Texts are coded once, in blocks of whole documents, as numbers of the block's own distinct words.
Per level the distinct units of all blocks meet in buckets by their hash: a bucket adds up the
counts, ranks the units found ``min_count`` times or more by frequency (the r-th of bucket b of B
gets id r B + b, so small ids are the frequent ones over the whole corpus) and returns to each block
the ids of the block's own units.  No task and no broadcast holds the vocabulary; blocks and buckets
are of bounded size, a unit is at most one entry a block, and arrays, not rows, are shuffled.

A block then counts neighbouring units.  The id square is dealt into tiles of ``TILE`` ids a side;
since ids go by frequency, few tiles near the origin hold most pairs.  Where a block fills a tile
densely, pairs address the cells of a numpy array and one ``bincount`` counts them; the rest is
sorted as coordinates (COO) and counted by runs.  Frequent pairs are ranked again and become the
units of the next level: neighbouring units of w words share w - 1 words, so their pairs are the
phrases of w + 1 words.

A phrase's best cut is the one with the lowest score; all arithmetic is whole numbers or decimals.

Defined results: a null text has no words; a null lang is ``und``; repeated rows count each time; an
empty table gives an empty table; other columns are ignored; a lang without a candidate has no row.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import mix64, staged, texts_of
from cartlens.session import target_partitions

TILE = 512                              # ids a side of a tile
DENSE = TILE * TILE // 16               # pairs of a block from which a tile is counted by address
BUCKET = 1 << 20                        # entries that a bucket is meant to hold
BLOCK_WORDS = 1 << 21
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
# What a level's blocks write: the coded sequence, or the distinct units with their counts.
WORD_BLOCKS = "block long, seq binary, lang string, words binary, lid binary, n binary, size long, total long"
PAIR_BLOCKS = "block long, seq binary, i binary, j binary, n binary, size long"
WORD_ENTRIES = "bucket long, block long, lang string, words binary, lid binary, n binary"
PAIR_ENTRIES = "bucket long, block long, i binary, j binary, lid binary, n binary"
# What a bucket returns: a frequent unit with its id, or a block's numbers and their ids.
WORD_IDS = "id long, lang string, word binary, f long, block long, lid binary, ids binary"
PAIR_IDS = "id long, i long, j long, f long, block long, lid binary, ids binary"
_ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in ddl.split(", ")])


def _batch(ddl: str, **columns) -> pa.RecordBatch:
    """Columns of equal length; what is not given is null."""
    size = len(next(iter(columns.values())))
    schema = _schema(ddl)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
                                       for f in schema], schema=schema)


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def pack(numbers: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers, 32 bits wide where they fit, their bytes dealt into planes and compressed;
    rising ones as differences."""
    if rising:
        numbers = np.diff(numbers, prepend=0)
    small = not len(numbers) or (numbers.max() < 2**31 and numbers.min() >= -2**31)
    numbers = np.ascontiguousarray(numbers, np.int32 if small else np.int64)
    return (b"n" if small else b"w") + squeeze(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes())


def unpack(raw: bytes, rising: bool = False) -> np.ndarray:
    kind = np.dtype(np.int64 if raw[:1] == b"w" else np.int32)
    planes = np.frombuffer(unsqueeze(raw[1:]), np.uint8).reshape(kind.itemsize, -1)
    numbers = np.ascontiguousarray(planes.T).reshape(-1).view(kind).astype(np.int64)
    return np.cumsum(numbers) if rising else numbers


# -- level 1: words -----------------------------------------------------------------

class _Numbers(dict):
    """Numbers of the words of one lang; all langs of a block draw from one row."""

    def __init__(self, taken: list):
        self.taken = taken

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.taken)
        self.taken.append(word)
        return number


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """Words of each piece of a text, A-Z lower-cased."""
    if text:
        for piece in text.encode("utf-8", "surrogatepass").lower().translate(_PIECES).split(b"\n"):
            if words := piece.split():
                yield words


def _encode(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    place, blocks = TaskContext.get().partitionId(), 0

    def new():
        return [], {}, array("i")

    def flush() -> Iterator[pa.RecordBatch]:
        block = (place << 31) + blocks
        seq = np.frombuffer(seq_, np.int32)
        yield _batch(WORD_BLOCKS, block=[block], seq=[pack(seq)])
        counts = np.bincount(seq[seq >= 0], minlength=len(taken))
        for lang, numbers in by_lang.items():
            if numbers:
                lid = np.fromiter(numbers.values(), np.int64, len(numbers))
                yield _batch(WORD_BLOCKS, block=[block], lang=[lang], words=[squeeze(b" ".join(numbers))], lid=[pack(lid, True)],
                             n=[pack(counts[lid])], size=[len(lid)], total=[int(counts[lid].sum())])

    taken, by_lang, seq_ = new()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch, "text")):
            number = by_lang.setdefault(lang, _Numbers(taken)).__getitem__
            for words in pieces(text):
                seq_.extend(map(number, words))
                seq_.append(-1)
            if len(seq_) >= block_words or len(taken) >= block_words // 4:
                yield from flush()
                blocks += 1
                taken, by_lang, seq_ = new()
    if len(seq_):
        yield from flush()


def _deal_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, lang, words, lid, n in zip(*(batch.column(c).to_pylist() for c in ("block", "lang", "words", "lid", "n"))):
            words = unsqueeze(words).split(b" ")
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) ^ np.uint64(xxhash.xxh64_intdigest(lang or ""))
            lid, n = unpack(lid, True), unpack(n)
            for bucket, mine in _dealt(hashes, buckets):
                yield _batch(WORD_ENTRIES, bucket=[bucket], block=[block], lang=[lang], words=[squeeze(b" ".join([words[k] for k in mine.tolist()]))],
                             lid=[pack(lid[mine], True)], n=[pack(n[mine])])


def _dealt(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Entries of each bucket, in their order."""
    which = (mix64(hashes) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(which, kind="stable")
    first = np.flatnonzero(np.append(True, which[by][1:] != which[by][:-1])) if len(by) else np.empty(0, np.int64)
    for lo, hi in zip(first, np.append(first[1:], len(by))):
        yield int(which[by[lo]]), by[lo:hi]


def _ids(f: np.ndarray, bucket: int, buckets: int, min_count: int) -> np.ndarray:
    """Ids of the frequent units of a bucket by falling count, -1 for the others."""
    ids = np.full(len(f), -1, np.int64)
    often = np.flatnonzero(f >= min_count)
    ids[often[np.argsort(-f[often], kind="stable")]] = np.arange(len(often)) * buckets + bucket
    return ids


def _returned(ddl: str, blocks: list[int], lids: list[np.ndarray], unit: list[np.ndarray], ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block, lid, u in zip(blocks, lids, unit):
        mine = ids[u]
        if (mine >= 0).any():
            yield _batch(ddl, block=[block], lid=[pack(lid[mine >= 0], True)], ids=[pack(mine[mine >= 0])])


def _word_bucket(group: pa.Table, buckets: int, min_count: int) -> pa.Table:
    blocks, lids, unit, counts, names, by_lang = [], [], [], [], [], {}
    for block, lang, words, lid, n in zip(*(group.column(c).to_pylist() for c in ("block", "lang", "words", "lid", "n"))):
        number = by_lang.setdefault(lang, _Numbers(names)).__getitem__
        blocks.append(block), lids.append(unpack(lid, True)), counts.append(unpack(n))
        unit.append(np.array(list(map(number, unsqueeze(words).split(b" "))), np.int64))
    f = np.zeros(len(names), np.int64)
    for u, n in zip(unit, counts):
        f[u] += n                                       # a block has each word of a lang once
    ids = _ids(f, group.column("bucket")[0].as_py(), buckets, min_count)
    langs = np.empty(len(names), object)
    for lang, numbers in by_lang.items():
        langs[list(numbers.values())] = lang
    often = np.flatnonzero(ids >= 0)
    found = _batch(WORD_IDS, id=ids[often], lang=langs[often], word=[names[k] for k in often.tolist()], f=f[often])
    return pa.Table.from_batches([found, *_returned(WORD_IDS, blocks, lids, unit, ids)], _schema(WORD_IDS))


# -- tiles ----------------------------------------------------------------------------

def count_pairs(left: np.ndarray, right: np.ndarray, tile: int = TILE, dense: int = DENSE) -> tuple[np.ndarray, ...]:
    """Distinct pairs (i, j), their counts, and for each given pair its number among the distinct ones."""
    number = np.empty(len(left), np.int64)
    found_i, found_j, found_n, taken = [], [], [], 0
    across = int(max(left.max(), right.max())) // tile + 1 if len(left) else 1
    at_tile, which, size = np.unique((left // tile) * across + right // tile, return_inverse=True, return_counts=True)
    by = np.argsort(which, kind="stable")
    ends = np.cumsum(size)
    for k in np.flatnonzero(size >= dense):
        mine = by[ends[k] - size[k]:ends[k]]
        cell = (left[mine] % tile) * tile + right[mine] % tile
        counts = np.bincount(cell, minlength=tile * tile)
        hit = np.flatnonzero(counts)
        names = np.cumsum(counts > 0) - 1
        number[mine] = taken + names[cell]
        found_i.append(at_tile[k] // across * tile + hit // tile)
        found_j.append(at_tile[k] % across * tile + hit % tile)
        found_n.append(counts[hit])
        taken += len(hit)
    rest = np.flatnonzero(size[which] < dense)
    if len(rest):
        i, j = left[rest], right[rest]
        order = np.lexsort((j, i))
        si, sj = i[order], j[order]
        first = np.flatnonzero(np.append(True, (si[1:] != si[:-1]) | (sj[1:] != sj[:-1])))
        runs = np.diff(np.append(first, len(order)))
        number[rest[order]] = taken + np.repeat(np.arange(len(first)), runs)
        found_i.append(si[first]), found_j.append(sj[first]), found_n.append(runs)
    empty = [np.empty(0, np.int64)]
    return np.concatenate(found_i or empty), np.concatenate(found_j or empty), np.concatenate(found_n or empty), number


def _pairs(seqs: pa.Table, ids: pa.Table, last: bool) -> pa.Table:
    """One block: its sequence with corpus-wide ids, the pairs of neighbours counted and numbered
    (the sequence of pairs is written unless this is the ``last`` level)."""
    batches = []
    known = [(unpack(a, True), unpack(b)) for a, b in zip(ids.column("lid").to_pylist(), ids.column("ids").to_pylist())]
    for block, raw in zip(seqs.column("of").to_pylist(), seqs.column("seq")):
        seq = unpack(raw.as_py())
        names = np.full(int(seq.max(initial=0)) + 2, -1, np.int64)    # the last one stands for -1
        for lid, wide in known:
            names[lid] = wide
        units = names[seq]
        at = np.flatnonzero((units[:-1] >= 0) & (units[1:] >= 0))
        if not len(at):
            continue
        i, j, n, number = count_pairs(units[at], units[at + 1])
        order = np.lexsort((j, i))                      # rising first ids and numbers compress well
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        out = np.full(len(seq) - 1, -1, np.int64)
        out[at] = place[number]
        if not last:
            batches.append(_batch(PAIR_BLOCKS, block=[block], seq=[pack(out)]))
        batches.append(_batch(PAIR_BLOCKS, block=[block], i=[pack(i[order], True)], j=[pack(j[order])], n=[pack(n[order])], size=[len(n)]))
    return pa.Table.from_batches(batches, _schema(PAIR_BLOCKS))


def _deal_pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, i, j, n in zip(*(batch.column(c).to_pylist() for c in ("block", "i", "j", "n"))):
            i, j, n = unpack(i, True), unpack(j), unpack(n)
            for bucket, mine in _dealt(mix64(i.view(np.uint64)) + j.view(np.uint64), buckets):
                yield _batch(PAIR_ENTRIES, bucket=[bucket], block=[block], i=[pack(i[mine], True)], j=[pack(j[mine])],
                             lid=[pack(mine, True)], n=[pack(n[mine])])


def _pair_bucket(group: pa.Table, buckets: int, min_count: int) -> pa.Table:
    blocks = group.column("block").to_pylist()
    i, lids = ([unpack(x, True) for x in group.column(c).to_pylist()] for c in ("i", "lid"))
    j, n = (np.concatenate([unpack(x) for x in group.column(c).to_pylist()]) for c in ("j", "n"))
    ends = np.cumsum([len(x) for x in i])
    i = np.concatenate(i)
    order = np.lexsort((j, i))
    si, sj = i[order], j[order]
    first = np.flatnonzero(np.append(True, (si[1:] != si[:-1]) | (sj[1:] != sj[:-1])))
    f = np.add.reduceat(n[order], first)
    ids = _ids(f, group.column("bucket")[0].as_py(), buckets, min_count)
    unit = np.empty(len(order), np.int64)
    unit[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    often = np.flatnonzero(ids >= 0)
    found = _batch(PAIR_IDS, id=ids[often], i=si[first[often]], j=sj[first[often]], f=f[often])
    return pa.Table.from_batches([found, *_returned(PAIR_IDS, blocks, lids, np.split(unit, ends[:-1]), ids)], _schema(PAIR_IDS))


# -- levels -----------------------------------------------------------------------------

def _ranked(rows: DataFrame, min_count: int, words: bool) -> DataFrame:
    """The units of all blocks counted and ranked in buckets (``WORD_IDS`` or ``PAIR_IDS``)."""
    units = rows.where("size IS NOT NULL").drop("seq")
    buckets = max(1, -(-(units.agg(F.sum("size")).first()[0] or 0) // BUCKET))
    deal, count = (_deal_words, _word_bucket) if words else (_deal_pairs, _pair_bucket)
    entries = units.mapInArrow(lambda it: deal(it, buckets), WORD_ENTRIES if words else PAIR_ENTRIES)
    return staged(entries.groupBy("bucket").applyInArrow(lambda group: count(group, buckets, min_count), WORD_IDS if words else PAIR_IDS))


def _next_level(rows: DataFrame, ranked: DataFrame, last: bool) -> DataFrame:
    """The blocks get the ids of their units and count neighbours (``PAIR_BLOCKS``)."""
    seqs = rows.where("size IS NULL").select(F.col("block").alias("of"), "seq")
    ids = ranked.where("block IS NOT NULL").select("block", "lid", "ids")
    return staged(seqs.groupBy("of").cogroup(ids.groupBy("block")).applyInArrow(lambda of, known: _pairs(of, known, last), PAIR_BLOCKS))


def phrase_counts(docs: DataFrame, max_words: int = 4, min_count: int = 30,
                  block_words: int = BLOCK_WORDS) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the phrases of 1, 2, ... ``max_words`` words with ``min_count`` occurrences, and
    the number of words of each lang (lang, n).

    Columns: id, lang, phrase, f, ``before`` and ``after`` (counts of its first and last 1, 2, ...
    words, all of them included), ``last`` (its last word), and from two words on i and j, the ids of
    its first and last words but one.
    """
    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    rows = staged(source.mapInArrow(lambda it: _encode(it, block_words), WORD_BLOCKS))
    totals = rows.where("size IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("n"))
    ranked = _ranked(rows, min_count, words=True)
    word, f = F.col("word").cast("string"), F.array("f")
    levels = [staged(ranked.where("id IS NOT NULL").select("id", "lang", word.alias("phrase"), "f", f.alias("before"), f.alias("after"),
                                                           word.alias("last")))]
    for size in range(2, max_words + 1):
        rows = _next_level(rows, ranked, last=size == max_words)
        ranked = _ranked(rows, min_count, words=False)
        left = levels[-1].select(F.col("id").alias("i"), "lang", F.col("phrase").alias("head"), "before")
        right = levels[-1].select(F.col("id").alias("j"), "after", "last")
        levels.append(staged(ranked.where("id IS NOT NULL").select("id", "i", "j", "f").join(left, "i").join(right, "j").select(
            "id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "f",
            F.concat("before", F.array("f")).alias("before"), F.concat("after", F.array("f")).alias("after"), "last", "i", "j")))
    return levels, totals


def _score(size: int) -> F.Column:
    """The cut with the lowest score, then the fewest words before it: struct(score, k, l, r)."""
    def cut(k: int) -> F.Column:
        l, r = F.col("before")[k - 1], F.col("after")[size - k - 1]
        score = F.expr(f"CAST(f AS DECIMAL(20,0)) * 2000000 div CAST(before[{k - 1}] + after[{size - k - 1}] AS DECIMAL(20,0))")
        return F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
    return F.array_min(F.array(*[cut(k) for k in range(1, size)]))


def candidates(levels: list[DataFrame], cover_percent: int = 80) -> DataFrame:
    """Phrases of two words or more that no longer one covers: lang, phrase, a, l, r, score.

    A phrase of w + 2 words lies round one of w + 1 words that is at least as frequent, so it is
    enough to look one word further.
    """
    out = None
    for size, level in enumerate(levels[1:], 2):
        if size < len(levels):
            longer = levels[size]
            top = (longer.select(F.col("i").alias("id"), "f").unionByName(longer.select(F.col("j").alias("id"), "f"))
                   .groupBy("id").agg(F.max("f").alias("longest")))
            covered = F.expr(f"CAST(longest AS DECIMAL(20,0)) * 100 >= CAST(f AS DECIMAL(20,0)) * {int(cover_percent)}")
            level = level.join(top, "id", "left").where(~F.coalesce(covered, F.lit(False)))
        rows = level.withColumn("best", _score(size)).select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score")
        out = rows if out is None else out.unionByName(rows)
    return out


def collocations(docs: DataFrame, max_words: int = 4, min_count: int = 30, cover_percent: int = 80, top: int = 2000,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each lang's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A hot lang is first cut to ``top`` rows in each of many salted groups, so its last sort is
    bounded by the number of groups.
    """
    if max_words < 2 or min_count < 1:
        raise ValueError("phrases have two words and one occurrence at least")
    levels, totals = phrase_counts(docs, max_words, min_count, block_words)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = candidates(levels, cover_percent).withColumn(
        "salt", F.pmod(F.xxhash64("phrase"), F.lit(max(16, target_partitions(docs.sparkSession)))))
    few = (salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
           .where(F.col("rank") <= top).drop("salt"))
    best = (few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
                  unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents WHERE text IS NOT NULL),
     q AS (SELECT lang, row_number() OVER () AS pid, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
     w AS (SELECT lang, pid, unnest(ws) AS w1, unnest(range(1, len(ws) + 1)) AS o, ws FROM q),
     g AS (SELECT lang, unnest([w1, CASE WHEN o + 1 <= len(ws) THEN array_to_string(ws[o:o + 1], ' ') END,
                                CASE WHEN o + 2 <= len(ws) THEN array_to_string(ws[o:o + 2], ' ') END,
                                CASE WHEN o + 3 <= len(ws) THEN array_to_string(ws[o:o + 3], ' ') END]) AS phrase FROM w),
     f AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, count(*)::HUGEINT AS f FROM g WHERE phrase IS NOT NULL
           GROUP BY lang, phrase HAVING count(*) >= 30),
     t AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
     c AS (SELECT lang, phrase, ws, f AS a FROM f WHERE len(ws) >= 2),
     cuts AS (SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000 * c.a) // (x.f + y.f) AS score
              FROM (SELECT *, unnest(range(1, len(ws))) AS k FROM c) c
              JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:k], ' ')
              JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:], ' ')),
     best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     inside AS (SELECT lang, a, size, array_to_string(ws[s:s + size - 1], ' ') AS phrase
                FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS s
                      FROM (SELECT *, unnest(range(2, len(ws))) AS size FROM c))),
     kept AS (SELECT * FROM best b WHERE NOT EXISTS (
                SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 80 * b.a)),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN t USING (lang) WHERE rank <= 2000
"""
