"""Line dedup: a suffix array over line-ID sequences, built by distributed prefix doubling.

A document is the sequence of its lines that have a word.  Suffixes are ranked by their first 1,
2, 4, 8 ... lines: each round orders pairs of ranks (a suffix and the suffix as many lines on as
the ranks cover) until no two suffixes share a rank.  Suffixes that are alone with their prefix
leave after every round.  Suffixes of one rank are an interval of common prefixes; its first place
(the smallest document, then line) stays, all others are later copies.

The longest common prefix of a place with an earlier one lies between two powers of two; a binary
search over the lengths in between closes in on it.  A prefix of m lines, 2^k < m < 2^(k+1), is the
pair of the ranks of its first and its last 2^k lines, so each step counts pairs of known ranks,
for all places of an interval and only for the lengths that one of them asks for.

So each place has the longest run of lines that also stands earlier.  A run counts with
``min_lines`` lines, with ``min_words`` words in fewer lines or, for ``whole_documents``, if it is
the whole document that has it later.  Counting runs are deleted; those inside no other are the
document's maximal repeated runs.

Ranks are given to distinct pairs (counted map-side first, then dealt by range and numbered
inside each range after the rows of the ranges before) and come back to the rows from written
tables, so a line that a third of the corpus has is one row there and a join key that Spark can
split.  Lines are told apart by 128 bits of hash; only numbers are moved until the texts are cut
in the last join.

Defined results: a null or blank text has no lines and stays as it is; blank lines belong to no
run and stay, unless nothing else is left: then the text is empty; rows with the same id and
text are one document and are cut alike; null ids sort first; ties cannot arise (places are
ordered by id, text hash and line); an empty table gives an empty table; extra columns pass
through, and those named like a result column are replaced by it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import WORD, staged
from cartlens.llm.line_quality import let

RESULTS = ("n_lines", "n_removed", "n_runs", "longest_run")
PLACE = ["known", "id", "th"]           # null ids: known is false, id 0


def has_word(line: Column) -> Column:
    return F.ltrim(line, F.lit(" \t\n\x0b\x0c\r")) != ""


def line_places(docs: DataFrame, min_lines: int, min_words: int, whole_documents: bool) -> DataFrame:
    """One row per line that has a word: place (document, line), the line's hash (h, g) and ``short``,
    the numbers of lines under ``min_lines`` from there on that count if they are repeated."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    kept = F.filter(lines, has_word)

    def short(all_lines: Column, i: Column) -> Column:
        counts = []
        for k in range(1, min_lines):
            words = sum((F.get(all_lines, i + j)["n"] for j in range(k)), F.lit(0))     # null past the end
            counts.append(F.when((words >= min_words) | (F.lit(whole_documents) & (i == 0) & (F.size(all_lines) == k)), k))
        return F.filter(F.array(*counts).cast("array<int>"), lambda k: k.isNotNull())

    # Hashes first: then only numbers leave the array.
    numbers = F.transform(kept, lambda x: F.struct(
        F.xxhash64(x, F.lit(1)).alias("h"), F.xxhash64(F.lit(2), x).alias("g"), F.regexp_count(x, F.lit(WORD)).alias("n")))
    places = let(numbers, lambda v: F.transform(v, lambda x, i: F.struct(
        x["h"].alias("h"), x["g"].alias("g"), short(v, i).alias("short"))))
    return (docs.select(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("th"),
                        F.posexplode(places).alias("line", "x"))
            .select(*PLACE, "line", "x.h", "x.g", "x.short"))


def _ranked(keys: DataFrame) -> DataFrame:
    """Distinct pairs (r1, r2) with n rows each: ``rank`` = rows with a smaller pair."""
    keys = staged(keys.repartitionByRange("r1", "r2").withColumn("pid", F.spark_partition_id()))
    before = keys.groupBy("pid").agg(F.sum("n").alias("rows"))          # one row per range
    before = before.select("pid", (F.sum("rows").over(Window.orderBy("pid")) - F.col("rows")).alias("before"))
    w = Window.partitionBy("pid").orderBy("r1", "r2")
    return (keys.join(F.broadcast(before), "pid")
            .withColumn("rank", F.col("before") + F.sum("n").over(w) - F.col("n")).drop("pid", "before"))


def _refined(pairs: DataFrame) -> DataFrame:
    """Rows with a pair (r1, r2) that stands twice or more: its rank and first place instead."""
    keys = pairs.groupBy("r1", "r2").agg(F.count("*").alias("n"), F.min(F.struct(*PLACE, "line")).alias("first")).where("n > 1")
    ranks = staged(_ranked(keys).select("r1", "r2", "rank", "first"))
    return staged(pairs.join(ranks, ["r1", "r2"]).drop("r1", "r2"))


def doubled(places: DataFrame) -> list[DataFrame]:
    """Per round k the places whose next 2^k lines also stand elsewhere, with rank and first place."""
    levels = [_refined(places.withColumnsRenamed({"h": "r1", "g": "r2"}))]
    while not levels[-1].isEmpty():
        on = 1 << (len(levels) - 1)
        # Same document, 2^k lines on; missing: the run ends, or goes on like no other.
        ahead = Window.partitionBy(*PLACE).orderBy("line").rangeBetween(on, on)
        pairs = staged(levels[-1].select(*PLACE, "line", "short", F.col("rank").alias("r1"), F.first("rank").over(ahead).alias("r2"))
                       .where("r2 IS NOT NULL"))
        levels.append(_refined(pairs))
    return levels[:-1]


def longest_copies(levels: list[DataFrame]) -> DataFrame:
    """Places with an earlier copy: (document, line, short, lines), ``lines`` as many as possible."""
    here = F.struct(*PLACE, "line")
    tagged = [x.withColumn("k", F.lit(k)) for k, x in enumerate(levels)]
    later = (reduce(DataFrame.unionByName, [x.where(F.col("first") < here) for x in tagged])
             .groupBy(*PLACE, "line").agg(F.max(F.struct("k", "rank")).alias("x"), F.first("short").alias("short")))
    # Places with an earlier copy of 2^k lines and none of 2^(k+1): lo has one, hi has none.
    now = staged(later.select(*PLACE, "line", "short", "x.k", "x.rank", F.expr("1 << x.k").alias("lo"), F.expr("2 << x.k").alias("hi")))
    done = [now.where("k = 0")]
    for j in range(1, len(levels)):
        # Each step halves what is between: after j of them the places of level j are done.
        now = now.where(F.col("k") >= j)
        ranks = reduce(DataFrame.unionByName, [x.select("k", "rank", *PLACE, "line") for x in tagged[j:]])
        mid = ((F.col("lo") + F.col("hi")) / 2).cast("int")
        asks = now.select("k", "rank", mid.alias("m"), *PLACE, "line")
        lengths = asks.select("k", "rank", "m").distinct()
        members = ranks.join(lengths, ["k", "rank"]).withColumn("end", F.col("line") + F.col("m") - F.expr("1 << k"))
        ends = ranks.select("k", F.col("rank").alias("rank2"), *PLACE, F.col("line").alias("end"))
        pairs = staged(members.join(ends, ["k", *PLACE, "end"]).select("k", "rank", "m", "rank2", *PLACE, "line"))
        groups = staged(pairs.groupBy("k", "rank", "m", "rank2").agg(F.min(here).alias("first")))
        mine = pairs.join(asks, ["k", "rank", "m", *PLACE, "line"], "left_semi")
        longer = mine.join(groups, ["k", "rank", "m", "rank2"]).where(F.col("first") < here).select(*PLACE, "line").distinct()
        tried = now.join(longer.withColumn("yes", F.lit(True)), [*PLACE, "line"], "left")
        now = staged(tried.withColumns({"lo": F.when(F.col("yes"), mid).otherwise(F.col("lo")),
                                        "hi": F.when(F.col("yes").isNull(), mid).otherwise(F.col("hi"))}).drop("yes"))
        done.append(now.where(F.col("k") == j))
    return reduce(DataFrame.unionByName, done).select(*PLACE, "line", "short", F.col("lo").alias("lines"))


def remove_repeated_runs(docs: DataFrame, min_lines: int = 3, min_words: int = 50,
                         whole_documents: bool = False) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, ...) with later copies of line runs cut out of ``text``."""
    own = [c for c in docs.columns if c.lower() not in RESULTS]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])
    places = staged(line_places(docs, min_lines, min_words, whole_documents))
    levels = doubled(places)
    if not levels:
        levels = [places.limit(0).select(*PLACE, "line", "short", F.lit(0).cast("long").alias("rank"), F.struct(*PLACE, "line").alias("first"))]
    copies = longest_copies(levels).where((F.col("lines") >= min_lines) | F.exists("short", lambda k: k <= F.col("lines")))
    # Ends never fall from line to line, so a run inside another one ends where the run a line before does.
    w = Window.partitionBy(*PLACE).orderBy("line").rangeBetween(-1, -1)
    end = F.col("line") + F.col("lines")
    copies = copies.select(*PLACE, "line", "lines", end.alias("end")).withColumn("before", F.max("end").over(w))
    runs = (copies.where("before IS NULL OR end > before")
            .groupBy(*PLACE).agg(F.collect_list(F.sequence(F.col("line"), F.col("end") - 1)).alias("gone"),
                                 F.count("*").alias("n_runs"), F.max("lines").cast("long").alias("longest_run"))
            .select(F.when(F.col("known"), F.col("id")).alias("__id"), F.col("th").alias("__th"),
                    F.array_distinct(F.flatten("gone")).alias("__gone"), "n_runs", "longest_run"))
    th = F.xxhash64("text")
    joined = docs.withColumn("__h", th).join(runs, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left")
    joined = joined.withColumn("__l", F.split("text", "\n"))
    joined = joined.withColumn("__c", F.filter(F.transform("__l", lambda x, i: F.when(has_word(x), i)), lambda i: i.isNotNull()))
    joined = joined.withColumn("__cut", F.transform("__gone", lambda k: F.get("__c", k)))
    left = F.array_except(F.sequence(F.lit(0), F.size("__l") - 1), "__cut")
    cut = F.when(F.size("__gone") == F.size("__c"), "").otherwise(
        F.array_join(F.transform(left, lambda i: F.get("__l", i)), "\n"))
    return (joined.withColumn("n_lines", F.coalesce(F.size("__c"), F.lit(0)).cast("long"))
            .withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("long"))
            .withColumn("n_removed", F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long"))
            .withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(cut))
            .select(*[F.col(f"`{c}`") for c in own], "n_lines", "n_removed",
                    F.coalesce("n_runs", F.lit(0).cast("long")).alias("n_runs"),
                    F.coalesce("longest_run", F.lit(0).cast("long")).alias("longest_run")))


def query(docs: DataFrame) -> DataFrame:
    return remove_repeated_runs(docs.select("doc_id", "text"), whole_documents=True).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH parts AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM parts),
content AS (
  SELECT doc_id, line, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
sized AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id) AS n, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM content),
ahead AS (
  SELECT doc_id, i, n, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c,
         words AS w1, words + lead(words) OVER w AS w2
  FROM sized WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
windows AS (
  SELECT doc_id, i, 1 AS k, a, NULL AS b, NULL AS c, w1 >= 50 OR (i = 1 AND n = 1) AS counts FROM ahead
  UNION ALL SELECT doc_id, i, 2, a, b, NULL, w2 >= 50 OR (i = 1 AND n = 2) FROM ahead WHERE b IS NOT NULL
  UNION ALL SELECT doc_id, i, 3, a, b, c, true FROM ahead WHERE c IS NOT NULL),
later AS (
  SELECT doc_id, i, k FROM (
    SELECT *, row_number() OVER (PARTITION BY k, a, b, c ORDER BY doc_id, i) AS copy FROM windows)
  WHERE copy > 1 AND counts),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS i FROM later),
counts AS (
  SELECT c.doc_id, count(*) AS n_lines, count(g.i) AS n_removed
  FROM content c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.i = c.i GROUP BY c.doc_id),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS body
  FROM lines l LEFT JOIN content c ON c.doc_id = l.doc_id AND c.pos = l.pos
  LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.i = c.i
  WHERE g.i IS NULL GROUP BY l.doc_id)
SELECT p.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN n_removed > 0 AND n_removed = n_lines THEN ''
              WHEN coalesce(n_removed, 0) = 0 THEN p.text ELSE body END) AS kept_sha256
FROM parts p LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
