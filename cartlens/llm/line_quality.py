"""Quality rules, line first: clean each line, then judge the document by what it lost.

Only built-in column functions; nothing is shuffled, every row is judged on its own, so a hot
source or a very long text costs its own size and no more.

Defined results: a null text has no words and no lines and fails the base rules; an empty text
likewise; repeated rows are judged alike and all stay; an empty table gives an empty table;
extra columns pass through, and a column named like a result column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[ \t-\r]"                       # ASCII white space
SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", "»", "›", "•", "·", " > ")
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie",
    "javascript", "lorem ipsum", "licensed under", "click here", "subscribe to", "sign up for",
    "back to top", "skip to content", "share this", "powered by", "copyright ©", "©",
)
# Scripts written without spaces: their lines have few words however much they say.
UNSPACED = r"[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]+"
MENU = ("home", "menu", "login", "log in", "sign in", "register", "search", "next", "previous",
        "read more", "contact", "contact us", "about", "about us")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a lambda's argument is not copied into it)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def repeated_words(windows: Column, width: int) -> Column:
    """Words covered by windows (given by their hashes, in order) that occur twice or more."""
    def starts(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"]))
                         | (F.get(s, k + 1)["h"].eqNullSafe(x["h"])))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
        return F.aggregate(at, zero, lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"])

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(pairs, starts), covered)


def line_fails(line: Column, n_symbols: Column, short_chars: int, min_open_words: int,
               max_symbol_share: float) -> Column:
    """The line rules: navigation, boilerplate, punctuation.  Empty lines never fail."""
    phrases = F.lit("|".join(sorted(BOILERPLATE, key=len, reverse=True)))

    def of(raw: Column) -> Column:
        low = F.lower(raw)
        size = F.greatest(F.length(raw), F.lit(short_chars))
        hits = [low.contains(x) for x in BOILERPLATE]
        boilerplate = hits[0]
        for h in hits[1:]:
            boilerplate = boilerplate | h
        boilerplate = boilerplate & ((F.length(raw) <= short_chars)
                                     | (F.regexp_count(low, phrases) * short_chars >= size))
        seps = F.lit(0)
        for s in SEPARATORS:
            seps = seps + (F.length(raw) - F.length(F.replace(raw, F.lit(s), F.lit("")))) / len(s)
        navigation = (seps * short_chars >= 2 * size) | low.isin(*MENU)
        unfinished = (~raw.rlike(r"[.!?:;…。！？\"'”’)\]]$") & (F.size(words_of(raw)) < min_open_words)
                      & (F.length(F.regexp_replace(raw, UNSPACED, "")) <= short_chars))
        return boilerplate | navigation | unfinished

    def noisy(raw: Column) -> Column:
        symbols = F.length(F.regexp_replace(raw, r"[^#*$%&|<>]+", ""))
        return (n_symbols > 0) & (symbols > max_symbol_share * F.length(raw))

    return let(F.trim(line), lambda t: (t != "") & (noisy(t) | of(t)))


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "n_lines_removed", "n_words_removed", "clean_text", "kept")


def clean_documents(docs: DataFrame, text: str = "text", min_words: int = 10,
                    repeat_width: int = 5, max_repeat_percent: int = 20, short_chars: int = 300,
                    min_open_words: int = 5, max_symbol_share: float = 0.25,
                    max_loss: float = 0.5) -> DataFrame:
    """Every row of ``docs`` with its counts, its cleaned text and the verdict ``kept``.

    A line of any length fails if it is mostly symbols, holds a boilerplate phrase for every
    ``short_chars`` characters, looks like navigation (two separators for every ``short_chars``
    characters, a menu word) or is a fragment of under ``min_open_words`` words without closing
    punctuation; a line of up to ``short_chars`` counts as that long.  More than ``short_chars``
    letters of a script without spaces are no fragment.  A document is kept if it passes the
    base rules and loses at most ``max_loss`` of its words with its failed lines.
    """
    own = [c for c in docs.columns if c.lower() not in RESULTS]
    src = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    one = docs.select(*[F.col(f"`{c}`") for c in own], src.alias("__t"))
    one = one.select("*", words_of(F.col("__t")).alias("__w"), F.split("__t", "\n").alias("__l"),
                     F.length(F.regexp_replace("__t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    n = F.size("__w")
    hashes = F.when(n >= repeat_width, F.transform(
        F.sequence(F.lit(0), n - repeat_width),
        lambda i: F.xxhash64(*[F.get("__w", i + j) for j in range(repeat_width)]))).otherwise(
            F.array().cast("array<bigint>"))
    lines = F.filter("__l", lambda x: x.rlike(r"[^ \t-\r]"))
    two = one.select(
        "*", hashes.alias("__h"), lines.alias("__c"),
        F.filter("__l", lambda x: line_fails(x, F.col("n_symbols"), short_chars, min_open_words,
                                             max_symbol_share)).alias("__bad"))
    three = two.select(
        "*", n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        (F.size("__c") - F.size(F.array_distinct("__c"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("__h")) < F.size("__h"), repeated_words(F.col("__h"), repeat_width))
        .otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("__bad").cast("long").alias("n_lines_removed"),
        F.when(F.size("__bad") > 0, F.size(words_of(F.array_join("__bad", "\n")))).otherwise(0)
        .cast("long").alias("n_words_removed"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    clean = F.when(F.size("__bad") == 0, F.col("__t")).otherwise(
        F.array_join(F.filter("__l", lambda x: ~F.array_contains("__bad", x)), "\n"))
    return (three.withColumn("base_failed", failed).withColumn("clean_text", clean)
            .withColumn("kept", ~F.col("base_failed")
                        & (F.col("n_words_removed") <= max_loss * F.col("n_words")))
            .select(*[F.col(f"`{c}`") for c in own], *RESULTS))


QUERY_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "base_failed", "kept", "n_lines_removed", "n_words_removed")


def query(docs: DataFrame) -> DataFrame:
    return clean_documents(docs.select("doc_id", "text")).select(*QUERY_COLUMNS)


def _sql_list(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


ORACLE = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
lines AS (
  SELECT doc_id, t, unnest(l) AS line FROM base),
trimmed AS (
  SELECT doc_id, t, line, trim(line, ' ') AS raw, lower(trim(line, ' ')) AS low FROM lines),
measured AS (
  SELECT *, greatest(length(raw), 300) AS size,
         len(regexp_extract_all(low, '{"|".join(sorted(BOILERPLATE, key=len, reverse=True))}')) AS phrases,
         {" + ".join(f"(length(raw) - length(replace(raw, '{s}', ''))) / {len(s)}" for s in SEPARATORS)} AS seps,
         length(regexp_replace(raw, '[^\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Thai}}\p{{Lao}}\p{{Khmer}}\p{{Myanmar}}]+', '', 'g')) AS unspaced
  FROM trimmed),
judged AS (
  SELECT doc_id, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS content,
    raw <> '' AND (
      length(regexp_replace(raw, '[^#*$%&|<>]+', '', 'g')) > 0.25 * length(raw)
      OR (phrases > 0 AND (length(raw) <= 300 OR phrases * 300 >= size))
      OR seps * 300 >= 2 * size
      OR low IN ({_sql_list(MENU)})
      OR (NOT regexp_matches(raw, '[.!?:;…。！？"''”’)\]]$')
          AND len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) < 5 AND unspaced <= 300)) AS bad
  FROM measured),
by_doc AS (
  SELECT doc_id, count(*) FILTER (content) - count(DISTINCT line) FILTER (content) AS n_dup_lines,
         count(*) FILTER (bad) AS n_lines_removed,
         coalesce(sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) FILTER (bad), 0) AS n_words_removed
  FROM judged GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 4) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5)),
twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
counts AS (
  SELECT b.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         d.n_dup_lines::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         d.n_lines_removed::BIGINT AS n_lines_removed, d.n_words_removed::BIGINT AS n_words_removed
  FROM base b JOIN by_doc d USING (doc_id) LEFT JOIN covered c USING (doc_id)),
verdict AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND n_words_removed <= 0.5 * n_words AS kept FROM verdict
"""
