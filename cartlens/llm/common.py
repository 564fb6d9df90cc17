"""Helpers shared by the operators: staging, word hashing, row filters, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"      # a word: anything but ASCII white space


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: whoever reads the result re-reads files, also after an executor is lost.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/cartlens-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_ids(docs: DataFrame) -> DataFrame:
    """The ids (doc_id) that stand on different texts; one row per id is shuffled."""
    th = F.xxhash64("text")
    return (docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(th).alias("lo"), F.max(th).alias("hi"))
            .where("lo <> hi").select("doc_id"))


def held_out(doc_id: Column) -> Column:
    """Documents that no model may learn from: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit number over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of a text (split at ASCII white space), A-Z lower-cased on request; null: none."""
    if text is None:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


_FACTORS = mix64(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every run of ``width`` consecutive words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, np.uint64(width))
    for j in range(width):
        acc += hashes[j:j + n] * _FACTORS[j]
    return mix64(acc)


def texts_of(batch: pa.RecordBatch, name: str) -> Iterator[str | None]:
    """The texts of a batch one at a time, so that only one Python string exists at once."""
    for value in batch.column(name):
        yield value.as_py()


# -- a bounded filter for the rows worth sending on ---------------------------

FILTER_BITS = 1 << 24


def key_filter(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of the hashed keys (``bits`` bits, so at most bits/64 rows reach the driver).

    It has false positives and no false negatives: rows that fail it cannot have a key of
    ``keys``.  With more keys than bits it lets everything through, which only costs shuffle.
    """
    at = F.pmod(F.xxhash64(F.col(column)), F.lit(bits))
    words = (keys.select(at.alias("at")).groupBy((F.col("at") / 64).cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(at % 64 AS INT)))").alias("bits")))
    out = np.zeros(bits // 64, np.uint64)
    table = words.toArrow()
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxhash64_long(values: np.ndarray) -> np.ndarray:
    """``F.xxhash64`` of a long column (seed 42), so that tasks can ask a ``key_filter``."""
    v = values.astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        h = np.full(v.shape, np.uint64(42) + _P5 + np.uint64(8))
        h ^= _rotl(v * _P2, 31) * _P1
        h = _rotl(h, 27) * _P1 + _P4
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def passes(filter_bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the (long) keys the filter lets through."""
    at = np.mod(xxhash64_long(keys), np.int64(len(filter_bits) * 64)).astype(np.uint64)
    return ((filter_bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


# -- connected components -------------------------------------------------------

def _stars(edges: DataFrame) -> bool:
    """Whether distinct edges (u, v), u > v, give every u one v and no v is a u: then v is the component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = down").count() == 0


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): one row (node, component) per node.

    ``component`` is the smallest node reachable.  Alternating large-star and small-star
    steps: each round is two aggregations and two joins, the number of edges never grows, and
    the rounds grow with the logarithm of the longest path.  They end as soon as the edges are
    stars, so edges that are stars already need no round.  Nothing is collected.  Null ends
    and loops are left out; an empty input gives an empty result.
    """
    now = staged(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        if _stars(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        now = staged(small)
    else:
        raise RuntimeError("components did not settle")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")))).distinct()
