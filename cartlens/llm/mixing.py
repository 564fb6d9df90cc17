"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a seeded order, form blocks of ``block`` documents.  With target
weight w, block i of a source may run from slot floor(i / w) and must run before slot
ceil((i + 1) / w); earliest deadline first meets every window, so after any number of slots a
source has received less than one block more or less than its share.

Weights are whole tickets out of ``resolution`` (largest remainder, at least one each), so the
schedule repeats every ``resolution`` slots: the driver computes one period, whose size does not
depend on the documents, and every document finds its own slots from it.  The mix goes on until
each source has been read whole; smaller sources are read again from their start until then.

A source's documents are numbered by buckets of about ``bucket_rows``, so a hot source is spread
over as many tasks as its size asks for.  The broadcast table has one ticket list per source
and at most ``resolution`` numbers in all.

Defined results: a null source is a source of its own; null doc_ids are documents like others;
repeated rows are separate documents; ties in the seeded order go by doc_id; sources that
``weights`` does not name, or names with 0, are left out (that is what their weight says); an
empty table gives an empty table; extra columns pass through, and those named like a result
column are replaced by it.
"""

from __future__ import annotations

import heapq
from fractions import Fraction
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RESULTS = ("epoch", "block", "slot", "position")


def tickets(weights: dict, resolution: int) -> dict:
    """Whole tickets in proportion to the weights, at least one each, ``resolution`` in all."""
    names = sorted(weights, key=lambda s: (s is not None, s))
    total = sum(Fraction(w) for w in weights.values())
    exact = {s: Fraction(weights[s]) / total * resolution for s in names}
    out = {s: int(exact[s]) for s in names}
    by_rest = sorted(names, key=lambda s: (-(exact[s] - out[s]), names.index(s)))
    for s in by_rest[:resolution - sum(out.values())]:
        out[s] += 1
    for s in names:
        if out[s] == 0:                                  # taken from whoever has most
            out[max(names, key=lambda x: (out[x], -names.index(x)))] -= 1
            out[s] = 1
    return out


def pfair_period(shares: list[int]) -> list[list[int]]:
    """Slots of each source's blocks in one period of sum(shares) slots, by earliest deadline."""
    period = sum(shares)
    waiting = [(0, i, 0) for i in range(len(shares))]        # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []                   # (deadline, source, block)
    out: list[list[int]] = [[] for _ in shares]
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-((-(j + 1) * period) // shares[i]), i, j))
        deadline, i, j = heapq.heappop(ready)
        assert slot < deadline
        out[i].append(slot)
        if j + 1 < shares[i]:
            heapq.heappush(waiting, (max(slot + 1, (j + 1) * period // shares[i]), i, j + 1))
    return out


def mix(docs: DataFrame, weights: dict | None = None, alpha: float = 0.7, block: int = 64,
        resolution: int = 10_000, seed: int = 42, bucket_rows: int = 4096, ordered: bool = False) -> DataFrame:
    """Rows of ``docs`` (doc_id, source, ...) at their places of the mix.

    ``weights``: target weight by source; without it, rows ** ``alpha``.  Results: epoch (which
    reading of the source), block (of the source), slot (of the schedule) and position (0, 1,
    2, ... over the whole mix).  ``ordered`` sorts the rows by position.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c.lower() not in RESULTS]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])
    sizes = {r.source: r.n for r in docs.groupBy("source").agg(F.count("*").alias("n")).collect()}
    if weights is None:
        weights = {s: n ** alpha for s, n in sizes.items()}
    weights = {s: weights[s] for s in sizes if (weights.get(s) or 0) > 0}
    resolution = max(resolution, 4 * len(weights))
    share = tickets(weights, resolution) if weights else {}
    names = list(share)
    slots = pfair_period([share[s] for s in names]) if names else []
    horizon = 0
    for s, at in zip(names, slots):
        last = ceil(sizes[s] / block) - 1
        horizon = max(horizon, last // share[s] * resolution + at[last % share[s]] + 1)
    rows = []
    for s, at in zip(names, slots):
        given = horizon // resolution * share[s] + sum(x < horizon % resolution for x in at)
        rows.append((s is None, None if s is None else str(s), sizes[s], share[s], given * block, at))
    table = spark.createDataFrame(rows, "__null boolean, __name string, __n long, __k long, __given long, __at array<int>")
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    table = table.select(F.when(F.col("__null"), F.lit("n")).otherwise(F.concat(F.lit("s"), "__name")).alias("__key"),
                         "__n", "__k", "__given", "__at")
    few = table.select("__key", "__n")
    # Rows without an id go by their content, and so do ties: the places depend on the rows alone.
    content = F.xxhash64(*[F.col(f"`{c}`") for c in own if "map<" not in dict(docs.dtypes)[c]], F.lit(seed))
    by_id = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.lit(seed))).otherwise(content)
    hashed = (docs.withColumn("__key", key).withColumn("__h", by_id).withColumn("__t", content)
              .join(F.broadcast(few), "__key")
              .withColumn("__b", F.pmod("__h", F.ceil(F.col("__n") / bucket_rows))))
    before = (hashed.groupBy("__key", "__b").agg(F.count("*").alias("__c"))
              .withColumn("__off", F.sum("__c").over(Window.partitionBy("__key").orderBy("__b")) - F.col("__c"))
              .select("__key", "__b", "__off"))
    w = Window.partitionBy("__key", "__b").orderBy("__h", "doc_id", "__t")
    ranked = (hashed.drop("__n").withColumn("__r", F.row_number().over(w) - 1).join(before, ["__key", "__b"])
              .withColumn("__r", F.col("__r") + F.col("__off")).join(F.broadcast(table), "__key"))
    read = ranked.withColumn("__i", F.explode(F.sequence(F.col("__r"), F.col("__given") - 1, F.col("__n"))))
    block_no = F.floor(F.col("__i") / block)
    out = (read.withColumn("epoch", F.floor(F.col("__i") / F.col("__n")))
           .withColumn("block", block_no)
           .withColumn("slot", F.floor(F.col("block") / F.col("__k")) * resolution
                       + F.get("__at", (F.col("block") % F.col("__k")).cast("int")))
           .withColumn("position", F.col("slot") * block + F.col("__i") % block)
           .select(*[F.col(f"`{c}`") for c in own], *RESULTS))
    if ordered:
        parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
        out = out.repartitionByRange(parts, "position").sortWithinPartitions("position")
    return out


def query(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "source"))
