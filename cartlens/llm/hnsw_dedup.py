"""Embedding near-duplicates: a navigable small-world graph per shard, queried by every shard.

Equal vectors of one label first become one class with a count.  The classes of a label are
dealt to shards of at most about ``shard_rows``; for every two shards of a label one task builds
the graph of the first and asks it with the vectors of both.  A search walks to the ``ef`` nearest and from those within the threshold
goes on, front by front, through all neighbours within it, so a crowded neighbourhood is walked
whole.  Each task audits its answers against brute force on a fixed number of its vectors and of
slightly turned copies, which have a neighbour for certain, and doubles ``ef`` until the recall
asked for, averaged by vector, is reached; if the widest beam fails, or a recall of 1 is asked for,
the search is exact.  Cosines are computed in double precision.

A task returns one row per class (links and the smallest class it is connected to), never pairs;
the connected classes of all tasks meet in ``components``.

Defined results: vectors that are null, empty, zero or hold null or non-finite numbers, and
vectors without a label or an id, link with nothing and are their own component; vectors that
share an id are vectors of their own; vectors of different length are not compared; repeated rows are separate vectors that link with one
another; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import components, mix64, staged


class SmallWorld:
    """Hierarchical navigable small-world graph over unit vectors (rows of ``x``), by cosine."""

    def __init__(self, x: np.ndarray, m: int = 12, ef_build: int = 32):
        self.x, self.m = x, m
        n = len(x)
        u = (mix64(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(11)).astype(float) / 2.0 ** 53
        self.level = np.minimum((-np.log(np.maximum(u, 1e-300)) / log(m)).astype(int), 30)
        self.seen, self.stamp = np.zeros(n, np.int64), 0
        self.links: list[dict[int, np.ndarray]] = []
        self.entry = -1
        for i in range(n):
            self._insert(i, ef_build)
        # Links of level 0 in both directions, for whole fronts at once: a node that its neighbours
        # no longer point to is still found from the neighbours that it points to.
        near = [self.links[0][i] for i in range(n)]
        a = np.repeat(np.arange(n), [len(x) for x in near])
        b = np.concatenate([*near, np.empty(0, np.int64)])
        ends = np.unique(np.stack((np.append(a, b), np.append(b, a))), axis=1)
        self.first, self.other = np.searchsorted(ends[0], np.arange(n + 1)), ends[1]

    def _both(self, i: int) -> np.ndarray:
        return self.other[self.first[i]:self.first[i + 1]]

    def _walk(self, q: np.ndarray, starts: list[tuple[float, int]], ef: int, level: int,
              links=None) -> list[tuple[float, int]]:
        """Best-first walk of one level: the ``ef`` nearest that it meets, the nearest first."""
        self.stamp += 1
        links, x, seen, stamp = links or self.links[level].__getitem__, self.x, self.seen, self.stamp
        todo, best = [], []
        for s, i in starts:
            seen[i] = stamp
            heapq.heappush(todo, (-s, i))
            heapq.heappush(best, (s, i))
        while len(best) > ef:
            heapq.heappop(best)
        while todo:
            s, i = heapq.heappop(todo)
            if len(best) >= ef and -s < best[0][0]:
                break
            near = links(i)
            near = near[seen[near] != stamp]
            if not len(near):
                continue
            seen[near] = stamp
            worst = best[0][0] if len(best) >= ef else -2.0
            for sim, j in zip((x[near] @ q).tolist(), near.tolist()):
                if sim > worst:
                    heapq.heappush(todo, (-sim, j))
                    heapq.heappush(best, (sim, j))
                    if len(best) > ef:
                        heapq.heappop(best)
                    worst = best[0][0] if len(best) >= ef else -2.0
        return sorted(best, reverse=True)

    def _choose(self, near: list[tuple[float, int]], most: int) -> np.ndarray:
        """Neighbours that are closer to the node than to a neighbour already chosen, then the nearest."""
        if len(near) <= most:
            return np.array([i for _, i in near], np.int64)
        ids = np.array([i for _, i in near], np.int64)
        between = self.x[ids] @ self.x[ids].T
        sims = np.array([s for s, _ in near])
        free, out = np.ones(len(ids), bool), []
        for a in range(len(ids)):
            if free[a]:
                out.append(a)
                if len(out) == most:
                    break
                free &= between[a] <= sims
        if len(out) < most:
            out += [a for a in range(len(ids)) if a not in set(out)][:most - len(out)]
        return ids[out]

    def _insert(self, i: int, ef: int) -> None:
        q, level = self.x[i], int(self.level[i])
        if self.entry < 0:
            self.links = [{i: np.empty(0, np.int64)} for _ in range(level + 1)]
            self.entry = i
            return
        top = len(self.links) - 1
        at = [(float(self.x[self.entry] @ q), self.entry)]
        for lv in range(top, level, -1):
            at = self._walk(q, at[:1], 1, lv)
        for lv in range(min(level, top), -1, -1):
            at = self._walk(q, at, ef, lv)
            most = 2 * self.m if lv == 0 else self.m
            mine = self._choose(at, self.m)
            self.links[lv][i] = mine
            for j in mine.tolist():
                theirs = np.append(self.links[lv][j], i)
                if len(theirs) > most:
                    sims = self.x[theirs] @ self.x[j]
                    order = np.argsort(-sims, kind="stable")
                    theirs = self._choose(list(zip(sims[order].tolist(), theirs[order].tolist())), most)
                self.links[lv][j] = theirs
        if level > top:
            self.links += [{i: np.empty(0, np.int64)} for _ in range(level - top)]
            self.entry = i

    def within(self, q: np.ndarray, radius: float, ef: int) -> np.ndarray:
        """Ids of the vectors found with cosine ``radius`` or more."""
        if self.entry < 0:
            return np.empty(0, np.int64)
        at = [(float(self.x[self.entry] @ q), self.entry)]
        for lv in range(len(self.links) - 1, 0, -1):
            at = self._walk(q, at[:1], 1, lv)
        at = self._walk(q, at[:1], ef, 0, self._both)
        # From the near ones found, front by front through all that are within the radius.
        front = np.array([i for sim, i in at if sim >= radius], np.int64)
        found = [front]
        self.stamp += 1
        self.seen[front] = self.stamp
        while len(front):
            lo, n = self.first[front], self.first[front + 1] - self.first[front]
            near = self.other[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
            near = np.unique(near[self.seen[near] != self.stamp])
            self.seen[near] = self.stamp
            front = near[self.x[near] @ q >= radius]
            found.append(front)
        return np.concatenate(found)


def exact_search(index: np.ndarray, queries: np.ndarray, radius: float, block: int = 256) -> Iterator[np.ndarray]:
    for lo in range(0, len(queries), block):
        for row in queries[lo:lo + block] @ index.T >= radius:
            yield np.flatnonzero(row)


def audited_search(index: np.ndarray, queries: np.ndarray, radius: float, recall: float,
                   audits: int = 64, same: bool = False) -> Iterator[np.ndarray]:
    """For each query the rows of ``index`` within ``radius``; beams widen until the audit passes.

    The evidence is of bounded size, however rare neighbours are: ``audits`` of the queries,
    spread evenly, and as many indexed vectors turned away by a cosine between the radius and 1
    (so each has a neighbour for certain), all searched exactly.  Recall is averaged over those
    that have a true neighbour (for ``same``, queries that are the index, other than themselves).
    All answers come from the graph; only if the widest beam fails is the search exact.
    """
    if recall >= 1 or len(index) < 2:
        return exact_search(index, queries, radius)
    spread = lambda n: np.argsort((np.arange(n) * 0.6180339887498949) % 1, kind="stable")[:audits]
    picked = spread(len(queries))
    asked = np.concatenate((queries[picked], turned(index[spread(len(index))], radius)))
    truth = []
    for k, hits in enumerate(exact_search(index, asked, radius)):
        truth.append(hits[hits != picked[k]] if same and k < len(picked) else hits)
    graph, ef = SmallWorld(index), 16
    while ef < 2 * len(index):
        shares = [np.isin(hits, graph.within(q, radius, ef)).mean() for q, hits in zip(asked, truth) if len(hits)]
        if np.mean(shares) >= recall:
            return (graph.within(q, radius, ef) for q in queries)
        ef *= 2
    return exact_search(index, queries, radius)


def turned(x: np.ndarray, radius: float) -> np.ndarray:
    """Unit vectors at cosines from ``radius`` to 1 of the rows of ``x``, in fixed random directions."""
    rng = np.random.default_rng(len(x))
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(1)[:, None] * x
    size = np.sqrt((away * away).sum(1))[:, None]
    away = np.divide(away, size, out=np.zeros_like(away), where=size > 0)
    cos = (radius + (1 - radius) * (np.arange(len(x)) + 0.5) / len(x))[:, None]
    out = cos * x + np.sqrt(1 - cos * cos) * away
    return out / np.sqrt((out * out).sum(1))[:, None]


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def usable(embedding: Column) -> Column:
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.999,
                    shard_rows: int = 16384) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): n_links, component_id, kept."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    ok = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False)))
    classes = staged(rows.where("ok").groupBy("label", "embedding")
                     .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
                     # A class has a number of its own: one vec_id may stand on different vectors.
                     .withColumns({"dims": F.size("embedding"), "rep": F.monotonically_increasing_id()}))
    sizes = classes.groupBy("label", "dims").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = (classes.join(sizes, ["label", "dims"])
             .withColumn("s", F.pmod(F.xxhash64("rep"), F.col("shards")))
             .withColumn("t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
             .select("label", "dims", F.least("s", "t").alias("i"), F.greatest("s", "t").alias("j"),
                     (F.col("t") < F.col("s")).alias("asks"), "rep", "copies", "embedding"))

    def search(group: pa.Table) -> pa.Table:
        group = group.sort_by([("asks", "ascending"), ("rep", "ascending")])
        x = np.stack([np.asarray(v.values) for v in group.column("embedding")])
        x = x / np.sqrt((x * x).sum(axis=1))[:, None]
        rep, copies = group.column("rep").to_numpy(), group.column("copies").to_numpy()
        asks = group.column("asks").to_numpy()
        n = int((~asks).sum())
        parent, links = list(range(len(x))), np.zeros(len(x), np.int64)     # classes come in the order of their ids
        same = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        first = 0 if same else n                  # two shards: the second asks the graph of the first
        if n and first < len(x):
            for k, hits in enumerate(audited_search(x[:n], x[first:], threshold, recall, same=same), first):
                hits = hits[hits != k] if same else hits
                links[k] += copies[hits].sum()
                if not same:
                    links[hits] += copies[k]
                a = _root(parent, k)
                for h in hits.tolist():
                    b = _root(parent, h)
                    if a != b:
                        parent[max(a, b)] = a = min(a, b)
        root = rep[[_root(parent, k) for k in range(len(x))]]
        return pa.table({"rep": rep, "links": links, "root": root})

    found = staged(dealt.groupBy("label", "dims", "i", "j").applyInArrow(search, "rep long, links long, root long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = staged(classes.join(links, "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("label", "embedding", "least", (F.col("links") + F.col("copies") - 1).alias("n_links"),
                           F.coalesce("component", "rep").alias("component")))
    names = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(names, "component").select("label", "embedding", "n_links", "component_id")
    fine = (rows.where("ok").join(known, ["label", "embedding"])
            .select("vec_id", "n_links", "component_id"))
    alone = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    return fine.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings)
