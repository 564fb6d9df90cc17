"""N-gram Jaccard self-join as a blocked sparse product of the document x n-gram incidence.

A document's row of the incidence matrix A holds its distinct word n-grams.  The overlap counts
are entries of A times its transpose; an entry matters only if it reaches 4/9 of both sizes
together (for a similarity of 0.8), and the product is cut down by what the sizes allow:

1. Equal rows become one class (its key is a hash of the whole set and its size).
2. Columns are put in one order for all rows, the very common n-grams last.  Linked rows share
   some of their first columns (``block``), so only these enter the candidate product.  They are
   dealt to column blocks as packed coordinate lists; a column that only one row has is dropped
   there, and so is a row with fewer shared columns than any partner of a fitting size asks for.
3. The candidate product does not pair up a crowded column.  In each round every class of a
   column meets the column's hub (one class, picked by a round's hash), and the counts of shared
   columns are summed by pair.  A pair goes on if the sizes fit and the count reaches the bound.
4. For the pairs left, the rows are multiplied in column blocks; a pair is dropped as soon as
   the overlap so far and the columns left cannot reach the bound.
5. Linked classes are joined; columns whose classes are all in one component are done.  What
   is left after the hub rounds is finished whole: pairs of the columns with few rows are
   checked one by one, and the rows of crowded columns are cut into blocks, and every two
   blocks are multiplied in a task of their own, which returns under one link per row.  So no
   link between components is lost, however many classes share a column.

The choice of common n-grams only changes the order, never the result.

Defined results: a null, empty or blank text has no n-gram, size 0, and is its own component;
a text of fewer words than n has its whole sequence as its one n-gram; copies and repeated rows
fall in one class; texts that share an id are documents of their own, and a component has the
smallest of its rows' ids; rows without an id link with nothing and have a null component;
ties cannot arise; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import (components, key_filter, passes, shared_ids, split_words, staged, texts_of,
                                 window_hashes, word_hashes)

WIDTH = 5
MOST_COMMON = 1 << 20     # n-grams put last in the order (a choice of order, not of work)
FLUSH = 1 << 22           # n-grams a task holds while it counts
CROWDED = 32              # a column with more rows is crowded
ROWS, COLUMNS = 512, 4096  # block sizes of the product in a crowd
BLOCK = 500_000           # entries of a column block


def ngram_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text."""
    words = split_words(text, lower=True)
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(width, len(words))))


def set_key(grams: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(grams.tobytes(), 5) - (1 << 63)


def needed(a, b, percent: int):
    """Smallest overlap of two sets of sizes a, b with 100 * overlap >= percent * union."""
    return -((-percent * (a + b)) // (100 + percent))


def _counted(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, n = np.unique(np.concatenate(grams), return_counts=True)
    return values[n >= 3], n[n >= 3]


def _first_pass(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Kind 0: (doc_id, size, key) of each document; kind 1: (n-gram, count) where common in the task."""
    held, n_held, keys = [], 0, set()

    def counts() -> pa.RecordBatch:
        values, n = _counted(held)
        return pa.RecordBatch.from_pydict({"kind": np.ones(len(values), np.int8), "a": values.view(np.int64),
                                           "b": n.astype(np.int64), "c": np.zeros(len(values), np.int64)})

    for batch in batches:
        ids, sizes, sums = batch.column("doc_id").to_numpy(zero_copy_only=False), [], []
        for text in texts_of(batch, "text"):
            g = ngram_set(text, width)
            sizes.append(len(g))
            sums.append(set_key(g))
            if len(g) and sums[-1] not in keys:
                keys.add(sums[-1])
                held.append(g)
                n_held += len(g)
            if n_held > FLUSH:
                yield counts()
                held, n_held, keys = [], 0, set()
        yield pa.RecordBatch.from_pydict({"kind": np.zeros(len(ids), np.int8), "a": ids.astype(np.int64),
                                          "b": np.array(sizes, np.int64), "c": np.array(sums, np.int64)})
    if held:
        yield counts()


def slack(size):
    """Columns that two linked rows must share in their blocks (see ``block``)."""
    return np.maximum(1, np.asarray(size) // 16)


def block(size, percent: int):
    """Columns of a row that enter the candidate product.

    If two rows share ``o`` columns, their first size - o + m columns share at least m of them,
    for any m.  With o >= percent of either size and m = slack, linked rows share at least the
    smaller of their slacks within their blocks.
    """
    return size - (-(-percent * size // 100)) + slack(size)


def _incidence(batches: Iterator[pa.RecordBatch], width: int, percent: int, common: np.ndarray, reps: np.ndarray,
               blocks: int) -> Iterator[pa.RecordBatch]:
    """The rows' first columns as coordinate lists by column block: (block, grams, docs).

    Very common columns are shared for certain; they go to blocks below 0, dealt by document.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n_held = 0

    def flush() -> pa.RecordBatch:
        grams, docs = (np.concatenate(x) for x in zip(*held))
        at = (grams >> np.uint64(24)).astype(np.int64) % blocks
        if len(common):
            k = np.minimum(np.searchsorted(common, grams), len(common) - 1)
            at = np.where(common[k] == grams, -1 - docs % blocks, at)
        order = np.argsort(at, kind="stable")
        at, grams, docs = at[order], grams[order], docs[order]
        cut = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at))
        spans = list(zip(cut[:-1], cut[1:]))
        return pa.RecordBatch.from_pydict({
            "block": at[cut[:-1]], "grams": pa.array([grams[i:j].tobytes() for i, j in spans], pa.binary()),
            "docs": pa.array([docs[i:j].tobytes() for i, j in spans], pa.binary())})

    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        text = batch.column("text")
        for i in np.flatnonzero(passes(reps, ids)):
            g = ngram_set(text[int(i)].as_py(), width)
            if not len(g):
                continue
            if len(common):
                last = common[np.minimum(np.searchsorted(common, g), len(common) - 1)] == g
                g = np.concatenate((g[~last], g[last]))
            g = g[:int(block(len(g), percent))]
            held.append((g, np.full(len(g), ids[i])))
            n_held += len(g)
            if n_held > FLUSH:
                yield flush()
                held, n_held = [], 0
    if held:
        yield flush()


def _shared(group: pa.Table) -> pa.Table:
    """Of one column block the entries whose column has two documents or more."""
    grams = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("grams")])
    docs = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in group.column("docs")])
    if group.column("block")[0].as_py() >= 0:
        order = np.argsort(grams, kind="stable")
        grams, docs = grams[order], docs[order]
        new = np.append(True, grams[1:] != grams[:-1])
        start = np.flatnonzero(new)
        lo, hi = np.minimum.reduceat(docs, start), np.maximum.reduceat(docs, start)
        keep = (lo != hi)[np.cumsum(new) - 1]
        grams, docs = grams[keep], docs[keep]
    return pa.table({"gram": grams.view(np.int64), "rep": docs})


def overlap(x: np.ndarray, y: np.ndarray, need: int, blocks: int = 8) -> int:
    """Overlap of two sorted sets, summed by column blocks; -1 once ``need`` is out of reach."""
    edges = (np.arange(1, blocks, dtype=np.uint64) << np.uint64(61)) if blocks == 8 else np.empty(0, np.uint64)
    cx = np.concatenate(([0], np.searchsorted(x, edges), [len(x)]))
    cy = np.concatenate(([0], np.searchsorted(y, edges), [len(y)]))
    total = 0
    for b in range(len(cx) - 1):
        xs, ys = x[cx[b]:cx[b + 1]], y[cy[b]:cy[b + 1]]
        if len(xs) and len(ys):
            total += int((ys[np.minimum(np.searchsorted(ys, xs), len(ys) - 1)] == xs).sum())
        if total + min(len(x) - cx[b + 1], len(y) - cy[b + 1]) < need:
            return -1
    return total


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose sets are similar enough."""
    both = (pairs.select("x", "y").join(sets.select(F.col("rep").alias("x"), F.col("grams").alias("gx")), "x")
            .join(sets.select(F.col("rep").alias("y"), F.col("grams").alias("gy")), "y"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for k, (gx, gy) in enumerate(zip(batch.column("gx"), batch.column("gy"))):
                a, b = np.frombuffer(gx.as_buffer(), np.uint64), np.frombuffer(gy.as_buffer(), np.uint64)
                need = needed(len(a), len(b), percent)
                ok[k] = overlap(a, b, need) >= need
            ok = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column("x").filter(ok), batch.column("y").filter(ok)], names=["x", "y"])

    return both.select("x", "y", "gx", "gy").mapInArrow(linked, "x long, y long")


def _product(group: pa.Table, percent: int) -> pa.Table:
    """Links between two blocks of rows: their incidence multiplied in column blocks.

    Overlap counts add up over the column blocks; pairs below the bound of their sizes are
    discarded.  Returned are links that join what is not joined yet: under one per row.
    """
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("grams")]
    rep, comp = group.column("rep").to_numpy(), group.column("comp").to_numpy()
    right = group.column("right").to_numpy(zero_copy_only=False)
    same = group.column("same")[0].as_py()
    left_rows, right_rows = (np.arange(len(sets)),) * 2 if same else (np.flatnonzero(~right), np.flatnonzero(right))
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams, row = grams[order], row[order]
    column = np.cumsum(np.append(True, grams[1:] != grams[:-1])) - 1
    shared = np.bincount(column)[column] > 1
    column, row = np.unique(column[shared], return_inverse=True)[1], row[shared]
    total = np.zeros((len(left_rows), len(right_rows)), np.float32)
    for lo in range(0, int(column.max()) + 1 if len(column) else 0, COLUMNS):
        i, j = np.searchsorted(column, (lo, lo + COLUMNS))
        a = np.zeros((len(sets), COLUMNS), np.float32)
        a[row[i:j], column[i:j] - lo] = 1
        total += a[left_rows] @ a[right_rows].T
    need = needed(size[left_rows][:, None], size[right_rows][None, :], percent)
    x, y = np.nonzero((total >= need) & (comp[left_rows][:, None] != comp[right_rows][None, :]))
    x, y = left_rows[x], right_rows[y]
    parent = {c: c for c in comp.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c
    out = []
    for k, (a, b) in enumerate(zip(comp[x].tolist(), comp[y].tolist())):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append(k)
    return pa.table({"x": rep[x[out]], "y": rep[y[out]]})


def _crowd_links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components among the documents of crowded columns, every pair looked at.

    ``rows``: gram, rep, size, comp of the crowded columns.  Documents that crowded columns
    connect form a crowd; a crowd is cut into blocks of about ``ROWS`` documents of one size
    class, and every two blocks whose sizes can be linked are multiplied in a task of their own.
    """
    hubs = rows.groupBy("gram").agg(F.min("rep").alias("b"))
    crowd = components(rows.join(hubs, "gram").select(F.col("rep").alias("a"), "b").distinct())
    doc = (rows.select("rep", "size", "comp").distinct().join(crowd.withColumnRenamed("node", "rep"), "rep")
           .withColumn("cls", F.floor(F.log("size") / float(np.log(100 / percent))).cast("int")))
    doc = staged(doc.select("rep", "comp", F.col("component").alias("crowd"), "cls"))
    n = doc.groupBy("crowd", "cls").agg(F.ceil(F.count("*") / ROWS).alias("n"))
    doc = (doc.join(n, ["crowd", "cls"])
           .join(n.select("crowd", (F.col("cls") - 1).alias("cls"), F.col("n").alias("above")), ["crowd", "cls"], "left")
           .join(n.select("crowd", (F.col("cls") + 1).alias("cls"), F.col("n").alias("below")), ["crowd", "cls"], "left")
           .withColumn("b", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("n"))))
    to = lambda m: F.sequence(F.lit(0).cast("long"), F.col(m) - 1)
    meet = lambda cls, up, i, j, right: F.struct(cls.alias("cls"), up.alias("up"), i.alias("i"), j.alias("j"), right.alias("right"))
    no, yes = F.lit(False), F.lit(True)
    none = F.array().cast("array<struct<cls:int,up:boolean,i:bigint,j:bigint,right:boolean>>")
    own = F.transform(to("n"), lambda t: meet(F.col("cls"), no, F.least("b", t), F.greatest("b", t), t < F.col("b")))
    up = F.when(F.col("above").isNotNull(), F.transform(to("above"), lambda t: meet(F.col("cls"), yes, F.col("b"), t, no))).otherwise(none)
    down = F.when(F.col("below").isNotNull(), F.transform(to("below"), lambda t: meet(F.col("cls") - 1, yes, t, F.col("b"), yes))).otherwise(none)
    dealt = (doc.withColumn("m", F.explode(F.concat(own, up, down))).select("crowd", "m.*", "rep", "comp")
             .withColumn("same", ~F.col("up") & (F.col("i") == F.col("j"))).join(sets, "rep"))
    return (dealt.groupBy("crowd", "cls", "up", "i", "j")
            .applyInArrow(lambda group: _product(group, percent), "x long, y long"))


def jaccard_components(docs: DataFrame, percent: int = 80, width: int = WIDTH, hub_rounds: int = 3) -> DataFrame:
    """One row per document (doc_id): n_shingles and component_id (the smallest id linked)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    none = docs.where("doc_id IS NULL").withColumn("doc_id", F.lit(0).cast("long"))
    none = none.mapInArrow(lambda it: _first_pass(it, width), "kind byte, a long, b long, c long").where("kind = 0").select(
        F.lit(None).cast("long").alias("doc_id"), F.col("b").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    docs = docs.where("doc_id IS NOT NULL")
    twice = staged(shared_ids(docs))
    if twice.isEmpty():
        return _components_by_id(docs, percent, width, hub_rounds).unionByName(none)
    # Texts that share an id get numbers of their own, beside all ids.
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    number = F.lit(hi) + 1 + F.monotonically_increasing_id() if hi < 1 << 62 else F.lit(lo) - 1 - F.monotonically_increasing_id()
    marked = docs.withColumn("th", F.xxhash64("text"))
    numbers = staged(marked.join(twice, "doc_id").select("doc_id", "th").distinct().withColumn("number", number))
    own = marked.join(numbers, ["doc_id", "th"], "left").select(F.coalesce("number", "doc_id").alias("doc_id"), "text")
    found = _components_by_id(staged(own), percent, width, hub_rounds).join(
        numbers.select(F.col("number").alias("doc_id"), F.col("doc_id").alias("own")), "doc_id", "left")
    found = staged(found.select(F.coalesce("own", "doc_id").alias("doc_id"), "n_shingles", "component_id"))
    names = found.groupBy("component_id").agg(F.min("doc_id").alias("least"))
    return (found.join(names, "component_id").select("doc_id", "n_shingles", F.col("least").alias("component_id"))
            .unionByName(none))


def _components_by_id(docs: DataFrame, percent: int, width: int, hub_rounds: int) -> DataFrame:
    """The same for rows whose id (not null) names one text."""
    spark = docs.sparkSession
    first = staged(docs.mapInArrow(lambda it: _first_pass(it, width), "kind byte, a long, b long, c long"))
    members = first.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("size"), F.col("c").alias("key"))
    classes = staged(members.where("size > 0").groupBy("key", "size").agg(F.min("doc_id").alias("rep")))
    common = (first.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n")).where("n >= 32")
              .orderBy(F.desc("n"), "a").limit(MOST_COMMON).select("a").toArrow().column("a").to_numpy())
    common = spark.sparkContext.broadcast(np.sort(common.view(np.uint64)))
    whole = classes.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, int(whole * (1 - percent / 100 + 1 / 16)) // BLOCK)
    reps = spark.sparkContext.broadcast(key_filter(classes, "rep"))
    rows = staged(docs.mapInArrow(lambda it: _incidence(it, width, percent, common.value, reps.value, blocks),
                                  "block long, grams binary, docs binary")
                  .groupBy("block").applyInArrow(_shared, "gram long, rep long"))
    # A linked row shares at least the slack of its smallest possible partner.
    rows = rows.join(classes.select("rep", F.col("size").cast("int").alias("size")), "rep")
    smallest = F.ceil(F.lit(percent) * F.col("size") / 100)
    least = F.greatest(F.lit(1), F.floor(smallest / 16))
    enough = rows.groupBy("rep").agg(F.count("*").alias("n"), F.first(least).alias("least")).where("n >= least").select("rep")
    rows = staged(rows.join(enough, "rep", "left_semi").select("gram", "rep", "size"))
    shared = rows.groupBy("gram").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("gram")
    rows = rows.join(shared, "gram", "left_semi")
    enough = rows.groupBy("rep").agg(F.count("*").alias("n"), F.first(least).alias("least")).where("n >= least").select("rep")
    rows = staged(rows.join(enough, "rep", "left_semi").select("gram", "rep", "size"))
    asked = key_filter(rows.select("rep").distinct(), "rep")
    wanted = spark.sparkContext.broadcast(asked)

    def row_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            use = np.flatnonzero(passes(wanted.value, ids))
            text = batch.column("text")
            grams = [ngram_set(text[int(k)].as_py(), width).tobytes() for k in use]
            yield pa.RecordBatch.from_pydict({"rep": ids[use], "grams": pa.array(grams, pa.binary())})

    reps = rows.select("rep").distinct()
    sets = staged(docs.mapInArrow(row_sets, "rep long, grams binary").dropDuplicates(["rep"]).join(reps, "rep", "left_semi"))
    labels = None
    for r in range(hub_rounds + 1):
        live = rows
        if labels is not None:
            live = (rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                    .withColumn("comp", F.coalesce("component", "rep")).drop("component"))
            mixed = live.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("gram")
            live = staged(live.join(mixed, "gram", "left_semi"))
            rows = live.select("gram", "rep", "size")
        else:
            live = live.withColumn("comp", F.col("rep"))
        if r < hub_rounds:
            hub = (live.groupBy("gram").agg(F.min_by(F.struct("rep", "size", "comp"), F.xxhash64("rep", F.lit(r))).alias("h")))
            met = live.join(hub, "gram").select("rep", "size", "comp", F.col("h.rep").alias("rep2"),
                                                F.col("h.size").alias("size2"), F.col("h.comp").alias("comp2"))
        else:
            # Crowded columns: their documents are compared block by block, in tasks of their own.
            # Other columns: every pair across components (pairs of a crowd are known already).
            n = live.groupBy("gram").agg(F.count("*").alias("n"))
            crowds = _crowd_links(live.join(n.where(F.col("n") > CROWDED), "gram", "left_semi"), sets, percent)
            live = live.join(n.where(F.col("n") <= CROWDED), "gram", "left_semi")
            other = live.select("gram", *[F.col(c).alias(c + "2") for c in ("rep", "size", "comp")])
            met = live.join(other, "gram").where("rep < rep2")
        need = F.ceil(F.lit(percent) * (F.col("size") + F.col("size2")) / F.lit(100 + percent))
        met = met.where((F.col("comp") != F.col("comp2")) & (need <= F.least("size", "size2")))
        slacks = F.greatest(F.lit(1), F.floor(F.least("size", "size2") / 16))
        pairs = (met.groupBy(F.least("rep", "rep2").alias("x"), F.greatest("rep", "rep2").alias("y"))
                 .agg(F.count("*").alias("met"), F.first(slacks).alias("slack"))
                 .where("met >= slack").select("x", "y"))
        links = _verified(pairs, sets, percent)
        if r == hub_rounds:
            links = links.unionByName(crowds)
        edges = links.select(F.col("x").alias("a"), F.col("y").alias("b"))
        if labels is not None:          # the links of earlier rounds, as a star for each component
            edges = edges.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = staged(components(edges))
    by_class = (classes.join(labels, classes["rep"] == labels["node"], "left")
                .select("key", "size", F.coalesce("component", "rep").alias("component_id")))
    return (members.join(by_class, ["key", "size"], "left")
            .select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))


def query(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)
