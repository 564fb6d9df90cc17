"""Per-group ordered statistics that survive a hot group.

A window ``partitionBy(user).orderBy(...)`` sorts all rows of a user in ONE
task; a user holding a third of the log would then be a third of the job in a
single task.  Here rows are instead range-partitioned on (group, order keys):
Spark samples the key range, so a hot group is cut into many partitions of
similar size.  Each partition is sorted locally; a row's record number inside
its partition plus the count of the group's rows in earlier partitions gives
its exact position in the group.  The per-(group, partition) chunk table has
at most (#groups + #partitions) rows and carries every cross-partition fact.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.session import cut_lineage, target_partitions
from pyspark.sql.types import LongType, StructField, StructType


def _range_split(df: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    n = partitions or target_partitions(df.sparkSession)
    return df.repartitionByRange(n, *keys)


def _ranged(df: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    return _range_split(df, keys, partitions).sortWithinPartitions(*keys)


def _chunk_offsets(chunks: DataFrame, group: str) -> DataFrame:
    """Rows of the group that lie in earlier partitions, per (group, partition)."""
    w = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))


def trend_sums(df: DataFrame, group: str, order: list[str], value: str,
               partitions: int | None = None) -> DataFrame:
    """Per group: n, sum(y), sum(pos * y) with pos = 0..n-1 in ``order``.

    Pure JVM: ``monotonically_increasing_id`` after a local sort numbers the
    rows of each partition in key order; positions are rebuilt from chunk
    aggregates, so no per-row join back is needed.
    """
    keys = [group, *order]
    ranged = _ranged(df.select(*dict.fromkeys(keys + [value])), keys, partitions)
    rec = ranged.select(
        group, F.col(value).cast("decimal(22,8)").alias("_y"),
        F.spark_partition_id().alias("_p"),
        F.monotonically_increasing_id().alias("_id"))
    # Record numbers grow with the partition, so the sums are exact decimals: nothing cancels
    # when a group that starts late is moved back to position 0.
    rec = rec.withColumn("_li", F.col("_id") - F.shiftleft(F.col("_p").cast("long"), 33))
    chunks = rec.groupBy(group, "_p").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_sy"),
        F.sum(F.col("_li").cast("decimal(13,0)") * F.col("_y")).alias("_sly"), F.min("_li").alias("_start"))
    chunks = _chunk_offsets(chunks, group)
    return chunks.groupBy(group).agg(
        F.sum("_n").alias("n"), F.sum("_sy").alias("sum_y"),
        F.sum(F.col("_sly") - (F.col("_start") - F.col("_off")).cast("decimal(13,0)")
              * F.col("_sy").cast("decimal(24,8)")).alias("sum_xy"))


def slope_from_sums(n="n", sum_y="sum_y", sum_xy="sum_xy") -> F.Column:
    """Least-squares slope of y on x = 0..n-1; 0 when fewer than 2 points.

    With x = 0..n-1: Sxx - Sx^2/n = n(n^2-1)/12 and Sx/n = (n-1)/2.
    """
    count, sy, sxy = F.col(n).cast("decimal(13,0)"), F.col(sum_y).cast("decimal(24,8)"), F.col(sum_xy)
    n = F.col(n).cast("double")
    num = (2 * sxy - (count - 1) * sy).cast("double") / 2
    den = n * (n * n - 1) / 12
    return F.when(n < 2, F.lit(0.0)).otherwise(num / den)


CHUNK_ROWS = 64      # places in a chunk and their powers stay small, so its moments move exactly


def centred_moments(df: DataFrame, group: str, order: list[str], value: str, degree: int,
                    partitions: int | None = None) -> DataFrame:
    """Per group: ``n`` and ``u0`` .. ``u<degree>`` = sum((pos - (n - 1) / 2)^k * y), pos = 0..n-1 in ``order``.

    Rows are range-split as in ``trend_sums`` and cut into chunks of ``CHUNK_ROWS`` record
    numbers.  The moments about the group's first row in a chunk are exact decimal sums; they are
    then moved, by the binomial formula, first to the start of the group's part of the partition,
    then to the group's middle.
    Windows see chunks of one (group, partition), then one row a (group, partition).
    """
    size = CHUNK_ROWS
    keys = [group, *order]
    ranged = _ranged(df.select(*dict.fromkeys(keys + [value])), keys, partitions)
    rec = ranged.select(group, F.col(value).cast("decimal(18,6)").alias("_y"), F.spark_partition_id().alias("_p"),
                        F.monotonically_increasing_id().alias("_id"))
    at = F.col("_id") - F.shiftleft(F.col("_p").cast("long"), 33)
    rec = rec.withColumns({"_q": (at / size).cast("long"), "_lo": at % size})
    power, sums = F.lit(1).cast("long"), []
    for k in range(degree + 1):
        sums.append(F.sum(power.cast("decimal(10,0)") * F.col("_y")).cast("decimal(28,6)").alias(f"_m{k}"))
        power = power * F.col("_lo")
    chunks = rec.groupBy(group, "_p", "_q").agg(F.count(F.lit(1)).alias("_n"), F.min("_lo").alias("_start"), *sums)

    def moved(shift, prefix: str, out: str):
        """Moments about another place: sum((x + shift)^k y)."""
        return [sum((F.lit(float(math.comb(k, i))) * F.pow(shift, F.lit(k - i)) * F.col(f"{prefix}{i}") for i in range(k + 1)),
                    F.lit(0.0)).alias(f"{out}{k}") for k in range(degree + 1)]

    def about_start(k: int):
        terms, back = F.lit(0).cast("decimal(38,6)"), F.lit(1).cast("long")
        for i in range(k, -1, -1):
            terms = terms + (math.comb(k, i) * back).cast("decimal(11,0)") * F.col(f"_m{i}")
            back = back * -F.col("_start")
        return terms.cast("double").alias(f"_c{k}")

    chunks = chunks.select(group, "_p", "_q", "_n", *[about_start(k) for k in range(degree + 1)])
    earlier = Window.partitionBy(group, "_p").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_s", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("double"))
    parts = chunks.select(group, "_p", "_n", *moved(F.col("_s"), "_c", "_t")).groupBy(group, "_p").agg(
        F.sum("_n").alias("_n"), *[F.sum(f"_t{k}").alias(f"_t{k}") for k in range(degree + 1)])
    parts = _chunk_offsets(parts, group).withColumn("n", F.sum("_n").over(Window.partitionBy(group)))
    middle = (F.col("_off") - (F.col("n") - 1) / 2).cast("double")
    parts = parts.withColumn("_s", middle).select(group, "n", *moved(F.col("_s"), "_t", "_u"))
    return parts.groupBy(group).agg(F.max("n").alias("n"), *[F.sum(f"_u{k}").alias(f"u{k}") for k in range(degree + 1)])


def linear_coefficient(degree: int) -> F.Column:
    """Coefficient of x in the least-squares polynomial of ``degree`` over x = 0..n-1.

    The fit is a sum over the orthogonal (Gram) polynomials of the n places about their middle,
    p[j+1] = u p[j] - b[j] p[j-1] with b[j] = j^2 (n^2 - j^2) / (4 (4 j^2 - 1)), so no system is
    solved; the wanted number is the fit's derivative at the first place.  A series too short for
    the degree gets the highest one that it determines; fewer than 2 points give 0.
    """
    n = F.col("n").cast("double")
    first = -(n - 1) / 2
    p = [[F.lit(1.0)], [F.lit(0.0), F.lit(1.0)]]
    norm, total = n, F.lit(0.0)
    for j in range(1, degree + 1):
        b = F.lit(float(j * j)) * (n * n - j * j) / (4.0 * (4 * j * j - 1))
        norm = norm * b
        slope = sum((k * c * F.pow(first, F.lit(k - 1)) for k, c in enumerate(p[j]) if k), F.lit(0.0))
        weight = sum((c * F.col(f"u{k}") for k, c in enumerate(p[j])), F.lit(0.0))
        total = total + F.when(n > j, slope * F.try_divide(weight, norm)).otherwise(F.lit(0.0))
        before = p[j - 1] + [F.lit(0.0)] * 2
        p.append([up - b * low for up, low in zip([F.lit(0.0), *p[j]], before)])
    return total


def positions(df: DataFrame, group: str, order: list[str], out: str = "position",
              partitions: int | None = None) -> DataFrame:
    """0-based position of each row inside its group under ``order``.

    Rows equal in every key get consecutive positions in some order; such rows
    are indistinguishable, so the result is deterministic as a multiset.
    The sorted range split is checkpointed once with its partition numbers, and both the
    numbering and the chunk sizes read that one copy, so they cannot disagree.  The
    per-partition running count is an Arrow-batched ``mapInPandas`` (batches of one partition
    arrive in sorted order); only chunks that continue a group from an earlier partition need
    an offset, and there are at most #partitions of those, so that table is broadcast.
    """
    keys = [group, *order]
    df = df.where(F.col(group).isNotNull())
    ranged = cut_lineage(_ranged(df, keys, partitions).withColumn("_p", F.spark_partition_id()))
    schema = StructType(list(ranged.schema.fields) + [StructField("_local", LongType(), False)])

    def number(batches):
        last, run = None, 0  # group value ending the previous batch, its rows so far
        for pdf in batches:
            if pdf.empty:
                pdf["_local"] = pd.Series([], dtype="int64")
                yield pdf
                continue
            g = pdf[group]
            new_block = g.ne(g.shift()).to_numpy()
            new_block[0] = not (last is not None and g.iloc[0] == last)
            block = new_block.cumsum()
            local = pdf.groupby(block).cumcount().to_numpy().astype("int64")
            if not new_block[0]:
                local[block == block[0]] += run
            pdf["_local"] = local
            last, run = g.iloc[-1], int(local[-1]) + 1
            yield pdf

    local = ranged.mapInPandas(number, schema)
    chunks = ranged.groupBy(group, "_p").agg(F.count(F.lit(1)).alias("_n"))
    carry = _chunk_offsets(chunks, group).where(F.col("_off") > 0).select(group, "_p", "_off")
    return (local.join(F.broadcast(carry), [group, "_p"], "left")
            .withColumn(out, F.col("_local") + F.coalesce(F.col("_off"), F.lit(0)))
            .drop("_p", "_local", "_off"))
