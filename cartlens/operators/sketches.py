"""Distinct users, sessions and products over any span of months, from stored sketches.

One pass gives a HyperLogLog sketch per month and column; a span unites the sketches of its months.
The table has one row a month, so no span reads the log again.  With ``lg_k`` bits the relative
standard error is about 1.04 / sqrt(2 ** lg_k).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions.timefeat import month_idx, month_range

COLUMNS = ("user_id", "session_id", "product_id")


def standard_error(lg_k: int = 12) -> float:
    return 1.04 / math.sqrt(2 ** lg_k)


def month_sketches(sessions: DataFrame, columns=COLUMNS, lg_k: int = 12) -> DataFrame:
    """One row per month: ``month_idx``, ``rows`` and a sketch of each column (NULLs are left out)."""
    return sessions.groupBy(month_idx().alias("month_idx")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.hll_sketch_agg(c, lg_k).alias(c) for c in columns])


def distinct_between(sketches: DataFrame, begin, end, columns=COLUMNS) -> DataFrame:
    """Estimated distinct values of each column over the month starts in [begin, end]."""
    first, last = month_range(begin, end)
    inside = sketches.where(F.col("month_idx").between(first, last))
    united = inside.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *[F.hll_union_agg(c).alias(c) for c in columns])
    return united.select("rows", *[F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).alias(c) for c in columns])


def distinct_running(sketches: DataFrame, months: int, columns=COLUMNS) -> DataFrame:
    """For every month the distinct values of the ``months`` months that end with it.

    Each month's sketches are dealt to the spans that hold it (``months`` rows a month) and united.
    """
    spans = sketches.withColumn("to_month", F.explode(F.sequence(F.col("month_idx"), F.col("month_idx") + months - 1)))
    last = sketches.agg(F.max("month_idx")).first()[0]
    return (spans.where(F.col("to_month") <= F.lit(last)).groupBy("to_month").agg(
        F.sum("rows").alias("rows"), *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns]))
