"""Aggregate expressions with the reference's edge-case semantics.

* money is summed as DECIMAL so totals do not depend on summation order and
  the strict ``> 100`` label boundary is exact;
* Pearson correlation is NULL when a side is constant (``corr`` raises
  DIVIDE_BY_ZERO in ANSI mode);
* histogram bins close the last bin and collapse a zero-width range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col) -> Column:
    return _c(col).cast(MONEY)


def money_sum(col) -> Column:
    """Exact sum; NULL when no non-null input (callers ``coalesce`` to 0)."""
    return F.sum(money(col))


def money_out(col, digits: int = 2) -> Column:
    """Round a money value in decimal, then expose it as double."""
    return F.round(_c(col), digits).cast("double")


def guarded_corr(x, y) -> Column:
    """Population Pearson correlation, NULL for fewer than 2 rows or a constant side.

    Feed only rows where both sides are non-null: ``covar_pop`` is pairwise,
    ``stddev_pop`` is not.
    """
    x, y = _c(x).cast("double"), _c(y).cast("double")
    constant = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y)) | (F.count(x) < 2)
    return F.when(~constant, F.try_divide(F.covar_pop(x, y),
                                          F.stddev_pop(x) * F.stddev_pop(y)))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram over [min, max] as (bin, bin_lo, bin_hi, rows).

    The input is first reduced to one row per distinct value with its count
    (partial aggregation) and that table is checkpointed; its range is observed
    while it is written, so no pass is made for the range alone.  Two numbers
    (min, max) come to the driver.  Each value goes to bin
    ``least(floor((x - lo) * bins / (hi - lo)), bins - 1)`` (the last bin is
    closed).  All ``bins`` rows are returned, empty ones with 0, so the bins
    sum to the number of non-null values.  A zero-width range gives one bin.
    """
    from cartlens.session import cut_lineage
    spark = df.sparkSession
    x = F.col(col).cast("double")
    seen = Observation()
    counts = cut_lineage(df.select(x.alias("x")).where(F.col("x").isNotNull())
                         .groupBy("x").agg(F.count(F.lit(1)).alias("n"))
                         .observe(seen, F.min("x").alias("lo"), F.max("x").alias("hi")))
    lo, hi = seen.get["lo"], seen.get["hi"]
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, rows bigint")
    if hi == lo:
        return counts.agg(F.sum("n").alias("rows")).select(
            F.lit(0).alias("bin"), F.lit(lo).alias("bin_lo"), F.lit(hi).alias("bin_hi"),
            F.col("rows"))
    span = F.lit(hi) - F.lit(lo)
    binned = (counts
              .select(F.least(F.floor((F.col("x") - F.lit(lo)) * F.lit(bins) / span),
                              F.lit(bins - 1)).cast("int").alias("bin"), "n")
              .groupBy("bin").agg(F.sum("n").alias("rows")))
    width = (hi - lo) / bins
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width)).alias("bin_lo"),
        F.when(F.col("id") == bins - 1, F.lit(hi))
        .otherwise(F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("bin_hi"))
    return (edges.join(binned, "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("rows", F.lit(0)).alias("rows")))
