"""Exploration of the session log.

Per-session facts are computed in ONE ``groupBy(session_id)`` (count of
products, bought-anything flag, first and last time), which replaces the
reference's separate series joined by index (J6).  Every aggregate here is
algebraic, so Spark combines map-side before the shuffle and a hot session or
product only costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cartlens.functions.stats import histogram
from cartlens.operators.filters import event_code
from cartlens.sources.schemas import BUY, VIEW

SECONDS_PER_DAY = 86400


def event_type_counts(df: DataFrame) -> DataFrame:
    """A1: rows per event type."""
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


def discount_counts(df: DataFrame) -> DataFrame:
    """A2: rows per offered discount."""
    return df.groupBy("offered_discount").agg(F.count(F.lit(1)).alias("rows"))


def session_summary(df: DataFrame) -> DataFrame:
    """A3 + A4 + A6 (+ J6) in one pass per session (rows without a session id belong to none).

    * ``n_products``: non-null product ids (buys count as well as views);
    * ``bought``: 1 if any BUY_PRODUCT (the reference's string minimum);
    * ``seconds_total``: whole seconds between first and last event;
    * ``seconds_mod_day``: the same modulo one day, which is what
      ``timedelta.seconds`` returned in the reference.
    """
    per = df.where("session_id IS NOT NULL").groupBy("session_id").agg(
        F.count("product_id").alias("n_products"),
        F.coalesce(F.max((F.col("event_type") == BUY).cast("int")), F.lit(0)).alias("bought"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"))
    total = F.timestamp_diff("SECOND", F.col("first_ts"), F.col("last_ts"))
    return per.select(
        "session_id", "n_products", "bought",
        total.alias("seconds_total"),
        F.pmod(total, F.lit(SECONDS_PER_DAY)).alias("seconds_mod_day"))


def session_product_count(df: DataFrame) -> DataFrame:
    """A3."""
    return (df.where("session_id IS NOT NULL").groupBy("session_id")
            .agg(F.count("product_id").alias("n_products")))


def session_outcome(df: DataFrame) -> DataFrame:
    """A4: 1 if the session holds any buy."""
    return df.where("session_id IS NOT NULL").groupBy("session_id").agg(
        F.coalesce(F.max((F.col("event_type") == BUY).cast("int")), F.lit(0)).alias("bought"))


def purchase_prob_by_views(df: DataFrame) -> DataFrame:
    """A5: mean session outcome per number of products in the session.

    Two aggregations, no join: per session, then per product count.
    """
    return (session_summary(df)
            .groupBy("n_products")
            .agg(F.avg("bought").alias("purchase_prob"),
                 F.count(F.lit(1)).alias("sessions")))


def session_duration(df: DataFrame) -> DataFrame:
    """A6/F8."""
    return session_summary(df).select("session_id", "seconds_total", "seconds_mod_day")


def duration_outcome(df: DataFrame, sort: bool = True) -> DataFrame:
    """Duration with outcome, sorted by duration (order only matters at a sink)."""
    out = session_summary(df).select("session_id", "seconds_total", "seconds_mod_day", "bought")
    return out.orderBy("seconds_mod_day", "session_id") if sort else out


def purchase_prob_by_duration(df: DataFrame, bins: int = 10,
                              duration: str = "seconds_total") -> DataFrame:
    """Purchase rate per equal-width duration bucket.

    Reuses the histogram binning on the per-session rows and adds the mean
    outcome of each bin.
    """
    return _rate_by_bins(session_summary(df), duration, "bought", bins)


def _rate_by_bins(per: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Equal-width bins of ``x`` with row count and mean ``y``.

    Reduced to (x, rows, sum y) and checkpointed once; the range is observed while it is
    written, so no pass is made for the range alone.
    """
    from cartlens.session import cut_lineage
    seen = Observation()
    per = cut_lineage(per.groupBy(F.col(x).alias(x)).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(y).cast("double")).alias("_sy"))
        .observe(seen, F.min(x).alias("lo"), F.max(x).alias("hi")))
    lo, hi = seen.get["lo"], seen.get["hi"]
    spark = per.sparkSession
    if lo is None:
        return spark.createDataFrame(
            [], "bin int, bin_lo double, bin_hi double, sessions bigint, purchase_prob double")
    lo, hi = float(lo), float(hi)
    if hi == lo:
        b = F.lit(0)
    else:
        b = F.least(F.floor((F.col(x).cast("double") - F.lit(lo)) * F.lit(bins)
                            / (F.lit(hi) - F.lit(lo))), F.lit(bins - 1))
    nb = 1 if hi == lo else bins
    width = (hi - lo) / nb
    stats = per.groupBy(b.cast("int").alias("bin")).agg(
        F.sum("_n").alias("sessions"), (F.sum("_sy") / F.sum("_n")).alias("purchase_prob"))
    edges = spark.range(nb).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width)).alias("bin_lo"),
        F.when(F.col("id") == nb - 1, F.lit(hi))
        .otherwise(F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("bin_hi"))
    return edges.join(stats, "bin", "left").select(
        "bin", "bin_lo", "bin_hi", F.coalesce("sessions", F.lit(0)).alias("sessions"),
        "purchase_prob")


def product_purchase_dist(df: DataFrame) -> DataFrame:
    """Buys per product, then how many products have each buy count."""
    per_product = (df.where((F.col("event_type") == BUY) & F.col("product_id").isNotNull())
                   .groupBy("product_id").agg(F.count(F.lit(1)).alias("buys")))
    return per_product.groupBy("buys").agg(F.count(F.lit(1)).alias("products"))


def product_conversion(df: DataFrame) -> DataFrame:
    """A10: mean of the 0/1 event code per product."""
    return (df.where(F.col("product_id").isNotNull())
            .groupBy("product_id")
            .agg(F.avg(event_code()).alias("conversion"), F.count(F.lit(1)).alias("rows")))


def best_conversion(df: DataFrame) -> DataFrame:
    """A10/O3: the highest product conversion (a single-row global aggregate)."""
    return product_conversion(df).agg(F.max("conversion").alias("best_conversion"))


def missing_fraction(df: DataFrame, cols=("user_id", "product_id", "purchase_id")) -> DataFrame:
    """NULL share per column over all rows, over views and over buys.

    One aggregate pass; ``stack`` turns the wide row into one row per column.
    """
    is_view = F.col("event_type") == VIEW
    is_buy = F.col("event_type") == BUY
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        miss = F.col(c).isNull().cast("int")
        aggs += [F.avg(miss).alias(f"a{i}"),
                 F.avg(F.when(is_view, miss)).alias(f"v{i}"),
                 F.avg(F.when(is_buy, miss)).alias(f"b{i}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', a{i}, v{i}, b{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {pairs}) AS (`column`, null_share, null_share_views, null_share_buys)",
        "rows")


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct users, sessions and products (``approx`` uses HyperLogLog++)."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(count("user_id").alias("users"), count("session_id").alias("sessions"),
                  count("product_id").alias("products"))


def distinct_periods(df: DataFrame) -> DataFrame:
    """The distinct years, months and users as (kind, value) rows."""
    t = F.col("timestamp")
    pairs = F.array(
        F.struct(F.lit("year").alias("kind"), F.year(t).cast("bigint").alias("value")),
        F.struct(F.lit("month").alias("kind"), F.month(t).cast("bigint").alias("value")),
        F.struct(F.lit("user").alias("kind"), F.col("user_id").cast("bigint").alias("value")))
    # One scan: every row yields its (kind, value) pairs, one distinct over all of them.
    return (df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct())


def data_extent(df: DataFrame) -> DataFrame:
    """First and last timestamp and the row count."""
    return df.agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
                  F.count(F.lit(1)).alias("rows"))


def hist_session_products(df: DataFrame, bins: int = 10) -> DataFrame:
    """A15 on products per session."""
    return histogram(session_summary(df), "n_products", bins)


def hist_duration(df: DataFrame, bins: int = 10, duration: str = "seconds_mod_day") -> DataFrame:
    """A15 on session duration (``seconds_mod_day`` is what the reference plotted)."""
    return histogram(session_summary(df), duration, bins)


def hist_discount(df: DataFrame, bins: int = 20) -> DataFrame:
    """A15 on offered discount (20 bins as in the reference)."""
    return histogram(df, "offered_discount", bins)


def conversion_by_discount(df: DataFrame) -> DataFrame:
    """Mean 0/1 event code per discount (rows without a discount left out)."""
    return df.where("offered_discount IS NOT NULL").groupBy("offered_discount").agg(F.avg(event_code()).alias("conversion"),
                                              F.count(F.lit(1)).alias("rows"))
