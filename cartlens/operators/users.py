"""Per-user features of the exploration.

Input is the priced row set (sessions inner-joined to products, with
``purchase`` = price on buys, else 0), usually the training part only.
Rows without a user are dropped first: pandas drops NULL group keys, Spark
would keep a NULL group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions.stats import guarded_corr, money_sum
from cartlens.operators.filters import purchase_value
from cartlens.operators.joins import with_price
from cartlens.operators.ordered import centred_moments, linear_coefficient, positions, slope_from_sums, trend_sums

# Total order of a user's purchases (the reference relied on file order).
TREND_ORDER = ["timestamp", "session_id", "product_id"]


def purchase_rows(sessions: DataFrame, products: DataFrame) -> DataFrame:
    """J1 + P10: sessions with a known product, plus ``price`` and ``purchase``."""
    return with_price(sessions, products, "inner").withColumn("purchase", purchase_value())


def _users(df: DataFrame) -> DataFrame:
    return df.where(F.col("user_id").isNotNull())


def user_mean_discount(df: DataFrame) -> DataFrame:
    """A18."""
    return _users(df).groupBy("user_id").agg(F.avg("offered_discount").alias("mean_discount"))


def user_total_spend(df: DataFrame) -> DataFrame:
    """Exact (decimal) sum of ``purchase`` per user."""
    return _users(df).groupBy("user_id").agg(
        F.coalesce(money_sum("purchase"), F.lit(0).cast("decimal(38,6)")).alias("total_sum"))


def user_corr_discount(df: DataFrame) -> DataFrame:
    """Pearson(purchase, offered_discount) per user; NULL if a side is constant."""
    pairs = _users(df).where(F.col("purchase").isNotNull() & F.col("offered_discount").isNotNull())
    return pairs.groupBy("user_id").agg(
        guarded_corr("purchase", "offered_discount").alias("corr_purchase_discount"))


def user_spending_trend(df: DataFrame, partitions: int | None = None, order: int = 1) -> DataFrame:
    """Slope of the user's non-zero purchases against their position 0..n-1.

    With ``order`` above 1 (up to 5) a polynomial of that order is fitted and the coefficient of
    its linear term returned, as the reference's function does.  Fewer than two non-zero purchases
    -> 0.  Only users with at least one non-zero purchase appear; ``user_features`` gives the rest 0.
    """
    if not 1 <= order <= 5:
        raise ValueError("the order of a trend is 1 to 5")
    nz = _users(df).where(F.col("purchase").isNotNull() & (F.col("purchase") != 0))
    if order > 1:
        moments = centred_moments(nz, "user_id", TREND_ORDER + ["purchase"], "purchase", order, partitions)
        return moments.select("user_id", linear_coefficient(order).alias("spending_trend"))
    sums = trend_sums(nz, "user_id", TREND_ORDER + ["purchase"], "purchase", partitions)
    return sums.select("user_id", slope_from_sums().alias("spending_trend"))


def user_features(df: DataFrame, partitions: int | None = None, trend_order: int = 1) -> DataFrame:
    """Total, mean discount, correlation and trend per user in one frame.

    A18-A20 come from ONE aggregate over the user key; the trend is left-joined
    on the same key, and users without purchases keep trend 0.
    """
    users = _users(df)
    pair_ok = F.col("purchase").isNotNull() & F.col("offered_discount").isNotNull()
    base = users.groupBy("user_id").agg(
        F.coalesce(money_sum("purchase"), F.lit(0).cast("decimal(38,6)")).alias("total_sum"),
        F.avg("offered_discount").alias("mean_discount"),
        guarded_corr(F.when(pair_ok, F.col("purchase")),
                     F.when(pair_ok, F.col("offered_discount"))).alias("corr_purchase_discount"))
    trend = user_spending_trend(users, partitions, trend_order)
    return (base.join(trend, "user_id", "left")
            .withColumn("spending_trend", F.coalesce("spending_trend", F.lit(0.0))))


def purchase_position(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """0-based position of each non-zero purchase among the user's purchases."""
    nz = _users(df).where(F.col("purchase").isNotNull() & (F.col("purchase") != 0)).select(
        "user_id", *TREND_ORDER, "purchase")
    return positions(nz, "user_id", TREND_ORDER + ["purchase"], "position", partitions)
