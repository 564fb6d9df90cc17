"""Joins of the session log.

No broadcast hints on data-sized inputs: Spark's size threshold (static
statistics, then AQE's runtime sizes) decides when ``products`` is small
enough to broadcast, and falls back to a sort-merge join otherwise.  Only
inputs bounded by parameters (calendar days) are hinted.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.functions.timefeat import day_range, month_range, month_start_of_idx, ts_literal
from cartlens.operators.filters import filter_event, prune_months
from cartlens.sources.schemas import BUY


NULL_SPREAD = 4096          # partitions at most that rows without a product id are spread over


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's statistics of the input (not a guess) put it under its own broadcast threshold."""
    spark = df.sparkSession
    try:
        limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return 0 <= int(str(size)) <= int(limit)
    except Exception:  # noqa: BLE001 - Spark Connect: no plan statistics on this side
        return False


# -- hot keys --------------------------------------------------------------------

def hot_keys(df: DataFrame, key: str, share: float = 0.01, tracked: int = 10_000) -> list:
    """Keys that hold at least ``share`` of the rows with a key, by a mergeable frequent-items sketch.

    One pass; a task's sketch holds ``tracked`` items at most and at most ``1 / share`` keys
    come to the driver.  A sketch of this size overestimates a count by less than a share of
    4 / ``tracked``, so no key at or above ``share`` is missed.
    """
    found = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{key}`, {math.ceil(1 / share)}, {tracked})").alias("top")).first()
    return [x[0] for x in found["top"] or () if x[1] >= share * found["rows"]]


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: list, how: str = "inner", salts: int = 64) -> DataFrame:
    """Join on ``key``; rows of ``left`` with a ``hot`` key are spread over ``salts`` partitions.

    Only the hot keys' rows of ``right`` are repeated (once a salt); all other rows keep salt 0.
    ``right`` rows are few for a key (a product table), ``left`` rows may be any share of the log.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join is inner or left")
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    others = [F.col(f"`{c}`") for c in left.columns if c != key]
    salt = F.pmod(F.xxhash64(*others), F.lit(salts)) if others else F.pmod(F.monotonically_increasing_id(), F.lit(salts))
    dealt = left.withColumn("_salt", F.when(is_hot, salt).otherwise(F.lit(0).cast("bigint")))
    copies = F.when(is_hot, F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(
        F.array(F.lit(0).cast("bigint")))
    return dealt.join(right.withColumn("_salt", F.explode(copies)), [key, "_salt"], how).drop("_salt")


def with_price(sessions: DataFrame, products: DataFrame, how: str = "inner", hot: list | None = None) -> DataFrame:
    """J1 (inner) / J2 (left): attach ``price`` on product_id.

    ``hot`` (from ``hot_keys``) names products whose rows are salted where the join is shuffled.
    Only product_id and price of the product table are read (column pruning).  In a left join
    rows without a product id match nothing but still need a partition: a second key that is
    random for them and 0 for all others spreads them, so no task gets all of them.
    """
    products = products.select("product_id", "price")
    if hot and not fits_broadcast(products):
        with_id = salted_join(sessions.where(F.col("product_id").isNotNull()), products, "product_id", hot, how)
        if how == "inner":
            return with_id
        rest = sessions.where(F.col("product_id").isNull()).withColumn("price", F.lit(None).cast(products.schema["price"].dataType))
        return with_id.unionByName(rest)
    if how != "left":
        return sessions.join(products, "product_id", how)
    spread = F.when(F.col("product_id").isNull(), F.pmod(F.xxhash64("session_id", "timestamp"), F.lit(NULL_SPREAD)))
    keyed = sessions.withColumn("_spread", F.coalesce(spread, F.lit(0).cast("bigint")))
    return (keyed.join(products.withColumn("_spread", F.lit(0).cast("bigint")), ["product_id", "_spread"], "left")
            .drop("_spread"))


def deals(sessions: DataFrame, products: DataFrame) -> DataFrame:
    """Buys left-joined to products; buys of unknown products keep a NULL price."""
    return with_price(filter_event(sessions, BUY), products, "left")


def left_join_keys(driver: DataFrame, *others: tuple[DataFrame, list[str]]) -> DataFrame:
    """Left-join aggregates on their key lists onto a driving table."""
    out = driver
    for other, keys in others:
        out = out.join(other, keys, "left")
    return out


def with_user_totals(facts: DataFrame) -> DataFrame:
    """J3 over one table: month buys (NULL where none), year spend and total spend of each user-month.

    The reference left-joins three aggregates of the same rows on (user, month), (user, year) and
    (user).  Here they are window sums over one partitioning by user: a user has at most one row
    a calendar month.  ``facts`` has user_id, year, month, events, buys and spend.
    """
    year, user = Window.partitionBy("user_id", "year"), Window.partitionBy("user_id")
    # The user window first: its partitioning serves the (user, year) window too.
    rows = facts.withColumn("total_spend", F.sum("spend").over(user)).withColumn("spent_money_year", F.sum("spend").over(year))
    return rows.select("user_id", F.col("events").alias("all_events_month"),
                       F.when(F.col("buys") > 0, F.col("buys")).alias("buying_events_month"),
                       "year", "month", "spent_money_year", "total_spend")


def user_month_spine(sessions: DataFrame, begin, end) -> DataFrame:
    """Every user with a non-null id, once per month start in [begin, end].

    Each distinct user row is expanded with ``explode(sequence(...))`` of the
    parameter months, so the output is users x months without a Cartesian
    join operator; the distinct users are computed with partial aggregation.
    """
    first, last = month_range(begin, end)
    users = sessions.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    spine = users.select("user_id", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("month_idx"))
    start = month_start_of_idx("month_idx")
    return spine.select("user_id", F.year(start).alias("year"), F.month(start).alias("month"),
                        "month_idx")


def _days_seen(sessions: DataFrame, begin, end, ts: str) -> DataFrame:
    """The days of [begin, end] with an event: a pruned half-open range, then a distinct."""
    lo = dt.date.fromisoformat(ts_literal(begin)[:10])
    hi = dt.date.fromisoformat(ts_literal(end)[:10])
    after = hi + dt.timedelta(days=1)
    rows = prune_months(sessions, lo, hi).where(
        (F.col(ts) >= F.lit(str(lo)).cast("timestamp_ntz")) & (F.col(ts) < F.lit(str(after)).cast("timestamp_ntz")))
    return rows.select(F.to_date(F.col(ts)).alias("date")).distinct()


def missing_dates(sessions: DataFrame, begin, end, ts: str = "timestamp") -> DataFrame:
    """Calendar days of [begin, end] with no event at all (left anti join).

    The expected days are bounded by the parameters; the observed days are a
    distinct over the (pruned) scan.
    """
    spark = sessions.sparkSession
    days = day_range(spark, begin, end)
    return days.join(_days_seen(sessions, begin, end, ts), "date", "left_anti")


def date_difference(sessions: DataFrame, begin, end, ts: str = "timestamp") -> DataFrame:
    """The same gap list as ``missing_dates`` written as a set difference (EXCEPT)."""
    spark = sessions.sparkSession
    days = day_range(spark, begin, end)
    return days.subtract(_days_seen(sessions, begin, end, ts))
