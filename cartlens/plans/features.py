"""The reference's feature jobs as single Spark plans.

C1 (``training_set_v3``) replaced a Python loop over months (28 iterations,
each re-joining and re-aggregating) with: one pre-aggregate per (user, month),
one range-frame window per user, one filter, one projection, one dedupe.
The scan is pruned to the months the window can read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions.timefeat import (
    _as_date, cyclic_month, idx_to_date, month_of_idx, month_range, ts_literal, year_of_idx,
)
from cartlens.operators.filters import month_window_filter
from cartlens.operators.monthly import spend_label, user_month_facts, user_month_next

V3_COLUMNS = ["year", "buying_events_month_first", "buying_events_month_second",
              "all_events_month_first", "all_events_month_second", "first_month_sin",
              "first_month_cos", "spent_money_first_month", "spent_money_second_month", "label"]

V2_COLUMNS = ["year", "month", "month_sin", "month_cos", "buying_sessions", "label",
              "spent_money", "spent_money_first_month", "spent_money_second_month",
              "buying_events_first_month", "buying_events_second_month",
              "all_events_first_month", "all_events_second_month"]

V1_COLUMNS = ["year", "month", "user_id", "month_sin", "month_cos", "buying_sessions",
              "spent_money", "first_month", "second_month", "buying_events_first_month",
              "buying_events_second_month"]


def user_month_rows(sessions: DataFrame, products: DataFrame, begin, end,
                    threshold: float = 100.0, require_full_window: bool = False,
                    keep_third: bool = False, net_price: bool = False) -> DataFrame:
    """C1 before the user id is dropped: one row per first-month buyer and month.

    Month m runs over the month starts in [begin, end].  The scan keeps only
    months m..m+2 of that range; the window is evaluated BEFORE the months are
    filtered, so the last months still see m+1 and m+2.
    """
    first, last = month_range(begin, end)
    pruned = month_window_filter(sessions, begin, end, extra_months=2)
    rows = rows_of_facts(user_month_facts(pruned, products, net_price=net_price), first, last, threshold, keep_third)
    if require_full_window:
        last_seen = pruned.agg(F.max("timestamp")).first()[0]
        if last_seen is not None:
            last_idx = last_seen.year * 12 + last_seen.month - 1
            rows = rows.where(F.col("month_idx") + 2 <= F.lit(last_idx))
    return rows


def rows_of_facts(facts: DataFrame, first: int, last: int, threshold: float = 100.0, keep_third: bool = False) -> DataFrame:
    """The rows of ``user_month_rows`` for the months first..last from a user-month fact table
    that holds the months first..last + 2 (stored or just computed)."""
    nxt = user_month_next(facts)
    rows = nxt.where(F.col("month_idx").between(first, last) & (F.col("buys") > 0))
    sin, cos = cyclic_month(month_of_idx("month_idx"))
    return rows.select(
        "user_id", "month_idx",
        year_of_idx("month_idx").alias("year"),
        F.col("buys").alias("buying_events_month_first"),
        F.col("buys_next").alias("buying_events_month_second"),
        F.col("events").alias("all_events_month_first"),
        F.col("events_next").alias("all_events_month_second"),
        sin.alias("first_month_sin"), cos.alias("first_month_cos"),
        F.col("spend").cast("double").alias("spent_money_first_month"),
        F.col("spend_next").cast("double").alias("spent_money_second_month"),
        spend_label("spend", "spend_next", "spend_next2", threshold).cast("int").alias("label"),
        *([F.col("spend_next2").cast("double").alias("spend_third")] if keep_third else []))


def training_sets(sessions: DataFrame, products: DataFrame, windows: dict[str, tuple],
                  threshold: float = 100.0, net_price: bool = False,
                  dedupe: bool = True) -> DataFrame:
    """C1 for several month windows in ONE plan, tagged with a ``split`` column.

    One pruned scan over the hull of the windows (plus the two months every
    label reads), one pre-aggregate, one range-frame window.  Each user-month
    row is tagged with every window its month lies in (``explode`` keeps
    overlapping windows correct), then duplicates are dropped per split --
    the same rows as running ``training_set_v3`` once per window.
    """
    bounds = {name: month_range(*w) for name, w in windows.items()}
    lo = min(b[0] for b in bounds.values())
    hi = max(b[1] for b in bounds.values())
    hull = (str(idx_to_date(lo)), str(idx_to_date(hi)))
    rows = user_month_rows(sessions, products, *hull, threshold=threshold, net_price=net_price)
    m = F.col("month_idx")
    tags = F.array(*[F.when(m.between(a, b), F.lit(name)) for name, (a, b) in bounds.items()])
    tagged = rows.withColumn("split", F.explode(F.filter(tags, lambda x: x.isNotNull())))
    out = tagged.select(*V3_COLUMNS, "split")
    return out.dropDuplicates() if dedupe else out


def training_set_v3(sessions: DataFrame, products: DataFrame, begin, end,
                    threshold: float = 100.0, require_full_window: bool = False,
                    dedupe: bool = True, net_price: bool = False) -> DataFrame:
    """The final feature job.  Label last, as the model code expects.

    Duplicates are dropped after user and month are removed, so two users with
    equal features in one month give one training row (as in the reference;
    ``year`` with sin/cos identifies the month, so one global dedupe equals the
    per-month dedupe).
    """
    rows = user_month_rows(sessions, products, begin, end, threshold, require_full_window,
                           net_price=net_price)
    out = rows.select(*V3_COLUMNS)
    return out.dropDuplicates() if dedupe else out


def open_window_months(begin, end) -> tuple[int, int]:
    """Months that overlap the open interval (begin, end).

    An end at midnight of the 1st leaves its month out; later on that day it does not.
    """
    b, e = _as_date(begin), _dt.datetime.fromisoformat(ts_literal(end))
    first = b.year * 12 + b.month - 1
    last = e.year * 12 + e.month - 1
    if e == _dt.datetime(e.year, e.month, 1):
        last -= 1
    return first, max(first, last)


def _v12_rows(sessions: DataFrame, products: DataFrame, begin, end,
              threshold: float) -> DataFrame:
    """Shared plan of C2/C3: one pre-aggregate, one per-user aggregate, one explode.

    * scans: the window's calendar years (pruned) and the user column of the log;
    * spine: every user of the log x every month overlapping (begin, end);
    * year-level counts (whole years) and window spend repeat on every row of
      their year -- computed as per-user conditional sums for the few years
      the window touches, so no join is needed;
    * first/second-month counts sit only on the row of that month;
    * first/second-month spend repeats on every row of the user.
    """
    first, last = open_window_months(begin, end)
    m0, m1, m2 = first, first + 1, first + 2
    years = sorted({m // 12 for m in range(first, last + 1)})
    # Every value on a spine row comes from the calendar years the window
    # touches (year counts cover whole years), so the main scan is pruned to
    # them; only the user list needs the whole log, as one column.
    in_years = month_window_filter(sessions, f"{years[0]:04d}-01-01", f"{years[-1]:04d}-12-01")
    facts = user_month_facts(in_years, products, spend_window=(begin, end))
    m, yr = F.col("month_idx"), year_of_idx("month_idx")

    def at(month, col):
        return F.sum(F.when(m == month, F.col(col)))

    aggs = [at(m0, "buys").alias("b0"), at(m1, "buys").alias("b1"),
            at(m0, "events").alias("e0"), at(m1, "events").alias("e1"),
            at(m0, "spend").alias("s0"), at(m1, "spend").alias("s1"), at(m2, "spend").alias("s2"),
            at(m0, "window_buys").alias("wb0")]
    for y in years:
        aggs += [F.sum(F.when(yr == y, F.col("buys"))).alias(f"yb{y}"),
                 F.sum(F.when(yr == y, F.col("spend"))).alias(f"ys{y}")]
    per_user = facts.groupBy("user_id").agg(*aggs)
    users = sessions.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    # both sides are hash-partitioned by user_id: the join adds no exchange
    per_user = users.join(per_user, "user_id", "left")

    spine = per_user.withColumn("month_idx", F.explode(F.sequence(F.lit(first), F.lit(last))))
    year = year_of_idx("month_idx")

    def by_year(prefix):
        expr = F.lit(None)
        for y in years:
            expr = F.when(year == y, F.col(f"{prefix}{y}")).otherwise(expr)
        return expr

    zero_l, zero_m = F.lit(0).cast("bigint"), F.lit(0).cast("decimal(38,6)")
    s0 = F.coalesce("s0", zero_m)
    s1 = F.coalesce("s1", zero_m)
    s2 = F.coalesce("s2", zero_m)
    first_buyer = F.coalesce(F.col("wb0"), zero_l) > 0
    over = (2 * s2 - (s0 + s1)) > F.lit(2 * threshold).cast("decimal(38,6)")
    label = F.when(first_buyer & over, F.lit(1)).otherwise(F.lit(0))
    sin, cos = cyclic_month(month_of_idx("month_idx"))
    on_m0 = F.col("month_idx") == m0
    on_m1 = F.col("month_idx") == m1
    return spine.select(
        "user_id", year.alias("year"), month_of_idx("month_idx").alias("month"),
        sin.alias("month_sin"), cos.alias("month_cos"),
        F.coalesce(by_year("yb"), zero_l).cast("bigint").alias("buying_sessions"),
        label.cast("int").alias("label"),
        F.coalesce(by_year("ys"), zero_m).cast("double").alias("spent_money"),
        s0.cast("double").alias("spent_money_first_month"),
        s1.cast("double").alias("spent_money_second_month"),
        F.when(on_m0, F.coalesce("b0", zero_l)).otherwise(zero_l).alias("buying_events_first_month"),
        F.when(on_m1, F.coalesce("b1", zero_l)).otherwise(zero_l).alias("buying_events_second_month"),
        F.when(on_m0, F.coalesce("e0", zero_l)).otherwise(zero_l).alias("all_events_first_month"),
        F.when(on_m1, F.coalesce("e1", zero_l)).otherwise(zero_l).alias("all_events_second_month"))


def features_v2(sessions: DataFrame, products: DataFrame, begin, end,
                threshold: float = 100.0) -> DataFrame:
    """User-month spine with year counts, window spend, month counts and label; deduped."""
    rows = _v12_rows(sessions, products, begin, end, threshold)
    return rows.select(*V2_COLUMNS).dropDuplicates()


def features_v1(sessions: DataFrame, products: DataFrame, begin, end) -> DataFrame:
    """As C2 without label, all-event counts or dedupe; keeps user_id."""
    rows = _v12_rows(sessions, products, begin, end, 100.0)
    return rows.select(
        "year", "month", "user_id", "month_sin", "month_cos", "buying_sessions", "spent_money",
        F.col("spent_money_first_month").alias("first_month"),
        F.col("spent_money_second_month").alias("second_month"),
        "buying_events_first_month", "buying_events_second_month")
