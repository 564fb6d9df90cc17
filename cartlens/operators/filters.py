"""Projections, filters and row predicates.

Filters compare the raw ``timestamp`` column with literals so Catalyst pushes
them into the Parquet scan (``PushedFilters``); month filters are written as
half-open ranges for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions.timefeat import idx_to_date, month_range, ts_literal
from cartlens.sources.schemas import BUY, VIEW

PRICED_COLUMNS = ["session_id", "timestamp", "user_id", "product_id", "event_type",
                  "offered_discount", "price"]


def select_columns(df: DataFrame, cols=PRICED_COLUMNS) -> DataFrame:
    """P1."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P2."""
    return df.withColumnsRenamed(mapping)


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """P3."""
    return df.drop(*cols)


def filter_event(df: DataFrame, event_type: str = BUY) -> DataFrame:
    """P4."""
    return df.where(F.col("event_type") == event_type)


PARTITION_COLUMN = "month_start"


def prune_months(df: DataFrame, lo, hi_inclusive) -> DataFrame:
    """Mirror a time filter on the month partition column of a month-partitioned log."""
    if PARTITION_COLUMN not in df.columns:
        return df
    lo_m = F.trunc(F.lit(str(lo)[:10]).cast("date"), "MM")
    return df.where((F.col(PARTITION_COLUMN) >= lo_m)
                    & (F.col(PARTITION_COLUMN) <= F.lit(str(hi_inclusive)[:10]).cast("date")))


def filter_between(df: DataFrame, begin, end, ts: str = "timestamp") -> DataFrame:
    """P5: ``begin < ts < end``, both ends open as in the reference."""
    b, e = ts_literal(begin), ts_literal(end)
    return prune_months(df, b, e).where((F.col(ts) > F.lit(b).cast("timestamp_ntz"))
                                  & (F.col(ts) < F.lit(e).cast("timestamp_ntz")))


def month_bounds(year: int, month: int) -> tuple[str, str]:
    idx = year * 12 + month - 1
    return str(idx_to_date(idx)), str(idx_to_date(idx + 1))


def filter_month(df: DataFrame, year: int, month: int, ts: str = "timestamp") -> DataFrame:
    """Rows of one calendar month as a prunable half-open range."""
    lo, hi = month_bounds(year, month)
    return prune_months(df, lo, lo).where((F.col(ts) >= F.lit(lo).cast("timestamp_ntz"))
                                    & (F.col(ts) < F.lit(hi).cast("timestamp_ntz")))


def month_window_filter(df: DataFrame, begin, end, extra_months: int = 0,
                        ts: str = "timestamp") -> DataFrame:
    """Rows from the first month start in [begin, end] up to ``extra_months`` after the last.

    Used to prune the scan before monthly aggregation: a window that reads
    months m+1 and m+2 needs exactly ``extra_months=2``.
    """
    first, last = month_range(begin, end)
    lo, hi = idx_to_date(first), idx_to_date(last + 1 + extra_months)
    return prune_months(df, lo, idx_to_date(last + extra_months)).where(
        (F.col(ts) >= F.lit(str(lo)).cast("timestamp_ntz"))
        & (F.col(ts) < F.lit(str(hi)).cast("timestamp_ntz")))


def drop_missing(df: DataFrame, cols=("user_id", "product_id")) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL."""
    return df.dropna(subset=list(cols))


def rows_missing(df: DataFrame, col: str) -> DataFrame:
    """P8."""
    return df.where(F.col(col).isNull())


# Event type codes of the exploration (unknown types become NULL).
EVENT_CODES = {VIEW: 0, BUY: 1}


def event_code(col: str = "event_type") -> Column:
    """VIEW_PRODUCT -> 0, BUY_PRODUCT -> 1, anything else -> NULL."""
    c = F.col(col)
    expr = None
    for name, code in EVENT_CODES.items():
        expr = (F.when(c == name, F.lit(code)) if expr is None
                else expr.when(c == name, F.lit(code)))
    return expr.cast("int")


def map_values(df: DataFrame, col: str = "event_type", out: str = "event_code") -> DataFrame:
    return df.withColumn(out, event_code(col))


def purchase_value(event_type: str = "event_type", price: str = "price") -> Column:
    """P10: the price on a buy, 0 otherwise."""
    return F.when(F.col(event_type) == BUY, F.col(price)).otherwise(F.lit(0.0))


def fill_zero(df: DataFrame, cols) -> DataFrame:
    """NULL -> 0 in ``cols``."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
                           for c in cols})


def split_by_month(df: DataFrame, month: int = 3, ts: str = "timestamp") -> DataFrame:
    """``split`` = 'test' for rows of calendar month ``month`` (any year), else 'train'."""
    return df.withColumn("split", F.when(F.month(F.col(ts)) == month, F.lit("test"))
                         .otherwise(F.lit("train")))


def check_windows(train: tuple, val: tuple, gap_months: int = 2,
                  allow_overlap: bool = False) -> None:
    """P13 guard: validation months must start ``gap_months`` after the training months.

    Labels of month m read month m+2, so a smaller gap leaks validation spend
    into training labels.
    """
    t0, t1 = month_range(*train)
    v0, v1 = month_range(*val)
    if allow_overlap:
        return
    if v0 <= t1 + gap_months and t0 <= v1 + gap_months:
        raise ValueError(
            f"train window {train} and validation window {val} overlap or are closer "
            f"than {gap_months} months; pass allow_overlap=True to accept that")


def user_history(df: DataFrame, user_id: int, event_type: str | None = None) -> DataFrame:
    """One user's rows, optionally of one event type."""
    out = df.where(F.col("user_id") == F.lit(user_id))
    return out if event_type is None else filter_event(out, event_type)


def product_lookup(products: DataFrame, product_id: int) -> DataFrame:
    """P15."""
    return products.where(F.col("product_id") == F.lit(product_id))


def price_quality(products: DataFrame, huge: float = 100000.0) -> DataFrame:
    """P15 check: how many prices are negative, huge or missing, and duplicate product ids.

    A partial aggregate per product id, then one global aggregate over it, so
    the duplicate check needs no second scan and no join.
    """
    price = F.col("price")
    per_id = products.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(price < 0).alias("neg"),
        F.count_if(price > huge).alias("huge"),
        F.count_if(price.isNull()).alias("missing"))
    return per_id.agg(
        F.sum("n").alias("products"),
        F.sum("neg").alias("negative_prices"),
        F.sum("huge").alias("huge_prices"),
        F.sum("missing").alias("missing_prices"),
        F.count_if(F.col("n") > 1).alias("duplicated_ids"))


def missing_purchase_among_views(df: DataFrame) -> DataFrame:
    """Share of NULL purchase_id among views (1.0 means 'missing = no purchase')."""
    views = filter_event(df, VIEW)
    return views.agg(F.count(F.lit(1)).alias("views"),
                     F.avg(F.col("purchase_id").isNull().cast("int")).alias("null_share"))
