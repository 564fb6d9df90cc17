"""Calendar parts, cyclic encodings, month arithmetic, A/B arm.

All are Column expressions (JVM side, inside whole-stage codegen).
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TWO_PI = 2.0 * math.pi


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_timestamp(col, fmt: str | None = None, strict: bool = False) -> Column:
    """parse text to a wall-clock (zone-less) timestamp.

    ``strict=False`` gives NULL on bad input: the zone-less parse only runs
    where a lenient parse succeeded, so no session time zone is involved.
    """
    col = _c(col)
    ntz = F.to_timestamp_ntz(col, F.lit(fmt)) if fmt else F.to_timestamp_ntz(col)
    if strict:
        return ntz
    ok = F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)
    return F.when(ok.isNotNull(), ntz)


def parse_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    return F.to_date(_c(col), fmt)


def month_idx(ts="timestamp") -> Column:
    """Months since year 0: ``12 * year + month - 1``; consecutive months differ by 1."""
    ts = _c(ts)
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")


def year_of_idx(idx="month_idx") -> Column:
    return F.floor(_c(idx) / 12).cast("int")


def month_of_idx(idx="month_idx") -> Column:
    return (F.pmod(_c(idx), F.lit(12)) + 1).cast("int")


def month_start_of_idx(idx="month_idx") -> Column:
    return F.make_date(year_of_idx(idx), month_of_idx(idx), F.lit(1))


def weekday_sunday0(ts="timestamp") -> Column:
    """``strftime('%w')``: 0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def time_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """date, time of day, day, month, year, hour and weekday columns."""
    t = F.col(ts)
    return df.withColumns({
        "date": F.to_date(t),
        "time": F.date_format(t, "HH:mm:ss"),
        "day": F.dayofmonth(t),
        "month": F.month(t),
        "year": F.year(t),
        "hour": F.hour(t),
        "weekday": weekday_sunday0(t),
    })


def cyclic(col, period: float) -> tuple[Column, Column]:
    """(sin, cos) of ``2*pi*value/period``."""
    angle = _c(col).cast("double") * F.lit(TWO_PI / period)
    return F.sin(angle), F.cos(angle)


def cyclic_hour(ts="timestamp", period: float = 23.0) -> tuple[Column, Column]:
    """the exploration used period 23 (hours 0 and 23 coincide); 24 is the sound value."""
    return cyclic(F.hour(_c(ts)), period)


def cyclic_month(month="month") -> tuple[Column, Column]:
    """month 1..12 on the unit circle."""
    return cyclic(_c(month), 12.0)


def next_month_start(ts, k: int = 1) -> Column:
    """first day of the k-th following month (December wraps to January)."""
    return F.add_months(F.trunc(F.to_date(_c(ts)), "MM"), k)


def _as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    text = str(value).strip().replace(".", "-").replace("/", "-")
    return _dt.date.fromisoformat(text[:10])


def ts_literal(value) -> str:
    """A date or date-time parameter as an ISO string Spark can cast.

    Accepts ``datetime``/``date`` objects and text such as ``2019.09.01`` or
    ``2019/09/01 10:00`` (the reference wrote dates with dots).
    """
    if isinstance(value, _dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, _dt.date):
        return value.isoformat()
    text = str(value).strip()
    return text[:10].replace(".", "-").replace("/", "-") + text[10:]


def month_range(begin, end) -> tuple[int, int]:
    """month starts inside the closed range [begin, end] as (first, last) month_idx.

    Same months as a month-start date range: a begin after the 1st starts with
    the following month.  Parameters only, no data is touched.
    """
    b, e = _as_date(begin), _as_date(end)
    first = b.year * 12 + b.month - 1 + (0 if b.day == 1 else 1)
    last = e.year * 12 + e.month - 1
    return first, last


def idx_to_date(idx: int) -> _dt.date:
    return _dt.date(idx // 12, idx % 12 + 1, 1)


def month_starts(spark: SparkSession, begin, end) -> DataFrame:
    """one row per month start in [begin, end] (``month_idx``, ``month_start``)."""
    first, last = month_range(begin, end)
    if last < first:
        return spark.range(0).select(F.lit(0).alias("month_idx"),
                                     F.current_date().alias("month_start"))
    return (spark.range(first, last + 1).select(F.col("id").cast("int").alias("month_idx"))
            .withColumn("month_start", month_start_of_idx("month_idx")))


def day_range(spark: SparkSession, begin, end) -> DataFrame:
    """every calendar day of [begin, end] (bounded by the parameters)."""
    b, e = _as_date(begin), _as_date(end)
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(b), F.lit(e), F.expr("INTERVAL 1 DAY"))).alias("date"))


PREDICTION_TIME_FORMAT = "MM/dd/yyyy HH:mm:ss:SSSSSS"


def now_formatted() -> Column:
    """current time as ``%m/%d/%Y %H:%M:%S:%f``."""
    return F.date_format(F.current_timestamp(), PREDICTION_TIME_FORMAT)


def arm_of(user="user_id", salt: int = 0) -> Column:
    """stable 0/1 arm per user: the parity of md5("salt:user") (a NULL user counts as '')."""
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(_c(user).cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % 2).cast("int")
