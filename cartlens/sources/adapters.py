"""Adapters from the driver's Parquet tables to the session/product schema.

``events`` covers one month of clicks and serves the session exploration
([E]); ``lineitem`` joined to ``orders`` spans years and serves the monthly
feature work ([L]).  Both produce exactly the columns of ``schemas.SESSIONS``.

The mappings (fixed values, mirrored by the oracle SQL in plans/oracle.py):

[E] events -> sessions
  session_id        user_id * 100000 + days since 1970-01-01 of ts (one session per user-day)
  timestamp         ts
  user_id           user_id
  product_id        props $.k
  event_type        purchase -> BUY_PRODUCT; view, click -> VIEW_PRODUCT; others upper-cased
  offered_discount  (k % 5) * 5
  purchase_id       event_id on buys, else NULL

[L] lineitem JOIN orders -> sessions
  session_id        l_orderkey
  timestamp         l_shipdate
  user_id           o_custkey
  product_id        l_partkey
  event_type        l_returnflag = 'R' -> BUY_PRODUCT, else VIEW_PRODUCT
  offered_discount  round(l_discount * 100)
  purchase_id       l_orderkey on buys, else NULL
  with nulls        user_id NULL when l_orderkey % 19 = 0; product_id NULL when l_linenumber = 7
                    (the real log misses ~5% of both; the driver tables have no NULLs)

products <- part: product_id = p_partkey, price = p_retailprice
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.sources.schemas import BUY, VIEW

SESSION_COLUMNS = ["session_id", "timestamp", "user_id", "product_id", "event_type",
                   "offered_discount", "purchase_id"]

# Fixed values of the adapters.
SESSION_DAY_FACTOR = 100000
USER_NULL_MODULUS = 19
PRODUCT_NULL_LINENUMBER = 7


def sessions_from_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    is_buy = F.col("event_type") == "purchase"
    is_view = F.col("event_type").isin("view", "click")
    return (events
            .select(
                (F.col("user_id") * SESSION_DAY_FACTOR
                 + F.unix_date(F.to_date("ts"))).cast("bigint").alias("session_id"),
                F.col("ts").alias("timestamp"),
                F.col("user_id").cast("bigint").alias("user_id"),
                k.alias("product_id"),
                F.when(is_buy, F.lit(BUY)).when(is_view, F.lit(VIEW))
                .otherwise(F.upper("event_type")).alias("event_type"),
                ((k % 5) * 5).cast("int").alias("offered_discount"),
                F.when(is_buy, F.col("event_id")).cast("bigint").alias("purchase_id")))


def sessions_from_lineitem(lineitem: DataFrame, orders: DataFrame,
                           inject_nulls: bool = False) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_discount",
                         "l_returnflag", "l_shipdate")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    joined = li.join(od, "l_orderkey")
    is_buy = F.col("l_returnflag") == "R"
    user = F.col("o_custkey")
    product = F.col("l_partkey")
    if inject_nulls:
        user = F.when(F.col("l_orderkey") % USER_NULL_MODULUS != 0, user)
        product = F.when(F.col("l_linenumber") != PRODUCT_NULL_LINENUMBER, product)
    return joined.select(
        F.col("l_orderkey").alias("session_id"),
        F.col("l_shipdate").alias("timestamp"),
        user.alias("user_id"),
        product.alias("product_id"),
        F.when(is_buy, F.lit(BUY)).otherwise(F.lit(VIEW)).alias("event_type"),
        F.round(F.col("l_discount") * 100).cast("int").alias("offered_discount"),
        F.when(is_buy, F.col("l_orderkey")).alias("purchase_id"))


def products_from_part(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("product_id"),
                       F.col("p_retailprice").alias("price"))


@dataclass
class Tables:
    """Lazily read driver tables of one scale factor folder."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def events_sessions(self) -> DataFrame:
        return sessions_from_events(self.table("events"))

    def line_sessions(self, inject_nulls: bool = False) -> DataFrame:
        return sessions_from_lineitem(self.table("lineitem"), self.table("orders"), inject_nulls)

    def products(self) -> DataFrame:
        return products_from_part(self.table("part"))
