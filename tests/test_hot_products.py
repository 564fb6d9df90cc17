"""User-month facts and salted joins where one product holds a third of the buys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartlens.operators import joins as J
from cartlens.operators import monthly as M
from cartlens.sources.schemas import BUY, VIEW
from conftest import rows


@pytest.fixture(scope="module")
def hot_log(spark):
    k = F.col("id")
    return spark.range(6000).select(
        k.alias("session_id"), (F.lit("2021-01-01").cast("timestamp_ntz") + F.make_dt_interval((k % 80).cast("int"))).alias("timestamp"),
        F.when(k % 11 != 0, k % 37).alias("user_id"), F.when(k % 13 != 0, F.when(k % 3 == 0, 0).otherwise(k % 50)).alias("product_id"),
        F.when(k % 2 == 0, F.lit(BUY)).otherwise(F.lit(VIEW)).alias("event_type"), (k % 4 * 5).cast("int").alias("offered_discount"),
        F.lit(None).cast("long").alias("purchase_id"))


@pytest.fixture(scope="module")
def prices(spark, tmp_path_factory):
    # product 5 stands twice (money doubles, counts do not), 49 is unknown, one price and one id are missing
    path = str(tmp_path_factory.mktemp("prices") / "p")
    spark.createDataFrame([(p, 10.0 + p) for p in range(49)] + [(5, 1.5), (6, None), (None, 9.0)],
                          "product_id long, price double").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _facts(log, prices, net):
    """The same by one plain join and two aggregates."""
    users = log.where("user_id IS NOT NULL").withColumn("m", F.expr("12 * year(timestamp) + month(timestamp) - 1"))
    buy = F.col("event_type") == BUY
    counts = users.groupBy("user_id", "m").agg(F.count("*").alias("events"), F.count_if(buy).alias("buys"))
    price = F.col("price").cast("decimal(28,6)") * ((100 - F.col("offered_discount")) / 100 if net else F.lit(1))
    money = users.where(buy).join(prices, "product_id").groupBy("user_id", "m").agg(F.sum(price).alias("spend"))
    return {(r.user_id, r.m): (r.events, r.buys, round(float(r.spend or 0), 4)) for r in counts.join(money, ["user_id", "m"], "left").collect()}


@pytest.mark.parametrize("net", [False, True])
def test_facts_with_and_without_broadcast(spark, hot_log, prices, net, request):
    want = _facts(hot_log, prices, net)

    def got():
        df = M.user_month_facts(hot_log, prices, net_price=net)
        return {(r.user_id, r.month_idx): (r.events, r.buys, round(float(r.spend), 4)) for r in df.collect()}

    assert J.fits_broadcast(prices) and got() == want
    request.getfixturevalue("no_broadcast")
    assert not J.fits_broadcast(prices) and got() == want


def test_counts_never_meet_the_product_exchange(spark, hot_log, prices, no_broadcast):
    plan = M.user_month_facts(hot_log, prices)._jdf.queryExecution().executedPlan().toString()
    by_product = [x for x in plan.splitlines() if "Exchange hashpartitioning(product_id" in x]
    assert len(by_product) == 2                                   # the priced buys and the products
    assert plan.count("Exchange hashpartitioning(user_id") == 1   # one user-month aggregate


def test_year_spend_keeps_users_without_a_product(spark, hot_log, prices):
    got = M.user_year_spend(hot_log, prices, "2021-01-10", "2021-03-01")
    buys = hot_log.where(f"user_id IS NOT NULL AND event_type = '{BUY}' AND timestamp > '2021-01-10' AND timestamp < '2021-03-01'")
    want = {r.user_id: round(float(r.s or 0), 2) for r in buys.join(prices, "product_id", "left").groupBy("user_id").agg(
        F.sum(F.col("price").cast("decimal(28,6)")).alias("s")).collect()}
    assert {r.user_id: round(float(r.spent_money), 2) for r in got.collect()} == want


def test_hot_keys_are_found(spark, hot_log):
    assert J.hot_keys(hot_log, "product_id", share=0.2) == [0]
    assert J.hot_keys(hot_log.limit(0), "product_id") == []
    assert set(J.hot_keys(hot_log, "user_id", share=0.02)) == set(range(37))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_a_plain_one_and_spreads_the_hot_product(spark, hot_log, prices, how, no_broadcast):
    hot = J.hot_keys(hot_log, "product_id", share=0.2)
    plain = J.with_price(hot_log, prices, how)
    salted = J.with_price(hot_log, prices, how, hot=hot)
    assert rows(salted, *plain.columns) == rows(plain)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        def tasks(df):
            per = df.where("product_id = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
            return sorted(r["count"] for r in per)

        alone, spread = tasks(J.with_price(hot_log, prices, "inner")), tasks(J.with_price(hot_log, prices, "inner", hot=hot))
        assert len(alone) == 1 and len(spread) > 20 and max(spread) < alone[0] / 6 and sum(spread) == alone[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_user_totals_equal_the_three_joins(spark, hot_log, prices):
    facts = M.with_calendar(M.user_month_facts(hot_log, prices))
    buys = facts.where("buys > 0").select("user_id", "month_idx", F.col("buys").alias("buying_events_month"))
    year = facts.groupBy("user_id", "year").agg(F.sum("spend").alias("spent_money_year"))
    total = facts.groupBy("user_id").agg(F.sum("spend").alias("total_spend"))
    events = facts.select("user_id", "month_idx", "year", "month", F.col("events").alias("all_events_month"))
    want = J.left_join_keys(events, (buys, ["user_id", "month_idx"]), (year, ["user_id", "year"]), (total, ["user_id"]))
    got = J.with_user_totals(facts)
    assert rows(got, *sorted(got.columns)) == rows(want, *sorted(got.columns))
