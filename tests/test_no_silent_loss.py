"""Inputs and settings that must not lose rows or change results."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartlens import jobs
from cartlens.operators.ordered import positions, slope_from_sums, trend_sums
from cartlens.plans import abtest as B
from cartlens.plans.features import open_window_months
from cartlens.sources import readers as RD
from cartlens.sources import sinks as SK
from cartlens.sources.adapters import Tables

SF = "/root/testdata/sf0.01"


class _Shift:
    def __init__(self, by):
        self.by = by

    def transform(self, df):
        return df.withColumn("prediction", F.lit(float(self.by)))


def test_every_row_is_scored_whatever_model_it_names(spark):
    rows = spark.createDataFrame([(1, "BaseModel"), (2, "SecondModel"), (3, "Other"), (4, None)], "user_id long, model_type string")
    got = {r.user_id: r.prediction for r in B.score(rows, {"BaseModel": _Shift(1), "SecondModel": _Shift(2)}).collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 2.0, 4: 2.0}


def test_a_timed_end_keeps_its_month():
    jan = 2022 * 12
    assert open_window_months("2022-01-01", "2022-04-01") == (jan, jan + 2)
    assert open_window_months("2022-01-01", "2022-04-01 10:00:00") == (jan, jan + 3)
    assert open_window_months("2022.01.01", "2022.04.02") == (jan, jan + 3)


def test_float_ids_zoned_times_epochs_and_bad_lines(spark, tmp_path):
    base = {"session_id": 1, "timestamp": "2022-01-01T10:00:00", "user_id": 102.0, "product_id": "7",
            "event_type": "VIEW_PRODUCT", "offered_discount": 5.0, "purchase_id": None}
    times = {"2022-01-01T10:00:00": "2022-01-01 10:00:00", "2022-01-01T10:00:00Z": "2022-01-01 10:00:00",
             "2022-01-01T12:30:00+02:30": "2022-01-01 10:00:00", 1641031200000: "2022-01-01 10:00:00",
             "2022-01-01": "2022-01-01 00:00:00", "2022-01-01 10:00:00.250": "2022-01-01 10:00:00.250000", "soon": None}
    path = tmp_path / "sessions.jsonl"
    lines = [json.dumps({**base, "session_id": k, "timestamp": t}) for k, t in enumerate(times)]
    path.write_text("\n".join([*lines, json.dumps({**base, "user_id": 1.5, "session_id": 90}), "{broken", "17", ""]) + "\n")
    products = tmp_path / "products.jsonl"
    products.write_text('{"product_id": 7.0, "price": 10}\n')
    got = {r.session_id: r for r in RD.read_sessions(spark, str(path)).collect() if r.session_id is not None}
    for k, want in enumerate(times.values()):
        assert (None if got[k].timestamp is None else str(got[k].timestamp)) == want
        assert (got[k].user_id, got[k].product_id, got[k].offered_discount) == (102, 7, 5)
    assert got[90].user_id is None
    report = RD.parse_report(spark, str(path)).first()
    assert (report.lines, report.corrupt_lines, report.unparsed_timestamp, report.unparsed_user_id) == (10, 2, 1, 1)
    sessions, prod = jobs.load_inputs(spark, str(path), str(products), rejects_path=str(tmp_path / "bad"))
    assert sessions.count() == 8 and sessions.where("session_id IS NULL").count() == 0
    assert prod.first().product_id == 7
    assert {r.table: r.lines for r in jobs.rejected_lines(spark, str(tmp_path / "bad")).collect()} == {"sessions": 2}


def test_event_types_are_all_kept(spark):
    t = Tables(spark, SF)
    assert t.events_sessions().count() == t.table("events").count()


@pytest.mark.parametrize("parts,conf", [(4, {}), (8, {"spark.sql.exchange.reuse": "false"}), (37, {"spark.sql.adaptive.enabled": "false"})])
def test_positions_equal_row_number_with_extra_columns(spark, parts, conf):
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = Tables(spark, SF).line_sessions().withColumn("extra", F.rand(3)).where("user_id IS NOT NULL")
        rows = rows.withColumn("user_id", F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
        order = ["timestamp", "session_id", "product_id", "offered_discount"]
        got = positions(rows, "user_id", order, partitions=parts)
        assert got.select("user_id", "position").distinct().count() == rows.count()
        w = Window.partitionBy("user_id").orderBy(*order)
        want = rows.withColumn("position", F.row_number().over(w) - 1)
        keys = ["user_id", *order, "position"]
        assert got.select(*keys).exceptAll(want.select(*keys)).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_trend_of_users_behind_many_rows_is_exact(spark):
    rows = spark.range(600_000).select(F.lit(0).alias("u"), F.col("id").alias("t"), (F.col("id") % 1000).cast("double").alias("y"))
    few = spark.range(500).select((F.col("id") / 10).cast("int").alias("u") + 1, (F.col("id") % 10).alias("t"),
                                  (F.lit(1000.0) + (F.col("id") % 10) * 0.2).alias("y"))
    got = trend_sums(rows.union(few), "u", ["t"], "y", partitions=2).select("u", slope_from_sums().alias("s"))
    assert all(abs(r.s - 0.2) < 1e-9 for r in got.where("u > 0").collect())


def test_a_damaged_model_folder_is_an_error(spark, tmp_path):
    folder = tmp_path / "model"
    (folder / "stages").mkdir(parents=True)
    (folder / "note").write_text("mine")
    with pytest.raises(Exception):
        SK.load_or_train(spark, str(folder), None, lambda: pytest.fail("trained"))
    assert (folder / "note").read_text() == "mine"


def test_null_products_do_not_meet_in_one_partition(spark):
    from cartlens.operators.joins import with_price
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = Tables(spark, SF)
        rows = t.line_sessions().withColumn("product_id", F.when(F.col("session_id") % 2 == 0, F.col("product_id")))
        priced = with_price(rows, t.products(), "left")
        assert priced.count() == rows.count()
        assert priced.where("product_id IS NULL AND price IS NOT NULL").count() == 0
        plan = priced._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(product_id" in plan and "_spread" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
