"""The stored fact table: one month at a time, and windows without exchanges."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from cartlens.operators import joins as J
from cartlens.operators import monthly as M
from cartlens.plans import features as C
from cartlens.plans import stored_facts as ST
from cartlens.sources import sinks as SK
from cartlens.sources.adapters import Tables
from conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    t = Tables(spark, SF)
    path = str(tmp_path_factory.mktemp("log") / "sessions")
    SK.write_sessions_by_month(t.line_sessions().where("timestamp >= '1997-01-01' AND timestamp < '1997-09-01'"), path)
    return SK.read_sessions_by_month(spark, path), t.products()


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_a_new_month_changes_only_what_depends_on_it(spark, log, tmp_path, monkeypatch):
    sessions, products = log
    before = sessions.where("timestamp < '1997-07-01'")
    ST.store_facts(M.user_month_facts(before, products), "facts_inc", str(tmp_path / "f"), 4)
    first, last = "1997-01-01", "1997-06-01"
    ST._put(ST.training_rows(spark, "facts_inc", first, last), "rows_inc", str(tmp_path / "r"), 4)
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "f").rglob("*.parquet")}
    plans = []
    put = ST._put
    monkeypatch.setattr(ST, "_put", lambda df, *a: (plans.append(_plan(df)), put(df, *a))[1])
    for month in (7, 8):
        ST.add_month(spark, sessions, products, 1997, month, "facts_inc", str(tmp_path / "f"), 4)
        ST.refresh_rows(spark, "facts_inc", "rows_inc", str(tmp_path / "r"), 1997, month, 4)
    assert f"month_start#" in plans[0] and "month_start" in plans[0].split("PartitionFilters")[1].split("\n")[0]
    assert all(p.exists() and p.stat().st_mtime_ns == s for p, s in stamps.items())        # other months were not written
    spark.catalog.refreshTable("facts_inc"), spark.catalog.refreshTable("rows_inc")
    whole = M.user_month_facts(sessions, products)
    assert rows(spark.table("facts_inc"), *ST.FACT_COLUMNS) == rows(whole, *ST.FACT_COLUMNS)
    want = C.user_month_rows(sessions, products, "1997-01-01", "1997-08-01")
    assert rows(spark.table("rows_inc"), *want.columns) == rows(want)
    assert rows(ST.training_set(spark, "facts_inc", "1997-02-01", "1997-05-01")) == rows(
        C.training_set_v3(sessions, products, "1997-02-01", "1997-05-01"))
    # the same month again replaces itself
    ST.add_month(spark, sessions, products, 1997, 8, "facts_inc", str(tmp_path / "f"), 4)
    spark.catalog.refreshTable("facts_inc")
    assert spark.table("facts_inc").count() == whole.count()


def test_windows_over_the_stored_table_need_no_exchange(spark, log, tmp_path):
    sessions, products = log
    facts = M.user_month_facts(sessions, products)
    ST.store_facts(facts, "facts_buckets", str(tmp_path / "b"), 8)
    stored = spark.table("facts_buckets")
    for fn in (lambda f: J.with_user_totals(M.with_calendar(f)), M.user_month_next, lambda f: C.rows_of_facts(f, 12 * 1997, 12 * 1997 + 5)):
        tree = _plan(fn(stored)).split("\n\n(1)")[0]
        assert "Exchange" not in tree and "Window" in tree
        got, want = fn(stored), fn(facts)
        assert rows(got, *want.columns) == rows(want)
    months = _plan(ST.training_rows(spark, "facts_buckets", "1997-02-01", "1997-03-01"))
    assert "PartitionFilters: [isnotnull(month_idx" in months
