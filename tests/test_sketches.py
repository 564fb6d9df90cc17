from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.functions.timefeat import idx_to_date, month_idx
from cartlens.operators import sketches as K
from cartlens.sources.adapters import Tables

SF = "/root/testdata/sf0.01"


def test_every_window_is_within_the_stated_error(spark, tmp_path):
    log = Tables(spark, SF).line_sessions(inject_nulls=True)
    path = str(tmp_path / "sketches")
    K.month_sketches(log).write.parquet(path)
    stored = spark.read.parquet(path)
    seen = log.select(month_idx().alias("m"), *K.COLUMNS).cache()
    bound = 4 * K.standard_error()
    for first, last in ((12 * 1995, 12 * 1995), (12 * 1996 + 2, 12 * 1996 + 7), (12 * 1995, 12 * 2001 + 11), (12 * 1998 + 11, 12 * 1999)):
        exact = seen.where(F.col("m").between(first, last)).agg(F.count("*").alias("rows"), *[F.count_distinct(c).alias(c) for c in K.COLUMNS]).first()
        got = K.distinct_between(stored, str(idx_to_date(first)), str(idx_to_date(last)))
        assert "lineitem" not in got._jdf.queryExecution().executedPlan().toString()
        got = got.first()
        assert got["rows"] == exact["rows"]
        assert all(abs(got[c] - exact[c]) <= bound * exact[c] + 1 for c in K.COLUMNS), (first, last)
    running = {r.to_month: r for r in K.distinct_running(stored, 3).collect()}
    for to in (12 * 1997, 12 * 2000 + 5):
        exact = seen.where(F.col("m").between(to - 2, to)).agg(F.count_distinct("user_id")).first()[0]
        assert abs(running[to].user_id - exact) <= bound * exact + 1
    assert max(running) == max(r.month_idx for r in stored.collect())


def test_spans_without_rows(spark):
    log = Tables(spark, SF).line_sessions()
    got = K.distinct_between(K.month_sketches(log), "2010-01-01", "2010-12-31").first()
    assert tuple(got) == (0, 0, 0, 0)
