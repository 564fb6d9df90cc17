from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.llm import line_dedup as L


def test_a_step_of_the_search_writes_only_places_that_are_open(spark, monkeypatch):
    lines = [f"line {i} of the run" for i in range(9)]
    texts = ["\n".join(lines), "\n".join([*lines[:7], "own"]), "\n".join(["other", *lines[2:6], "end"]), "\n".join([lines[8], "x", "y"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    places = L.staged(L.line_places(docs, 3, 50, True))
    levels = L.doubled(places)
    assert len(levels) == 3                                       # runs of 4 to 7 lines
    steps, staged = [], L.staged

    def kept(df):
        out = staged(df)
        if {"k", "lo", "hi"} <= set(out.columns):
            steps.append(out.agg(F.min("k")).first()[0])
        return out

    monkeypatch.setattr(L, "staged", kept)
    got = sorted((r.id, r.line, r.lines) for r in L.longest_copies(levels).collect())
    assert steps == [0, 1, 2]
    assert got == [(1, i, 7 - i) for i in range(7)] + [(2, i, 5 - i) for i in range(1, 5)] + [(3, 0, 1)]
