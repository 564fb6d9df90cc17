from __future__ import annotations

from collections import Counter

import corpus_pipeline
from cartlens.llm import mixing


def test_positions_stand_beside_the_result(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i}", "en", "big" if i % 10 else "small") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages = [("mixing", corpus_pipeline.mix_sources), ("sentencepiece", lambda spark, docs, sf_dir: docs)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    out = corpus_pipeline.run(spark, str(tmp_path), positions=f"{tmp_path}/positions")
    places = spark.read.parquet(f"{tmp_path}/positions").orderBy("position").collect()
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in places)
    assert len({r.position for r in places}) == len(places) > 2000
    want = {r.position: r.doc_id for r in mixing.mix(docs).collect()}
    assert {r.position: r.doc_id for r in places} == want
