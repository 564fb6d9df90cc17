from __future__ import annotations

from cartlens.llm import line_quality

PROSE = "It was a calm day in the old town and the people went about their work."


def test_lines_over_300_characters_are_judged(spark):
    menu = " | ".join(f"topic{i}" for i in range(80))
    licence = "All rights reserved, see our privacy policy and the terms of use of this site. " * 8
    rule = "=" * 400
    long_prose = " ".join([PROSE] * 12)
    stays = [long_prose, long_prose + " One | two | three.", long_prose + " It set a cookie.", "日本語" * 150,
             " ".join(["word"] * 100)]
    for k, bad in enumerate([menu, licence.strip(), rule, " » ".join(["Home", "About us"] * 40)]):
        assert len(bad) > 300
        docs = spark.createDataFrame([(k, PROSE + "\n" + bad)], "doc_id long, text string")
        r = line_quality.clean_documents(docs).first()
        assert (r.clean_text, r.n_lines_removed, r.n_words_removed) == (PROSE, 1, len(bad.split())), bad
        assert r.kept == (len(bad.split()) <= 16)
    docs = spark.createDataFrame(list(enumerate(stays)), "doc_id long, text string")
    for r in line_quality.clean_documents(docs).collect():
        assert r.n_lines_removed == 0 and r.clean_text == stays[r.doc_id]
