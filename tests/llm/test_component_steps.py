from __future__ import annotations

import pytest

from cartlens.llm import common as C
from cartlens.llm import ngram_join


def _counting(monkeypatch):
    written, staged = [], C.staged

    def kept(df):
        written.append(df.columns)
        return staged(df)

    monkeypatch.setattr(C, "staged", kept)
    monkeypatch.setattr(ngram_join, "staged", kept)
    return written


@pytest.mark.parametrize("edges,rounds", [
    ([], 0),
    ([(1, 5), (9, 1), (1, 5), (3, 4), (7, 7), (None, 2)], 0),       # stars, with a repeat, a loop and a null end
    ([(5, 1), (5, 3)], 1),                                          # one node with two smaller ones
    ([(1, 2), (2, 3)], 1),                                          # a node that is both
])
def test_rounds_end_when_the_edges_are_stars(spark, monkeypatch, edges, rounds):
    written = _counting(monkeypatch)
    got = {r.node: r.component for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ends = {x for a, b in edges if None not in (a, b) and a != b for x in (a, b)}
    assert got == {x: 3 if x in (3, 4) and rounds == 0 else 1 for x in ends}
    assert len(written) == 1 + rounds


def test_later_rounds_of_the_join_start_from_the_components_found(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join([*words, f"end{k}"])) for k in range(6)] + [(9, "quite another text of some words")]
    written = _counting(monkeypatch)
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict.fromkeys(range(6), 0), 9: 9}
    # Round 0 links all; each of the three later rounds writes its rows, its edges and its labels.
    assert sum(c == ["u", "v"] for c in written) <= 6 and not any(c == ["x", "y"] for c in written)
