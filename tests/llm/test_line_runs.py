"""Maximal repeated line runs: number and longest, against brute force."""

from __future__ import annotations

import random

from cartlens.llm import line_dedup


def _runs(rows, min_lines):
    """(n_removed, n_runs, longest_run) by id: for every place the longest run that stands earlier too."""
    docs = {i: t.split("\n") for i, t in rows}
    seen: dict[tuple, tuple] = {}
    for i in sorted(docs):
        lines = docs[i]
        for p in range(len(lines)):
            for e in range(p + 1, len(lines) + 1):
                seen.setdefault(tuple(lines[p:e]), (i, p))
    out = {}
    for i, lines in docs.items():
        spans = []
        for p in range(len(lines)):
            most = max((e for e in range(p + 1, len(lines) + 1) if seen[tuple(lines[p:e])] < (i, p)), default=p)
            if most - p >= min_lines and not any(a <= p and most <= b for a, b in spans):
                spans.append((p, most))
        gone = {k for a, b in spans for k in range(a, b)}
        out[i] = (len(gone), len(spans), max((b - a for a, b in spans), default=0))
    return out


def test_runs_equal_brute_force(spark):
    rng = random.Random(3)
    base = [f"line {k}" for k in range(45)]
    rows = [(1, "\n".join(base[10:20])), (2, "\n".join(["a", *base[:30], "b"])), (3, "\n".join(["c", *base, "d"])),
            (4, "\n".join(base[5:33])), (5, "\n".join(["same"] * 13)), (6, "\n".join(["same"] * 5 + ["x"] + ["same"] * 21))]
    rows += [(k, "\n".join(rng.choices("pqr", k=rng.randrange(1, 20)))) for k in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for min_lines in (1, 3):
        got = {r.doc_id: (r.n_removed, r.n_runs, r.longest_run) for r in line_dedup.remove_repeated_runs(docs, min_lines, 10**6).collect()}
        assert got == _runs(rows, min_lines)
    # The middle of document 2's lines stands in document 1, and all of them in no earlier one.
    assert got[2] == (10, 1, 10) and got[3] == (30, 1, 30)


def test_tables_without_lines_or_repeats(spark):
    for rows in ([(1, None), (2, " \n")], [(1, "a\nb"), (2, "c")]):
        got = line_dedup.remove_repeated_runs(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
        assert all((r.n_removed, r.n_runs, r.longest_run) == (0, 0, 0) for r in got) and len(got) == 2
