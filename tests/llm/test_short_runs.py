from __future__ import annotations

import random

from cartlens.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def _cut(rows, min_lines, min_words):
    """Brute force: later copies of all windows that have the lines, or the words, or are the document."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = [x for x in text.split("\n") if x.strip(SPACE)]
        gone = set()
        for size in range(1, min_lines + 1):
            for k in range(len(lines) - size + 1):
                run = tuple(lines[k:k + size])
                counts = size == min_lines or len(" ".join(run).split()) >= min_words or size == len(lines)
                if counts and run in seen:
                    gone.update(range(k, k + size))
                seen.add(run)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))
    return out


def test_short_runs_equal_brute_force(spark):
    rng = random.Random(8)
    pool = [f"{w} " * n + "." for w in "abc" for n in (1, 2, 6, 7)]
    rows = [(i, "\n".join(rng.choices(pool + [f"u{i}"], k=rng.randrange(1, 9)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for min_lines, min_words in ((3, 9), (1, 9), (2, 7), (5, 20)):
        got = line_dedup.remove_repeated_runs(docs, min_lines, min_words, whole_documents=True).collect()
        assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == _cut(rows, min_lines, min_words)


def test_query_cuts_copies_of_one_and_two_lines(spark):
    long = " ".join(f"w{k}" for k in range(60))
    halves = " ".join(f"x{k}" for k in range(30)) + "\n" + " ".join(f"y{k}" for k in range(30))
    rows = [(1, "one short text"), (2, "one short text"), (3, f"a\n{long}\nb"), (4, f"c\n{long}\nd"),
            (5, f"e\n{halves}\nf"), (6, f"g\n{halves}\nh"), (7, "p\nq"), (8, "r\np\nq"), (9, "p\nq")]
    got = line_dedup.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 2, 7: 0, 8: 0, 9: 2}
