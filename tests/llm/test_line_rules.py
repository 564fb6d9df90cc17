from __future__ import annotations

import hashlib
import random
import re

from cartlens.llm import line_dedup, line_quality

SPACE = " \t\n\x0b\x0c\r"


def _base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else set()
    hit = {p for i, w in enumerate(windows) if w in seen for p in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit),
            len(words) < 10 or 100 * len(hit) > 20 * len(words))


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "#*$%&|<>", "x\x0by\x0cz w", "one two three four five " * 12, "é日本 " * 30 + "\U00010348"]
    for _ in range(60):
        words = rng.choices(["the", "of", "a", "b|c", "née", "end."], k=rng.randrange(1, 90))
        texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t", "\r\n"]) for w in words))
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(3, "a", 8), (None, "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = line_quality.clean_documents(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        want = _base(texts[r.doc_id] if r.doc_id is not None else "a")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r
        assert not (r.kept and r.base_failed)
    assert line_quality.clean_documents(docs.limit(0)).count() == 0


def test_line_rules_and_document_loss(spark):
    prose = "It was a calm day in the old town and the people went about their work."
    rows = [(1, "\n".join([prose, "Home | About | Contact", "We use cookies to serve you.", "", "Read more", prose + " Then"])),
            (2, "\n".join([prose, "x%%% y*** z$$$ &&& ###" * 30])), (3, "\n".join([prose] + ["click here now to win a prize today."] * 9)),
            (4, prose + " " + prose[::-1].replace(".", "") + " without an end but long enough to stay"), (5, prose + "\n" + prose + " Again it was.")]
    got = {r.doc_id: r for r in line_quality.clean_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].clean_text == "\n".join([prose, "", prose + " Then"]) and got[1].n_lines_removed == 3
    assert got[2].n_lines_removed == 1 and not got[3].kept and got[3].n_lines_removed == 9
    assert got[4].kept and got[4].clean_text == rows[3][1]


def _cut(rows, r):
    """Brute force: later copies of r-line windows, in the order of (id, line)."""
    docs = {}
    for i, t in rows:
        docs.setdefault((i is not None, i), (t, [k for k, x in enumerate((t or "").split("\n")) if x.strip(SPACE)]))
    seen, gone = set(), {}
    for key in sorted(docs):
        t, at = docs[key]
        lines = (t or "").split("\n")
        for k in range(len(at) - r + 1):
            w = tuple(lines[at[k + j]] for j in range(r))
            if w in seen:
                gone.setdefault(key, set()).update(range(k, k + r))
            seen.add(w)
    out = {}
    for key, (t, at) in docs.items():
        drop = gone.get(key, set())
        if not drop:
            out[key[1]] = (t, len(at), 0)
        elif len(drop) == len(at):
            out[key[1]] = ("", len(at), len(at))
        else:
            dead = {at[k] for k in drop}
            out[key[1]] = ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in dead), len(at), len(drop))
    return out


def test_later_runs_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(None, "a\nb\nc\nd"), (900, None), (901, ""), (902, "\n \n"), (903, "z\n" * 40), (904, "a\n\nb\nc\n\nd\nq")]
    rows += [(i, "\n".join(rng.choices(["a", "b", "c", "d", " ", "", f"u{i}"], k=rng.randrange(1, 25)))) for i in range(60)]
    rows += [(i + 100, rows[10 + i][1] + "\nlast") for i in range(20)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, n_runs string")
    for r in (1, 2, 3, 5):
        want = _cut(rows, r)
        got = line_dedup.remove_repeated_runs(docs, min_lines=r).collect()
        assert {x.doc_id: (x.text, x.n_lines, x.n_removed) for x in got} == want, r
        assert all((x.n_runs > 0) == (x.n_removed > 0) and x.longest_run >= (r if x.n_runs else 0) for x in got)
    assert line_dedup.remove_repeated_runs(docs.limit(0)).count() == 0


def test_repeated_rows_are_one_document(spark):
    text = "p\nq\nr\ns"
    docs = spark.createDataFrame([(1, text), (1, text), (2, text + "\nt")], "doc_id long, text string")
    got = sorted((x.doc_id, x.text) for x in line_dedup.remove_repeated_runs(docs, 3).collect())
    assert got == [(1, text), (1, text), (2, "t")]
    digest = [x.kept_sha256 for x in line_dedup.query(docs.where("doc_id = 2")).collect()]
    assert digest == [hashlib.sha256((text + "\nt").encode()).hexdigest()]
