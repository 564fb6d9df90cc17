from __future__ import annotations

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cartlens.llm import ngram_join, spm_sampling
from cartlens.llm.common import staged
from cartlens.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(900)}"     # noqa: E731
    docs, labels = [], []
    for i in range(400):
        lines = [" ".join(word() for _ in range(12)) + "." for _ in range(rng.randrange(3, 7))]
        bad = i % 8 == 0
        if bad:
            lines[1] += " nasty vile"
        docs.append((i, "\n".join(lines), "en", "big" if i % 3 else f"s{i % 2}"))
        labels.append((i, 1, int(bad)))
    docs += [(1000 + i, docs[i][1], "en", "big") for i in (1, 2, 3)]                             # copies
    docs += [(1100, docs[5][1].replace("\n", " "), "en", None), (1101, docs[5][1].replace("\n", " ") + " more", "en", "s0")]
    docs += [(1200, None, None, "s1"), (1201, "", "en", "s1"), (None, "no id at all here", "en", "s1")]
    rows = [(*d, len(d[1]) if d[1] is not None else None, "extra") for d in docs]
    where = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where


def test_each_stage_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(staged(stage(spark, kept[-1], sf_dir)))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "sentencepiece"]
    assert all(d.columns == columns for d in kept[:-1])
    raw, clean, lines, near, mixed = ([tuple(r) for r in d.collect()] for d in kept[:5])
    assert sorted(map(str, clean)) == sorted(str(r) for r in raw if "vile" not in (r[1] or ""))
    # Copies lose every line; near copies that share no line run stay for the next stage.
    assert {r[0] for r in clean} - {r[0] for r in lines} == {1001, 1002, 1003}
    assert all(r[4] == (None if r[1] is None else len(r[1])) for r in lines)
    sets = {r[0]: set(ngram_join.ngram_set(r[1]).tolist()) for r in lines if r[0] is not None}
    gone = {y for x in sets for y in sets if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])}
    assert gone == {1100, 1101} and sorted(map(str, near)) == sorted(str(r) for r in lines if r[0] not in gone)
    assert {str(r) for r in mixed} == {str(r) for r in near} and len(mixed) > len(near)
    pieces = spm_sampling.piece_bytes()
    texts: dict = {}
    for r in mixed:
        texts.setdefault(r[0], []).append(r[1] or "")
    tokens: dict = {}
    for r in kept[5].collect():
        assert spm_sampling.decode_ids(r.tokens, pieces) == texts[r.doc_id][0]
        tokens.setdefault((r.doc_id, r.sample), []).append(bytes(r.tokens))
    assert all(len(tokens[i, 0]) == len(t) for i, t in texts.items())
    assert corpus_pipeline.run(spark, sf_dir).count() == kept[5].count()


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir))
        assert docs.count() == 0


def test_registry():
    names = entry.queries()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) <= set(names) and "pipeline" in names and set(ORACLE) <= set(entry.oracle_sql())
