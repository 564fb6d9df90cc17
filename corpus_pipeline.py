"""Corpus pipeline: documents -> toxicity -> line dedup -> near-duplicates -> mix -> tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the
next stage's documents.  Between stages the documents are written as Parquet and read again.

1. toxicity: documents that the classifier rejects go.
2. line_dedup: later copies of repeated line runs go; documents of which nothing is left go.
3. ngram_join: of each group of near-duplicates the document with the smallest id stays.
4. mixing: the documents in the order of the mix; smaller sources come again until every
   source has been read whole, so rows repeat in proportion to the target weights.  Files keep no
   order, so only the repeats reach the next stage; ``run`` writes the positions if asked to.
5. sentencepiece: sampled segmentations with their inclusion scores.

Rows that share a doc_id are one document; documents without an id pass stages 1, 2, 4 and 5 on
their own and are compared with none in stage 3.  Extra columns pass through stages 1 to 4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm import line_dedup, mixing, ngram_join, spm_sampling, toxicity
from cartlens.llm.common import held_out, read_table, staged


def _apart(docs: DataFrame, own: list[str]) -> DataFrame:
    """``docs`` with its columns other than ``own`` renamed, so that no result can clash with them."""
    return docs.toDF(*[c if c in own else f"__own{i}" for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    mine = _apart(docs, ["doc_id", "text"])
    scored = toxicity.predict(mine, model, keep=tuple(mine.columns))
    return scored.where("predicted = 0").select(*mine.columns).toDF(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mine = _apart(docs, ["doc_id", "text"])
    cut = line_dedup.remove_repeated_runs(mine, whole_documents=True).where("n_lines = 0 OR n_removed < n_lines")
    out = cut.select(*mine.columns).toDF(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = (ngram_join.jaccard_components(docs.select("doc_id", "text"))
            .where("doc_id = component_id").select("doc_id").distinct())
    alone = docs.where("doc_id IS NULL")
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(alone)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mine = _apart(docs, ["doc_id", "source"])
    return mixing.mix(mine, ordered=True).select(*mine.columns).toDF(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spm_sampling.encode(docs, keep=("lang", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", tokenise),
]

#: Stages 1, 4 and 5 are a trained model, a schedule and seeded samples: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, positions: str | None = None) -> DataFrame:
    """The result of all stages; the places of the mix (doc_id, source, epoch, block, slot,
    position: one row per row that the stage returns) go to the Parquet path ``positions``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        if positions is not None and name == "mixing":
            mixing.query(docs).write.parquet(positions)
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs)
    return docs
