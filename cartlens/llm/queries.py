"""Registered queries of the training-data operators: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartlens.llm import (chat_trees, collocations, fm_dedup, hnsw_dedup, langid, line_dedup, line_quality, mixing,
                          ngram_join, periodic_runs, spm_sampling, toxicity, warc_zip)
from cartlens.llm.common import read_table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.query(read_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(read_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm_sampling.query(read_table(spark, sf_dir, "documents"))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.query(read_table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.query(read_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.query(read_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.query(read_table(spark, sf_dir, "documents"))


def op9_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_trees.query(spark, read_table(spark, sf_dir, "conversations"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.query(read_table(spark, sf_dir, "embeddings"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.query(read_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.query(read_table(spark, sf_dir, "documents"))


def op13_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.query(read_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_mixing, op3_sentencepiece, op4_line_quality, op5_ngram_join,
                            op6_toxicity, op7_substring_dedup, op8_line_dedup, op9_chat_trees, op10_embedding_dedup,
                            op11_collocations, op12_periodic_runs, op13_warc_zip)}

#: DuckDB SQL where SQL can express the operator; the others are tested by brute force.
ORACLE: dict[str, str] = {
    "op4_line_quality": line_quality.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op9_chat_trees": chat_trees.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_warc_zip": warc_zip.ORACLE,
}
