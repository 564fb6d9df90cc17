"""S3: JSON lines without a declared schema (users, deliveries), as variants.

No pass infers a schema before reading: each line becomes one variant, the fields and their types
are an aggregate over the rows, and typed columns are taken from the variant with what does not fit
kept and reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REST, DRIFTED = "_rest", "_drifted"


def parse_variants(lines: DataFrame, text: str = "value") -> DataFrame:
    """``line`` and ``v``; ``v`` is NULL where the line is no JSON object (see ``rejected``)."""
    v = F.try_parse_json(F.col(text))
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    return (lines.where(F.trim(F.col(text)) != "")
            .select(F.col(text).alias("line"), F.when(is_object, v).alias("v")))


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """One variant per JSON line of ``path``; blank lines are skipped."""
    return parse_variants(spark.read.text(path))


def rejected(variants: DataFrame) -> DataFrame:
    """Lines that are no JSON objects."""
    return variants.where("v IS NULL").select("line")


def variant_schema(variants: DataFrame) -> str:
    """One schema that holds all rows; fields of several types are VARIANT (one aggregate)."""
    return variants.agg(F.schema_of_variant_agg("v")).first()[0]


def field_report(variants: DataFrame) -> DataFrame:
    """Rows per (field, data_type) of the objects: drifted fields have several types."""
    exploded = variants.where("v IS NOT NULL").select("v").lateralJoin(
        variants.sparkSession.tvf.variant_explode(F.col("v").outer()))
    return exploded.groupBy(F.col("key").alias("field"), F.schema_of_variant("value").alias("data_type")).agg(
        F.count("*").alias("rows"))


def with_fields(variants: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Typed columns ``fields`` (name -> SQL type), the whole object as ``_rest`` and, in
    ``_drifted``, the names of fields whose value is there but does not fit its type."""
    typed, lost = [], []
    for name, kind in fields.items():
        path = "$[" + repr(name) + "]"
        value = F.try_variant_get("v", path, kind)
        there = F.variant_get("v", path, "variant")
        typed.append(value.alias(name))
        lost.append(F.when(value.isNull() & there.isNotNull() & ~F.is_variant_null(there), F.lit(name)))
    return variants.where("v IS NOT NULL").select(
        *typed, F.col("v").alias(REST), F.filter(F.array(*lost), lambda x: x.isNotNull()).alias(DRIFTED))
