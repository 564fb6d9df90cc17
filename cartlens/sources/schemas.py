"""Declared schemas of the inputs and outputs (never inferred in production)."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

# Event names as they appear in the session log.
VIEW = "VIEW_PRODUCT"
BUY = "BUY_PRODUCT"

# The source gives no time zone, so timestamps are wall-clock (NTZ) values.
SESSIONS = StructType([
    StructField("session_id", LongType(), False),
    StructField("timestamp", TimestampNTZType(), False),
    StructField("user_id", LongType(), True),
    StructField("product_id", LongType(), True),
    StructField("event_type", StringType(), False),
    StructField("offered_discount", IntegerType(), False),
    StructField("purchase_id", LongType(), True),
])

PRODUCTS = StructType([
    StructField("product_id", LongType(), False),
    StructField("price", DoubleType(), True),
])

PREDICTION_LOG = StructType([
    StructField("prediction_time", StringType(), False),
    StructField("model_type", StringType(), False),
    StructField("prediction", DoubleType(), True),
    StructField("user_id", LongType(), True),
])

CORRUPT = "_corrupt_record"


def with_corrupt_column(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])


def nullable(schema: StructType) -> StructType:
    """The JSON reader cannot enforce NOT NULL; declare every field nullable."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
