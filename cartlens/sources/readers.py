"""JSON-lines readers, column profile and preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens.sources import schemas as S

# Zoned ISO times end in Z or an offset after the time of day.
_ZONED = r"[0-9]:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})$"
_NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def _lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with every field as text, plus the raw line where it is no JSON object."""
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = (spark.read.text(path).where(F.trim("value") != "")
            .select("value", F.from_json("value", S.with_corrupt_column(raw), {
                "mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT}).alias("r")))
    bad = F.coalesce(F.col(f"r.{S.CORRUPT}"), F.when(~F.col("value").rlike(r"^\s*\{"), F.col("value")))
    return rows.select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields], bad.alias(S.CORRUPT))


def parse_long(text) -> Column:
    """A whole number written as an integer or a float ("102.0"); anything else is NULL."""
    value = F.expr(f"try_cast(`{text}` AS DECIMAL(38, 6))")
    return F.when(value == F.floor(value), F.expr(f"try_cast(try_cast(`{text}` AS DECIMAL(38, 6)) AS BIGINT)"))


def parse_time(text: str) -> Column:
    """Wall-clock time of ISO text, a bare date, a zoned time (as UTC) or an epoch.

    Numbers from 1e11 up are epoch milliseconds, smaller ones seconds.
    """
    c = F.col(text)
    number = F.expr(f"try_cast(`{text}` AS DECIMAL(30, 6))")
    seconds = F.when(F.abs(number) >= 100_000_000_000, number / 1000).otherwise(number)
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    zoned = F.convert_timezone(None, F.lit("UTC"), F.expr(f"try_cast(`{text}` AS TIMESTAMP)").cast("timestamp_ntz"))
    return (F.when(c.rlike(_NUMBER) & (F.length(c) > 8), epoch)
            .when(c.rlike(_ZONED), zoned).otherwise(F.expr(f"try_cast(`{text}` AS TIMESTAMP_NTZ)")))


def _typed(rows: DataFrame, schema: T.StructType) -> list[Column]:
    out = []
    for f in schema.fields:
        if isinstance(f.dataType, T.LongType):
            c = parse_long(f.name)
        elif isinstance(f.dataType, T.IntegerType):
            c = F.when(parse_long(f.name).between(-2**31, 2**31 - 1), parse_long(f.name)).cast("int")
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = parse_time(f.name)
        else:
            c = F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})")
        out.append(c.alias(f.name))
    return out


def _json(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool) -> DataFrame:
    rows = _lines(spark, path, schema)
    return rows.select(*_typed(rows, schema), *([S.CORRUPT] if keep_corrupt else []))


def read_sessions(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Session log (JSON lines) with the declared schema.

    Ids may be written as floats (as pandas writes integer columns with gaps), times as ISO
    text with or without a zone or as an epoch.  Malformed lines give NULL fields; with
    ``keep_corrupt`` the raw line is in ``_corrupt_record``.
    """
    return _json(spark, path, S.SESSIONS, keep_corrupt)


def read_products(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Product table (JSON lines)."""
    return _json(spark, path, S.PRODUCTS, keep_corrupt)


def parse_report(spark: SparkSession, path: str, schema: T.StructType = S.SESSIONS) -> DataFrame:
    """One row: lines, corrupt lines and, per column, the values that did not parse."""
    rows = _lines(spark, path, schema)
    lost = [F.count_if(F.col(f.name).isNotNull() & c.isNull()).alias(f"unparsed_{f.name}")
            for f, c in zip(schema.fields, _typed(rows, schema))]
    return rows.agg(F.count("*").alias("lines"), F.count(S.CORRUPT).alias("corrupt_lines"), *lost)


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    """S3: generic JSON-lines reader (users, deliveries) with a declared schema.

    Inferring one would read the whole input first, so a schema is required.
    """
    return spark.read.option("mode", "PERMISSIVE").schema(schema).json(path)


def profile(df: DataFrame) -> DataFrame:
    """One row per column with its type, non-null count and row count.

    A single aggregate pass computes every count; ``stack`` turns the one wide
    row into (column, data_type, non_null, rows).
    """
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count(F.col(f"`{c}`")).alias(f"__nn{i}") for i, c in enumerate(cols)])
    types = dict(df.dtypes)
    pairs = ", ".join(
        f"'{c}', '{types[c]}', __nn{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {pairs}) AS (`column`, data_type, non_null)", "__rows AS rows")


def preview(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """First ``n`` rows under an explicit total order (TakeOrderedAndProject)."""
    order = order_by or df.columns
    return df.orderBy(*order).limit(n)
