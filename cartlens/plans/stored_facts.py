"""C1-C3, J3, J4 over a stored user-month fact table: kept up month by month, read without exchanges.

The table is partitioned by month and bucketed by user.  A new month of the log replaces the
partition of that month alone (dynamic overwrite), so upkeep reads one month of the log; the
training rows that change with it are those of the two months before and the month itself, and they
are computed from the stored facts.  Windows over a user need no exchange, because a bucket holds
whole users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.functions.timefeat import idx_to_date, month_range
from cartlens.operators.filters import filter_month
from cartlens.operators.monthly import user_month_facts
from cartlens.plans.features import V3_COLUMNS, rows_of_facts

FACT_COLUMNS = ("user_id", "events", "buys", "spend", "window_buys", "month_idx")


def _exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def _put(df: DataFrame, table: str, path: str, buckets: int) -> None:
    """Write the partitions (months) that ``df`` has, creating the table if there is none.

    Rows are dealt by user first, so every bucket of a month is one file.
    """
    spark = df.sparkSession
    if _exists(spark, table):
        df.repartition(buckets, "user_id").select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        return
    (df.repartition(buckets, "user_id").write.mode("errorifexists").format("parquet").option("path", path)
     .option("partitionOverwriteMode", "dynamic").partitionBy("month_idx").bucketBy(buckets, "user_id").sortBy("user_id")
     .saveAsTable(table))


def store_facts(facts: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """Store user-month facts as a bucketed table; ``path`` is a folder of a shared store."""
    _put(facts.select(*FACT_COLUMNS), table, path, buckets)


def add_month(spark: SparkSession, sessions: DataFrame, products: DataFrame, year: int, month: int,
              table: str, path: str, buckets: int = 64, net_price: bool = False) -> None:
    """Facts of one month of the log replace that month's partition; other months are not touched.

    Of a month-partitioned log only that month's folder is read.  A month without events takes
    its partition's place as an empty one only if it had none before.
    """
    facts = user_month_facts(filter_month(sessions, year, month), products, net_price=net_price)
    store_facts(facts, table, path, buckets)


def training_rows(spark: SparkSession, table: str, begin, end, threshold: float = 100.0) -> DataFrame:
    """The rows of C1 before users are dropped (``user_month_rows``) from the stored facts."""
    first, last = month_range(begin, end)
    facts = spark.table(table).where(F.col("month_idx").between(first, last + 2))
    return rows_of_facts(facts, first, last, threshold)


def training_set(spark: SparkSession, table: str, begin, end, threshold: float = 100.0) -> DataFrame:
    """C1 (``training_set_v3``) from the stored facts."""
    return training_rows(spark, table, begin, end, threshold).select(*V3_COLUMNS).dropDuplicates()


def refresh_rows(spark: SparkSession, facts_table: str, rows_table: str, path: str, year: int, month: int,
                 buckets: int = 64, threshold: float = 100.0) -> None:
    """Training rows that a changed month m can change: months m - 2 .. m, from facts m - 2 .. m + 2."""
    m = 12 * year + month - 1
    rows = training_rows(spark, facts_table, str(idx_to_date(m - 2)), str(idx_to_date(m)), threshold)
    _put(rows, rows_table, path, buckets)
