"""M2, M6-M8: classifier metrics as DataFrame aggregates.

The ROC AUC is exact (Mann-Whitney with tie averaging) and distributed: scores
are first reduced to one row per distinct score, range-partitioned on the
score, and the running count of negatives is built from per-partition sums.
No global single-partition window and no ``collect`` of scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.session import target_partitions


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction",
             by: list[str] | None = None) -> DataFrame:
    """M6: share of rows with prediction == label (optionally per group)."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("int")
    aggs = [F.count(F.lit(1)).alias("rows"), F.avg(hit).alias("accuracy")]
    return df.groupBy(*(by or [])).agg(*aggs)


def baseline_accuracy(df: DataFrame, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """Positive share and the accuracy of always predicting one class.

    With a ``split`` column the class is the majority of the train split, so no other split
    is looked at to choose it; without one it is the majority of the rows (ties: class 0).
    """
    by = list(by or [])
    per = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col(label).cast("double")).alias("positive_share"))
    # ``per`` has one row per group, so a window over all of it is bounded.
    one = F.col("positive_share") > 0.5
    seen = F.when(F.col("split") == "train", one) if "split" in by else one
    per = per.withColumn("_one", F.coalesce(F.max(seen).over(Window.partitionBy(F.lit(0))), F.lit(False)))
    hit = F.when(F.col("_one"), F.col("positive_share")).otherwise(1 - F.col("positive_share"))
    return per.select(
        *by, "rows", "positive_share", hit.alias("baseline_accuracy"),
        F.when(F.col("_one"), F.col("rows")).otherwise(F.lit(0)).cast("bigint").alias("predicted_positive"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              classes=(0, 1)) -> DataFrame:
    """M8: counts per (label, prediction) over the full class grid (missing cells = 0).

    Labels or predictions outside ``classes``, NULL among them, get cells of their own.
    """
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes], "label int, prediction int")
    counts = df.groupBy(F.col(label).cast("int").alias("label"),
                        F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("rows"))
    return grid.join(counts, ["label", "prediction"], "full").select(
        "label", "prediction", F.coalesce("rows", F.lit(0)).alias("rows"))


def auc(df: DataFrame, score: str = "score", label: str = "label",
        partitions: int | None = None, by: list[str] | None = None,
        weight: str | None = None) -> DataFrame:
    """M7: exact ROC AUC = P(score_pos > score_neg) + 0.5 * P(tie), per ``by`` group.

    Returns one row per group (``by`` columns, positives, negatives, auc); auc
    is NULL if a class is absent.  Rows are reduced to one per (group,
    distinct score), range-partitioned on (group, score) -- a large group is
    split across partitions like any other key range -- and the running count
    of lower negatives is rebuilt from per-partition sums.  ``weight`` names a column with
    the number of rows that each row stands for.
    """
    by = list(by or [])
    spark = df.sparkSession
    n = partitions or target_partitions(spark)
    one = F.col(weight) if weight else F.lit(1).cast("bigint")
    per = df.groupBy(*by, F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, one).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 0, one).otherwise(0)).alias("neg"))
    ranged = per.repartitionByRange(n, *by, "s").withColumn("_p", F.spark_partition_id())
    below = Window.partitionBy("_p", *by).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    parts = local.groupBy("_p", *by).agg(
        F.sum(F.col("pos") * (F.col("_below") + 0.5 * F.col("neg"))).alias("_u"),
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    # At most (#partitions + #groups) rows: the negatives of a group's lower
    # partitions shift every positive of that group in a later partition.
    earlier = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_off", F.coalesce(F.sum("_neg").over(earlier), F.lit(0)))
    return parts.groupBy(*by).agg(
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"),
        F.try_divide(F.sum(F.col("_u") + F.col("_pos") * F.col("_off")),
                     F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"))
