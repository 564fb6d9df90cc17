"""CSV output, the JSON-lines prediction log and model persistence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from cartlens.sources.schemas import PREDICTION_LOG


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line (no index column: Spark rows have none)."""
    df.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def write_sessions_by_month(sessions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a session log as Parquet partitioned by calendar month.

    Month-window jobs (P5, P6, C1-C3) then read only the folders of their
    months: their timestamp filters are mirrored on ``month_start`` by
    ``read_sessions_by_month`` so Spark prunes partitions before the scan.
    """
    from pyspark.sql import functions as F
    (sessions.withColumn("month_start", F.trunc(F.to_date("timestamp"), "MM"))
     .write.mode(mode).partitionBy("month_start").parquet(path))


def read_sessions_by_month(spark: SparkSession, path: str) -> DataFrame:
    """The log with its partition column, which every time filter is mirrored on."""
    return spark.read.parquet(path)


def append_prediction_log(log: DataFrame, path: str) -> None:
    """Append one JSON object per prediction (the folder holds one file per write)."""
    log.select(*[f.name for f in PREDICTION_LOG.fields]).write.mode("append").json(path)


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTION_LOG).json(path).select(*PREDICTION_LOG.fieldNames())


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML persistence (replaces pickle/joblib)."""
    model.write().overwrite().save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def load_or_train(spark: SparkSession, path: str, estimator: Pipeline,
                  train: DataFrame | Callable[[], DataFrame]) -> PipelineModel:
    """Load the model at ``path``; only if nothing is there, fit and store it.

    A path that exists but does not load is an error, never a silent retrain.  ``train`` may
    be a function, called only if the model has to be fitted.
    """
    if path_exists(spark, path):
        return PipelineModel.load(path)
    model = estimator.fit(train() if callable(train) else train)
    save_model(model, path)
    return model
