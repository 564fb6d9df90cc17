"""Session construction and lineage cutting.

On a cluster the session comes from the platform; ``build_session`` is for
local runs and tests.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from
the session and only invents a local folder when nothing is configured, so a
cluster job always checkpoints into the shared folder the cluster names.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of tables that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "cartlens", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def target_partitions(spark: SparkSession) -> int:
    """Partition count for explicit range partitioning: the shuffle setting, or the
    cluster's default parallelism when the setting is not a number (e.g. ``auto``)."""
    value = spark.conf.get("spark.sql.shuffle.partitions", None)
    try:
        return max(1, int(value))
    except (TypeError, ValueError):
        pass
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - Spark Connect
        return 200


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint folder, setting a local one only if unset.

    ``spark.checkpoint.dir`` from the session wins.  Only when nothing is
    configured (tests, local runs) a fresh local folder is created.  A Spark
    Connect session has no SparkContext: the server's setting is used as is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no driver-side context
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # Local runs and tests only: on a cluster each node would write to its own disk.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        configured = tempfile.mkdtemp(prefix="cartlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder.

    Used before a result is read many times (model search), so a lost executor
    re-reads the checkpoint instead of recomputing the whole plan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
