"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every tessera job wants; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small shuffles that feed CPU-heavy steps (explode of output steps, array folds)
    # keep their parallelism instead of being merged into one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app_name: str = "tessera",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with tessera's defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder that ``spark.checkpoint.dir`` names.

    Only a session that runs on this machine alone gets a scratch folder if none is named;
    on a cluster that would be a different disk for each executor, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder, wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

