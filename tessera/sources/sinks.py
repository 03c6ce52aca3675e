"""File sinks with the guards the write path needs."""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from datetime import datetime, timezone
from urllib.parse import urlparse
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SINK_FORMATS = ("parquet", "csv")
#: Suffix of the folder that holds a destination's old data while new ones move in.
OLD = ".replaced"


def _norm(path: str) -> str:
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return os.path.abspath(parsed.path if parsed.scheme else path).rstrip("/")
    return f"{parsed.scheme}://{parsed.netloc}{parsed.path}".rstrip("/")


def scan_roots(df: DataFrame) -> list[str]:
    """The paths that the plan of ``df`` scans, as they were given to the reader; no file is listed."""
    found, open_ = [], [df._jdf.queryExecution().analyzed()]
    while open_:
        node = open_.pop()
        for seq in (node.children(), node.subqueries()):
            open_ += [seq.apply(i) for i in range(seq.size())]
        kind = lambda x: x.getClass().getSimpleName()
        if kind(node) == "LogicalRelation" and kind(node.relation()) == "HadoopFsRelation":
            roots = node.relation().location().rootPaths()
            found += [roots.apply(i).toString() for i in range(roots.size())]
    return found


def _reads_from(df: DataFrame, destination: str) -> bool:
    dest = _norm(destination)
    return any(src == dest or src.startswith(dest + "/") for src in map(_norm, scan_roots(df)))


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def recover(spark: SparkSession, destination_path: str) -> bool:
    """Put back the old data of a destination whose publishing was cut off between its two renames."""
    fs, dest = _file_system(spark, destination_path)
    old = dest.suffix(OLD)
    if fs.exists(dest) or not fs.exists(old):
        return False
    return fs.rename(old, dest)


def publish(spark: SparkSession, write: Callable[[str], None], destination_path: str) -> None:
    """Let ``write`` fill a staged folder beside the destination, and swap it in once it is complete.

    Complete means that Spark's commit marker is there. A write that fails, or a driver that is lost
    while it runs, leaves the old data as they were; the time between the two renames is covered
    by :func:`recover`, which every publish begins with. Renames are atomic on HDFS and local disks; on
    stores that copy instead, readers may meet a missing folder meanwhile, never a half-written one that
    carries the marker.
    """
    recover(spark, destination_path)
    fs, dest = _file_system(spark, destination_path)
    staged, old = dest.suffix(f".staged-{uuid4().hex[:12]}"), dest.suffix(OLD)
    try:
        write(staged.toString())
        if not fs.exists(staged.suffix("/_SUCCESS")):
            raise RuntimeError(f"{staged} has no commit marker")
        if fs.exists(dest):
            fs.delete(old, True)
            if not fs.rename(dest, old):
                raise RuntimeError(f"cannot move {dest} aside")
        if not fs.rename(staged, dest):
            recover(spark, destination_path)
            raise RuntimeError(f"cannot move {staged} to {dest}")
        fs.delete(old, True)
    finally:
        if fs.exists(staged):
            fs.delete(staged, True)


def load(df: DataFrame, destination_path: str, format: str = "parquet",
         partition_by: list[str] | None = None) -> None:
    """Overwrite ``destination_path`` with ``df`` as parquet or csv (with header), by :func:`publish`.

    JSON is readable but not writable here. Writing over the folder the frame
    reads from would delete its own input, so that raises too.
    """
    if format not in SINK_FORMATS:
        raise ValueError(f"Unsupported format: {format}")
    if _reads_from(df, destination_path):
        raise ValueError(f"Destination {destination_path} is also a source of this DataFrame")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    publish(df.sparkSession, writer.parquet if format == "parquet" else writer.option("header", "true").csv, destination_path)


def write_scores(df: DataFrame, path: str, log_path: str | None = None, run_id: str | None = None,
                 rejected: Column | None = None) -> tuple[str, int, float]:
    """Write scored rows (one response per request) under a run's id; ``(run id, rows, seconds)``.

    The log row ``(run_id, rows, rejected, processing_time_seconds, logged_at)`` is observed by the write
    itself, with no second pass. A run that is repeated under its id replaces what it wrote before.
    """
    run_id = run_id or uuid4().hex
    obs = Observation(f"scores-{run_id}")
    seen = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.lit(False) if rejected is None else rejected).alias("rejected"))
    start = time.perf_counter()
    _replace_run(seen, run_id, path)
    seconds = time.perf_counter() - start
    if log_path:
        row = (obs.get["rows"], obs.get["rejected"], seconds, datetime.now(timezone.utc).isoformat())
        log = df.sparkSession.createDataFrame([row], "rows long, rejected long, processing_time_seconds double, logged_at string")
        _replace_run(log, run_id, log_path)
    return run_id, obs.get["rows"], seconds


def _replace_run(df: DataFrame, run_id: str, path: str) -> None:
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("run_id").parquet(path))
