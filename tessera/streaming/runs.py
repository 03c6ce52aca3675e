"""Run a streaming plan to completion into a table in the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.session import ensure_checkpoint_dir, make_folder
from tessera.streaming.triggers import trigger_for


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's checkpoint folder (shared storage)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex[:12]}"


def publish_samples(df: DataFrame, path: str) -> str:
    """Write a batch of samples as files a stream can pick up."""
    df.write.mode("overwrite").parquet(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once: written to a fresh shared folder and read back, for work that reads it several times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_in_turn(df: DataFrame, path: str, ts: str, slices: int) -> Iterator[int]:
    """Write samples as files of consecutive spans of time, one span at each step of the iterator.

    A stream that drains what is there after each step sees the spans as micro-batches in time order, however many
    files a span is. The samples are computed once, and each span is written by all tasks that hold some of it.
    """
    make_folder(df.sparkSession, path)  # a stream can be defined before its first files are there

    def spans():
        samples = staged(df, "in-turn")
        lo, hi = samples.agg(F.min(c(ts)), F.max(c(ts))).first()
        for k in range(slices):
            part = samples
            if k:
                part = part.where(c(ts) >= F.lit(lo + (hi - lo) / slices * k))
            if k < slices - 1:
                part = part.where(c(ts) < F.lit(lo + (hi - lo) / slices * (k + 1)))
            part.write.mode("append").parquet(path)
            yield k
    return spans()


def finished(query, timeout_s: float | None = None) -> None:
    """Wait for a query that drains its input, and raise what it raised."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
    if query.exception() is not None:
        raise query.exception()


def _to_parquet(stream_result: DataFrame, sink: str, checkpoint: str, cadence: str | None = None):
    return (stream_result.writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**trigger_for(cadence)).start())


def drain(stream_result: DataFrame, sink: str, checkpoint: str, cadence: str | None = None,
          timeout_s: float | None = None) -> DataFrame:
    """Append the stream's output to parquet at ``sink`` until the input is drained."""
    finished(_to_parquet(stream_result, sink, checkpoint, cadence), timeout_s)
    return stream_result.sparkSession.read.parquet(sink)


def drain_in_turn(stream_result: DataFrame, arrivals: Iterable, sink: str, checkpoint: str) -> DataFrame:
    """The same after each arrival of files: the query goes on from its checkpoint, its state and watermark with it."""
    for _ in arrivals:
        finished(_to_parquet(stream_result, sink, checkpoint))
    return stream_result.sparkSession.read.parquet(sink)
