"""Data-quality checks on every micro-batch of a stream, and over the whole of it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators.quality import merged_checks, partial_stats, run_all_checks, verdict
from tessera.streaming.triggers import trigger_for, write_batch


def stream_quality(stream: DataFrame, results_path: str, verdict_path: str, checkpoint: str,
                   expected_types: dict | None = None, column_ranges: dict | None = None,
                   missing_threshold: float = 0.1, cadence: str | None = None):
    """Start a query writing each batch's check rows and verdict (keyed by batch id)."""
    def handle(batch, batch_id):
        results = run_all_checks(batch, expected_types, column_ranges, missing_threshold).cache()
        write_batch(results, batch_id, results_path)
        write_batch(verdict(results), batch_id, verdict_path)
        results.unpersist()

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
                  .trigger(**trigger_for(cadence)).start())


def stream_partials(stream: DataFrame, partials_path: str, checkpoint: str, column_ranges: dict | None = None,
                    missing_threshold: float = 0.1, nan_as_missing: bool = False, cadence: str | None = None):
    """Start a query that keeps one row of mergeable statistics for each micro-batch, under its batch id.

    A batch that runs again after a failure replaces its row, so nothing counts twice. The verdict
    over the whole stream, at any time, is that of :func:`stream_checks`.
    """
    def handle(batch, batch_id):
        write_batch(partial_stats(batch, column_ranges, missing_threshold, nan_as_missing), batch_id, partials_path)

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
                  .trigger(**trigger_for(cadence)).start())


def stream_checks(partials: DataFrame, stream: DataFrame, expected_types: dict | None = None, column_ranges: dict | None = None,
                  missing_threshold: float = 0.1, nan_as_missing: bool = False) -> DataFrame:
    """Check rows over all micro-batches so far: as :func:`run_all_checks` on everything that the stream has read."""
    return merged_checks(partials, stream, expected_types, column_ranges, missing_threshold, nan_as_missing)
