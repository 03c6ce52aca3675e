"""Streaming scoring: request files in, one response per request out, however often it is delivered."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.plans.scoring import score_requests
from tessera.sources.requests import parse_tabular_requests, parse_text_requests
from tessera.streaming.triggers import trigger_for, write_batch

REQUEST_FILE_SCHEMA = "request_id bigint, body string"


def stream_scores(spark: SparkSession, source_path: str, model: PipelineModel, features: list[str],
                  request_schema: str | None, required: list[str], sink_path: str, log_path: str,
                  checkpoint: str, cadence: str | None = None, json_col: str = "body",
                  file_schema: str = REQUEST_FILE_SCHEMA, max_files_per_trigger: int | None = None,
                  sent_col: str | None = None, delay: str = "10 minutes", rejects_path: str | None = None):
    """Start a query that parses, checks and scores request files as they arrive.

    Without a ``request_schema`` the requests are text ones (one ``text`` each) for a text model.

    With ``sent_col``, the time at which a request was sent, a request id that is delivered again is
    answered once: ids are kept until the watermark (the newest time less ``delay``) has passed
    them, and requests that come later than that are dropped and counted by the query's progress.
    Requests without a time cannot be told from redelivered ones and are dropped too. With
    ``rejects_path``, rejected and malformed requests go there and only answers to ``sink_path``.

    Each micro-batch writes its scores and one request-log row
    ``(batch_id, rows, rejected, seconds, logged_at)`` under its batch id, so a
    restarted query (from ``checkpoint``) replaces rather than repeats them.
    """
    reader = spark.readStream.schema(file_schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.load(source_path)
    if sent_col:
        source = source.where(c(sent_col).isNotNull()).withWatermark(sent_col, delay).dropDuplicatesWithinWatermark(["request_id"])

    def handle(batch, batch_id):
        if request_schema is None:
            requests, names, ids = parse_text_requests(batch, json_col), ["text"], ("request_id",)
        else:
            requests, names, ids = parse_tabular_requests(batch, json_col, request_schema, required), features, ("request_id", "pos")
        requests = requests.persist()  # parsed, and told from redelivered ones, once for both parts
        ok = F.col("status") == "ok"
        parts = [(requests, sink_path)] if rejects_path is None else [(requests.where(ok), sink_path), (requests.where(~ok), rejects_path)]
        seconds, counts = 0.0, {"rows": 0, "rejected": 0}
        for k, (part, path) in enumerate(parts):
            obs = Observation(f"scores-{batch_id}-{k}")
            scored = score_requests(model, part, names, ids).observe(
                obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("status") != "ok").alias("rejected"))
            seconds += write_batch(scored, batch_id, path)
            counts = {n: counts[n] + obs.get[n] for n in counts}  # counted by the write itself, no second pass
        requests.unpersist()
        log = spark.createDataFrame([(counts["rows"], counts["rejected"], seconds, datetime.now(timezone.utc).isoformat())],
                                    "rows long, rejected long, processing_time_seconds double, logged_at string")
        write_batch(log, batch_id, log_path)

    return (source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
                  .trigger(**trigger_for(cadence)).start())
