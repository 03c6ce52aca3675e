"""Streaming queries: samples exported by the batch feed are consumed by a stream.

A window is final once the watermark (newest event minus the delay) has
passed its end, so the result holds only finished windows; the oracle
states the same rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.catalog import register, rounded
from tessera.plans.derived import prediction_class_counter, request_counter
from tessera.plans.queries_metrics import (CLASS_COUNTER_SQL, LONG_RANGE_S, LONG_STEP_S, RANGE_S, REQUEST_COUNTER_SQL,
                                           STEP_S, extrapolated_sql, summary_sql)
from tessera.streaming.rates import stream_increase, stream_rate
from tessera.sources.tables import table, table_stream
from tessera.streaming.runs import drain, drain_in_turn, finished, publish_in_turn, publish_samples, scratch_path, staged

DELAY_S = 7200  # watermark delay


@register("stream_rate_1h", (
    f"with {summary_sql(REQUEST_COUNTER_SQL, ['path', 'status'], RANGE_S, STEP_S)} "
    f"select path, status, make_timestamp(t_us) as t, round({extrapolated_sql(RANGE_S, True)}, 9) as value "
    f"from summ where n >= 2 and t_us <= (select max(epoch_us(ts)) - 1 from ({REQUEST_COUNTER_SQL})) "
    f"- {DELAY_S * 1_000_000}"))
def q_stream_rate_1h(spark, sf_dir):
    base = scratch_path(spark, "stream-rate")
    samples = request_counter(spark, sf_dir)
    src = publish_samples(samples, f"{base}/samples")
    stream = spark.readStream.schema(samples.schema).parquet(src)
    out = stream_rate(stream, ["path", "status"], RANGE_S, STEP_S, watermark=f"{DELAY_S} seconds")
    return rounded(drain(out, f"{base}/out", f"{base}/ckpt"), 9)


SLICES = 5  # micro-batches of the long stream


@register("stream_increase_24h", (
    f"with {summary_sql(CLASS_COUNTER_SQL, ['prediction_class'], LONG_RANGE_S, LONG_STEP_S)} "
    f"select prediction_class, make_timestamp(t_us) as t, round({extrapolated_sql(LONG_RANGE_S, False)}, 9) as value "
    f"from summ where n >= 2 and t_us <= (select max(epoch_us(ts)) - 1 from ({CLASS_COUNTER_SQL})) "
    f"- {DELAY_S * 1_000_000}"))
def q_stream_increase_24h(spark, sf_dir):
    """The class panel's own window and step, fed in several micro-batches."""
    base = scratch_path(spark, "stream-increase")
    samples = prediction_class_counter(spark, sf_dir)
    arrivals = publish_in_turn(samples, f"{base}/samples", "ts", SLICES)
    stream = spark.readStream.schema(samples.schema).parquet(f"{base}/samples")
    out = stream_increase(stream, ["prediction_class"], LONG_RANGE_S, LONG_STEP_S, watermark=f"{DELAY_S} seconds")
    return rounded(drain_in_turn(out, arrivals, f"{base}/out", f"{base}/ckpt"), 9)


from tessera.plans.catalog import LINEITEM_COLS, LINEITEM_NULLS_SQL, _union  # noqa: E402
from tessera.plans.derived import lineitem_with_nulls, with_nulls  # noqa: E402
from tessera.streaming.quality import stream_quality  # noqa: E402

STREAM_THRESHOLD = 0.1


def _stream_missing_sql():
    parts = [f"select 'missing_values' as \"check\", '{c}' as column_name, "
             f"(count(*) filter (where {c} is null))::double / count(*) as missing_fraction, "
             f"(count(*) filter (where {c} is null))::double / count(*) <= {STREAM_THRESHOLD} as passed, "
             f"cast(0 as bigint) as batch_id from t" for c in LINEITEM_COLS]
    return f"with t as ({LINEITEM_NULLS_SQL})\n" + _union(parts)


@register("stream_quality", _stream_missing_sql())
def q_stream_quality(spark, sf_dir):
    base = scratch_path(spark, "stream-quality")
    data = lineitem_with_nulls(spark, sf_dir)
    src = publish_samples(data, f"{base}/in")
    stream = spark.readStream.schema(data.schema).parquet(src)
    finished(stream_quality(stream, f"{base}/results", f"{base}/verdict", f"{base}/ckpt",
                            missing_threshold=STREAM_THRESHOLD))
    res = spark.read.parquet(f"{base}/results")
    return res.select("check", "column_name", "missing_fraction", "passed", "batch_id")


from tessera.plans.queries_quality import LINEITEM_RANGES, _missing_sql, _range_sql  # noqa: E402
from tessera.streaming.quality import stream_checks, stream_partials  # noqa: E402


@register("stream_quality_total", f"with t as ({LINEITEM_NULLS_SQL})\n" + _union(
    _missing_sql(LINEITEM_COLS, threshold=STREAM_THRESHOLD) + _range_sql(LINEITEM_RANGES, LINEITEM_COLS)))
def q_stream_quality_total(spark, sf_dir):
    """The table itself as a stream, a file at a time; the checks over all of it from one row a micro-batch."""
    base = scratch_path(spark, "stream-quality-total")
    stream = with_nulls(table_stream(spark, sf_dir, "lineitem"))
    finished(stream_partials(stream, f"{base}/partials", f"{base}/ckpt", LINEITEM_RANGES, STREAM_THRESHOLD))
    return stream_checks(spark.read.parquet(f"{base}/partials"), with_nulls(table(spark, sf_dir, "lineitem")), None,
                         LINEITEM_RANGES, STREAM_THRESHOLD)


from tessera.operators.models import build_model  # noqa: E402
from tessera.plans.queries_text import _TAB_REQ_SQL, REQUEST_SCHEMA, REQUIRED, tabular_request_text  # noqa: E402
from tessera.sources.requests import parse_tabular_requests  # noqa: E402
from tessera.plans.scoring import score_requests  # noqa: E402
from tessera.sources.sinks import write_scores  # noqa: E402
from tessera.streaming.scoring import stream_scores  # noqa: E402

#: Requests are delivered again in a later file while the watermark still covers them.
REDELIVERED, SCORE_FEATURES = "event_id % 3 = 0", ["feature1", "feature2"]


@register("stream_scoring", f"""select request_id, pos, status, error,
  case when status = 'ok' then true end as has_class, case when status = 'ok' then true end as has_confidence
from ({_TAB_REQ_SQL})""")
def q_stream_scoring(spark, sf_dir):
    """Request files with redelivered ids, in several micro-batches: one answer for each, rejects apart."""
    base = scratch_path(spark, "stream-scoring")
    events = table(spark, sf_dir, "events")
    sent = events.select(F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("sent"))
    requests = tabular_request_text(events).join(sent, "request_id")
    again = requests.where(F.expr(REDELIVERED.replace("event_id", "request_id"))).withColumn("sent", F.expr("sent + interval 1 hour"))
    train = (parse_tabular_requests(requests, "body", REQUEST_SCHEMA, REQUIRED)
             .where("status = 'ok' and feature2 is not null and feature3 is not null")
             .withColumn("label", (F.col("feature3") == "purchase").cast("int")))
    train = staged(train, "stream-scoring-train")  # a fit reads its rows several times
    pipe = build_model("gbt", SCORE_FEATURES, "label")
    gbt = pipe.getStages()[-1]
    model = pipe.fit(train, {gbt.maxIter: 5, gbt.maxDepth: 3})
    for _ in publish_in_turn(requests.unionByName(again), f"{base}/requests", "sent", SLICES):
        finished(stream_scores(spark, f"{base}/requests", model, SCORE_FEATURES, REQUEST_SCHEMA, REQUIRED, f"{base}/scores", f"{base}/log",
                               f"{base}/ckpt", file_schema="request_id bigint, body string, sent timestamp",
                               sent_col="sent", delay="2 hours", rejects_path=f"{base}/rejects"))
    out = spark.read.parquet(f"{base}/scores").unionByName(spark.read.parquet(f"{base}/rejects"))
    return out.select("request_id", "pos", "status", "error", F.col("prediction").isin(0, 1).alias("has_class"),
                      F.col("confidence").between(0.5, 1).alias("has_confidence"))


@register("batch_scoring_log", f"select count(*) as rows, count(*) filter (where status <> 'ok') as rejected, "
          f"1::bigint as runs, true as timed from ({_TAB_REQ_SQL})")
def q_batch_scoring_log(spark, sf_dir):
    """Scored requests written under a run's id, twice: the log states the counts of one run."""
    base = scratch_path(spark, "batch-scoring")
    # parsed once, for the fit and for both runs
    requests = staged(parse_tabular_requests(tabular_request_text(table(spark, sf_dir, "events")), "body", REQUEST_SCHEMA, REQUIRED),
                      "batch-scoring-requests")
    train = (requests.where("status = 'ok' and feature2 is not null and feature3 is not null")
             .withColumn("label", (F.col("feature3") == "purchase").cast("int")))
    pipe = build_model("gbt", SCORE_FEATURES, "label")
    gbt = pipe.getStages()[-1]
    scored = score_requests(pipe.fit(train, {gbt.maxIter: 5, gbt.maxDepth: 3}), requests, SCORE_FEATURES)
    for _ in range(2):
        write_scores(scored, f"{base}/scores", f"{base}/log", run_id="run", rejected=F.col("status") != "ok")
    stored = spark.read.parquet(f"{base}/scores").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("status") != "ok").alias("rejected"))
    log = spark.read.parquet(f"{base}/log").agg(F.sum("rows").alias("n"), F.sum("rejected").alias("r"), F.count(F.lit(1)).alias("runs"),
                                                F.min(F.col("processing_time_seconds") > 0).alias("timed"))
    return stored.join(log, (stored["rows"] == log["n"]) & (stored["rejected"] == log["r"])).select("rows", "rejected", "runs", "timed")
