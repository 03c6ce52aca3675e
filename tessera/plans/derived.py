"""Inputs derived from the driver tables with plain expressions.

The driver tables hold no nulls, NaN or metric samples, so these views make
them (the same expressions are spelled in the DuckDB oracles).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.labels import match
from tessera.sources.tables import table


def lineitem_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with ``l_discount`` null where 0.05 and ``l_returnflag`` null where 'N'."""
    return with_nulls(table(spark, sf_dir, "lineitem"))


def with_nulls(lineitem: DataFrame) -> DataFrame:
    """The same of any frame of that shape, a stream too."""
    return lineitem.withColumns({
        "l_discount": F.nullif(F.col("l_discount"), F.lit(0.05)),
        "l_returnflag": F.nullif(F.col("l_returnflag"), F.lit("N")),
    })


def lineitem_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with NaN in ``l_tax`` where it is 0.02 (NaN is not null)."""
    li = lineitem_with_nulls(spark, sf_dir)
    return li.withColumn("l_tax", F.when(F.col("l_tax") == 0.02, F.lit(float("nan")))
                         .otherwise(F.col("l_tax")))


def lineitem_numeric_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_linenumber`` as text, plus ``'abc'`` where the line number is 7."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        F.col("l_linenumber").cast("string").alias("line_text"),
        F.when(F.col("l_linenumber") == 7, F.lit("abc"))
         .otherwise(F.col("l_linenumber").cast("string")).alias("line_text_dirty"),
        F.col("l_quantity").cast("string").alias("qty_text"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Served requests from ``events``: path, status, duration (s), pod."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts", "user_id",
        F.concat(F.lit("/predict/"), F.col("event_type")).alias("path"),
        F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200")).alias("status"),
        (F.col("value") / 100).alias("duration"),
        F.concat(F.lit("ml-api-"), (F.col("user_id") % 3).cast("string")).alias("pod"),
        "value")


def documents_labelled(spark: SparkSession, sf_dir: str, how: str = "left") -> DataFrame:
    """``documents`` with ``labels`` joined on ``doc_id`` (left: many unlabelled)."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", how)


# Fixed feed parameters: latency bucket bounds (seconds) and the counter restart period.
LATENCY_BOUNDS = [0.1, 0.25, 0.5, 1.0, 2.5, 5.0]
RESET_EVERY = "1 day"


def selected_log(spark: SparkSession, sf_dir: str, *matchers, since=None, until=None) -> DataFrame:
    """The request log of some series and days, cut before any running total is made.

    Matchers select whole series, and totals restart each day, so samples after ``since`` need
    requests from the start of its day on; ``until`` needs none after it.
    """
    log = match(request_log(spark, sf_dir), *matchers)
    if since is not None:
        log = log.where(F.col("ts") >= F.lit(since.replace(hour=0, minute=0, second=0, microsecond=0)).cast("timestamp_ntz"))
    return log if until is None else log.where(F.col("ts") <= F.lit(until).cast("timestamp_ntz"))


def request_counter(spark: SparkSession, sf_dir: str, *matchers, since=None, until=None) -> DataFrame:
    """Served-request counter per (path, status), restarted daily; see :func:`selected_log`."""
    from tessera.operators.feeds import to_counters
    log = selected_log(spark, sf_dir, *matchers, since=since, until=until)
    return to_counters(log, ["path", "status"], reset_every=RESET_EVERY)


def scraped_request_counter(spark: SparkSession, sf_dir: str, every: str = "1 minute") -> DataFrame:
    """The request counter as a scraper stores it: one sample per minute that saw requests,
    stamped at the minute's end (so samples fall on window edges)."""
    from tessera.operators.feeds import scrape
    return scrape(request_counter(spark, sf_dir), ["path", "status"], every)


def latency_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative latency histogram per (path, le), restarted daily."""
    from tessera.operators.feeds import to_buckets
    return to_buckets(request_log(spark, sf_dir), ["path"], LATENCY_BOUNDS, reset_every=RESET_EVERY)


def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same histogram per path, one row per request."""
    from tessera.operators.feeds import to_histogram
    return to_histogram(request_log(spark, sf_dir), ["path"], LATENCY_BOUNDS, reset_every=RESET_EVERY)


def cpu_counter(spark: SparkSession, sf_dir: str, *matchers) -> DataFrame:
    """CPU seconds per pod: running sum of request durations, restarted daily."""
    from tessera.operators.feeds import to_counters
    return to_counters(selected_log(spark, sf_dir, *matchers), ["pod"], weight="duration", reset_every=RESET_EVERY)


def memory_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memory bytes per pod as a gauge: ``value * 1e6`` at each request."""
    return request_log(spark, sf_dir).select("pod", "ts", (F.col("value") * 1e6).alias("value"))


def prediction_class_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions per class as a counter; the class is ``value >= 50`` of the request."""
    from tessera.operators.feeds import to_counters
    scored = request_log(spark, sf_dir).withColumn(
        "prediction_class", F.when(F.col("value") >= 50, F.lit("1")).otherwise(F.lit("0")))
    return to_counters(scored, ["prediction_class"], reset_every=RESET_EVERY)


# The metric names the dashboard queries.
REQUEST_COUNT = "flask_http_request_duration_seconds_count"
REQUEST_BUCKET = "flask_http_request_duration_seconds_bucket"
POD_CPU = "container_cpu_usage_seconds_total"
POD_MEMORY = "container_memory_usage_bytes"
CLASS_TOTAL = "ml_prediction_class_total"
STORE_LABELS = ("path", "status", "le", "pod", "prediction_class")


def metric_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The feeds by metric name, each as samples ``(metric, labels map, ts, value)``."""
    def long(df, metric, labels):
        m = F.create_map(*[x for name in labels for x in (F.lit(name), F.col(name))])
        return df.select(F.lit(metric).alias("metric"), m.alias("labels"), "ts", "value")
    feeds = ((REQUEST_COUNT, request_counter, ["path", "status"]), (REQUEST_BUCKET, latency_buckets, ["path", "le"]),
             (POD_CPU, cpu_counter, ["pod"]), (POD_MEMORY, memory_gauge, ["pod"]),
             (CLASS_TOTAL, prediction_class_counter, ["prediction_class"]))
    return {metric: long(feed(spark, sf_dir), metric, labels) for metric, feed, labels in feeds}


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds as one sample store ``(metric, labels map, ts, value)``."""
    return reduce(DataFrame.unionByName, metric_feeds(spark, sf_dir).values())
