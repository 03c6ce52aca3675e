"""Queries over the long sample store and the small formatting functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.timecols import elapsed_seconds, seconds_text, stamp
from tessera.plans.catalog import register
from tessera.plans.derived import CLASS_TOTAL, REQUEST_BUCKET, REQUEST_COUNT, STORE_LABELS, metric_feeds, metric_samples
from tessera.plans.queries_metrics import (CLASS_COUNTER_SQL, CPU_COUNTER_SQL, LATENCY_BUCKETS_SQL,
                                           MEMORY_GAUGE_SQL, REQUEST_COUNTER_SQL)
from tessera.sources.files import read_samples
from tessera.sources.samples import read_store, read_store_stream, write_samples
from tessera.sources.tables import table
from tessera.streaming.runs import drain, scratch_path

_STORE_SQL = (f"select 'flask_http_request_duration_seconds_count' as metric, ts, value from ({REQUEST_COUNTER_SQL}) "
              f"union all select 'flask_http_request_duration_seconds_bucket', ts, value from ({LATENCY_BUCKETS_SQL}) "
              f"union all select 'container_cpu_usage_seconds_total', ts, value from ({CPU_COUNTER_SQL}) "
              f"union all select 'container_memory_usage_bytes', ts, value from ({MEMORY_GAUGE_SQL}) "
              f"union all select 'ml_prediction_class_total', ts, value from ({CLASS_COUNTER_SQL})")


@register("metric_store", f"select metric, count(*) as samples, min(ts) as first_ts, max(ts) as last_ts "
                          f"from ({_STORE_SQL}) group by metric")
def q_metric_store(spark, sf_dir):
    s = metric_samples(spark, sf_dir)
    return s.groupBy("metric").agg(F.count(F.lit(1)).alias("samples"), F.min("ts").alias("first_ts"),
                                   F.max("ts").alias("last_ts"))


@register("metric_scan", f"select metric, count(*) as samples, sum(value) as total from ({_STORE_SQL}) "
                         "where metric = 'ml_prediction_class_total' group by metric")
def q_metric_scan(spark, sf_dir):
    """The store on disk, one folder for each metric, read back for one metric."""
    path = scratch_path(spark, "samples")
    for metric, feed in metric_feeds(spark, sf_dir).items():
        # a folder at a time: a write that deals rows to folders itself sorts all rows of a task first
        feed.drop("metric").write.parquet(f"{path}/metric={metric}")
    s = read_samples(spark, path, metric=CLASS_TOTAL)
    return s.groupBy("metric").agg(F.count(F.lit(1)).alias("samples"), F.sum("value").alias("total"))


def stored(spark, sf_dir):
    """All feeds written as a store; its folder."""
    path = scratch_path(spark, "store")
    write_samples(metric_samples(spark, sf_dir), path, STORE_LABELS)
    return path


@register("metric_select", f"select path, count(*) as samples, max(value) as max_value from ({REQUEST_COUNTER_SQL}) "
                           f"where status = '200' and regexp_full_match(path, '/predict.*') group by path")
def q_metric_select(spark, sf_dir):
    """From the store on disk: folders of one metric, row groups of the wanted labels."""
    s = read_store(spark, stored(spark, sf_dir), REQUEST_COUNT, (("status", "=", "200"), ("path", "=~", "/predict.*")))
    return s.groupBy("path").agg(F.count(F.lit(1)).alias("samples"), F.max("value").alias("max_value"))


_FROM, _TO = "2024-01-10 06:00:00", "2024-01-12 18:00:00"
_RANGE_SQL = (f"select path, le, count(*) as samples, sum(value) as total from ({LATENCY_BUCKETS_SQL}) where ts > timestamp '{_FROM}' "
              f"and ts <= timestamp '{_TO}' and path in ('/predict/click', '/predict/view') and le <> '+Inf' group by path, le")


@register("store_range", _RANGE_SQL)
def q_store_range(spark, sf_dir):
    """One metric, some days and a few paths of the store: folders by metric and day, row groups by label and time."""
    s = read_store(spark, stored(spark, sf_dir), REQUEST_BUCKET, _RANGE_MATCHERS, _FROM, _TO)
    return s.groupBy("path", "le").agg(F.count(F.lit(1)).alias("samples"), F.sum("value").alias("total"))


@register("store_stream", _RANGE_SQL)
def q_store_stream(spark, sf_dir):
    """The same from a stream of the store's files."""
    base = scratch_path(spark, "store-stream")
    s = read_store_stream(spark, stored(spark, sf_dir), REQUEST_BUCKET, _RANGE_MATCHERS, _FROM, _TO)
    out = drain(s, f"{base}/out", f"{base}/ckpt")
    return out.groupBy("path", "le").agg(F.count(F.lit(1)).alias("samples"), F.sum("value").alias("total"))


_RANGE_MATCHERS = (("path", "=~", "/predict/(click|view)"), ("le", "!=", "+Inf"))


@register("version_stamps", """select event_id, 'gbt_' || strftime(ts, '%Y%m%d_%H%M%S') as version_name,
  round((epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1e6, 6) as elapsed_seconds,
  printf('%d.%04d', ((epoch_us(ts) - epoch_us(date_trunc('day', ts))) + 50) // 100 // 10000,
         ((epoch_us(ts) - epoch_us(date_trunc('day', ts))) + 50) // 100 % 10000) as elapsed_text from events""")
def q_version_stamps(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    el = F.round(elapsed_seconds(F.date_trunc("day", F.col("ts")), F.col("ts")), 6)
    us = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.date_trunc("day", F.col("ts")))
    return ev.select("event_id", F.concat(F.lit("gbt_"), stamp(F.col("ts"))).alias("version_name"),
                     el.alias("elapsed_seconds"), seconds_text(us).alias("elapsed_text"))
