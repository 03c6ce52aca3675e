"""The monitoring dashboard's panels as DataFrame plans over metric samples.

Each panel query of the dashboard becomes one function. Ranges and steps
are parameters: the dashboard's own are 1m/5m/24h windows at a 15 s step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.labels import match, series_name
from tessera.operators.feeds import histogram_columns
from tessera.operators.timeseries import (histogram_quantile, histogram_quantile_wide, increase, last_not_null, latest, rate,
                                          sum_by, threshold_band)

# Fixed values from the dashboard: label matchers (also applied to a feed's log, before its running
# totals), gauge colours, its red line and quantiles.
OK, FAILED = ("status", "=", "200"), ("status", "!=", "200")
PREDICT, ML_PODS = ("path", "=~", "/predict.*"), ("pod", "=~", "ml-api.*")
GAUGE_STEPS = [(None, "green"), (80.0, "red")]
P95, P50 = 0.95, 0.50


def request_rate(counter: DataFrame, range="1 minute", step="15 seconds") -> DataFrame:
    """Successful requests per second by path (``status="200"``)."""
    r = rate(match(counter, OK), ["path", "status"], range, step)
    return r.withColumn("series", series_name(r, "{{path}}"))


def error_rate(counter: DataFrame, range="1 minute", step="15 seconds") -> DataFrame:
    """Non-200 requests per second by status and path."""
    r = rate(match(counter, FAILED), ["path", "status"], range, step)
    return r.withColumn("series", series_name(r, "{{status}} - {{path}}"))


def latency_quantile(buckets: DataFrame, q: float, range="1 minute", step="15 seconds",
                     legend: str = "p95 - {{path}}") -> DataFrame:
    """``histogram_quantile(q, sum(rate(bucket)) by (le, path))``."""
    r = sum_by(rate(buckets, ["path", "le"], range, step), ["le", "path"])
    h = histogram_quantile(r, q, ["path"])
    return h.withColumn("series", series_name(h, legend))


def latency_quantile_wide(histogram: DataFrame, bounds: list[float], q: float, range="1 minute", step="15 seconds",
                          legend: str = "p95 - {{path}}") -> DataFrame:
    """The same panel from one row per request with a column for each bucket (``feeds.to_histogram``)."""
    bounds, counts = histogram_columns(bounds)
    r = rate(histogram, ["path"], range, step, value=counts)
    r = r.groupBy("t", "path").agg(*[F.sum(n).alias(n) for n in counts])
    h = histogram_quantile_wide(r, q, ["path"], counts, bounds)
    return h.withColumn("series", series_name(h, legend))


def prediction_rate(counter: DataFrame, range="5 minutes", step="15 seconds") -> DataFrame:
    """Total successful ``/predict...`` requests per second."""
    sel = match(counter, OK, PREDICT)
    return sum_by(rate(sel, ["path", "status"], range, step), [])


def prediction_rate_gauge(counter: DataFrame, range="5 minutes", step="15 seconds") -> DataFrame:
    """The gauge: newest non-null prediction rate and its colour band."""
    g = last_not_null(prediction_rate(counter, range, step), [])
    return g.withColumn("colour", threshold_band(F.col("value"), GAUGE_STEPS))


def pod_cpu(cpu_counter: DataFrame, range="1 minute", step="15 seconds") -> DataFrame:
    """CPU percent by pod: summed 1 min rate of CPU seconds x 100, pods ``ml-api.*``."""
    r = sum_by(rate(match(cpu_counter, ML_PODS), ["pod"], range, step), ["pod"])
    return r.withColumn("value", F.col("value") * 100).withColumn("series", series_name(r, "{{pod}}"))


def pod_memory(memory_gauge: DataFrame, step="15 seconds", lookback="5 minutes") -> DataFrame:
    """Memory bytes by pod: newest gauge sample in the look-back at each step, summed."""
    g = sum_by(latest(match(memory_gauge, ("pod", "=~", "ml-api.*")), ["pod"], step, lookback), ["pod"])
    return g.withColumn("series", series_name(g, "{{pod}}"))


def class_increase(class_counter: DataFrame, range="24 hours", step="15 seconds",
                   extrapolate: bool = True) -> DataFrame:
    """``sum(increase(class_total[24h])) by (prediction_class)`` at each step."""
    return sum_by(increase(class_counter, ["prediction_class"], range, step, extrapolate=extrapolate),
                  ["prediction_class"])


def class_distribution(class_counter: DataFrame, range="24 hours", step="15 seconds") -> DataFrame:
    """Per class, the total over the shown steps (the panel's series-mode x axis)."""
    inc = class_increase(class_counter, range, step)
    return (inc.groupBy("prediction_class").agg(F.sum("value").alias("total"))
               .withColumn("series", F.concat(F.lit("Class "), F.col("prediction_class"))))
