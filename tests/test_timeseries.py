import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.functions.labels import match, series_name
from tessera.operators.relabel import apply_rules, relabel_replace
from tessera.operators.timeseries import (counter_delta, histogram_quantile, increase, last_not_null,
                                          range_summary, threshold_band)

T0 = datetime(2024, 1, 1)


def samples(spark, values, step_s=15, key="a", start=T0):
    rows = [(key, start + timedelta(seconds=step_s * (i + 1)), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double")


def test_reset_aware_increase(spark):
    r = counter_delta(samples(spark, [10, 15, 2, 7]), ["k"]).collect()[0]
    assert r["increase"] == 12 and r["samples"] == 4


def test_window_is_left_open_right_closed(spark):
    # samples at 00:00:15 .. 00:01:00; window ending 00:01:00 of 1 minute holds (00:00:00, 00:01:00]
    s = range_summary(samples(spark, [1, 2, 3, 4]), ["k"], "1 minute", "15 seconds")
    by_t = {r["t"]: r for r in s.collect()}
    w = by_t[T0 + timedelta(minutes=1)]
    assert w["n"] == 4 and w["delta"] == 3
    # the window ending 00:01:15 drops the sample at 00:00:15 (left edge is open)
    w2 = by_t[T0 + timedelta(seconds=75)]
    assert w2["n"] == 3 and w2["delta"] == 2


def test_one_sample_window_gives_no_rate(spark):
    inc = increase(samples(spark, [5], step_s=60), ["k"], "1 minute", "15 seconds")
    assert inc.count() == 0


def brute(rows, range_s, step_s, closed="right"):
    """Per step end: samples in (t - range, t] (or [t - range, t]) -> (n, delta)."""
    out = {}
    ts = [t for t, _ in rows]
    lo = (min(ts) // step_s) * step_s
    hi = max(ts) + range_s + step_s
    t = lo
    while t <= hi:
        win = [(a, v) for a, v in rows if (t - range_s < a or (closed == "both" and t - range_s == a)) and a <= t]
        if win:
            d = 0.0
            for (_, p), (_, v) in zip(win, win[1:]):
                d += v - p if v >= p else v
            out[t] = (len(win), d)
        t += step_s
    return out


@pytest.mark.parametrize("seed,chunk", [(1, "1 day"), (2, "1 day"), (3, "1 day"), (4, 600), (5, 900)])
def test_range_summary_matches_brute_force(spark, seed, chunk):
    # small chunks put many running-sum chunk edges inside the series
    rnd = random.Random(seed)
    t, v, rows = 0, 0.0, []
    for _ in range(120):
        t += rnd.randint(1, 400)
        v = 0.0 if rnd.random() < 0.05 else v + rnd.randint(0, 5)
        rows.append((t, v))
    df = spark.createDataFrame([("s", T0 + timedelta(seconds=a), b) for a, b in rows],
                               "k string, ts timestamp_ntz, value double")
    got = {int((r["t"] - T0).total_seconds()): (r["n"], r["delta"])
           for r in range_summary(df, ["k"], 900, 300, chunk=chunk).collect()}
    # the step grid is aligned to the epoch; T0 is a multiple of 300 s, so offsets line up
    assert got == brute(rows, 900, 300)


def test_histogram_quantile_edges(spark):
    t = T0
    rows = [(t, "p", le, c) for le, c in [("0.1", 5.0), ("0.5", 20.0), ("1", 40.0), ("+Inf", 50.0)]]
    df = spark.createDataFrame(rows, "t timestamp_ntz, path string, le string, value double")
    q = lambda x: histogram_quantile(df, x, ["path"]).collect()[0]["value"]
    assert q(0.5) == pytest.approx(0.625)
    assert q(0.95) == pytest.approx(1.0)
    assert q(0.05) == pytest.approx(0.05)
    zero = spark.createDataFrame([(t, "p", le, 0.0) for le in ["0.1", "+Inf"]], df.schema)
    assert math.isnan(histogram_quantile(zero, 0.5, ["path"]).collect()[0]["value"])
    no_inf = spark.createDataFrame([(t, "p", "0.1", 1.0), (t, "p", "1", 2.0)], df.schema)
    assert math.isnan(histogram_quantile(no_inf, 0.5, ["path"]).collect()[0]["value"])


def test_anchored_matchers_and_missing_label(spark):
    df = spark.createDataFrame([("ml-api-1", "200"), ("xml-api-1", "200"), ("ml-api-2", None)],
                               "pod string, status string")
    assert [r["pod"] for r in match(df, ("pod", "=~", "ml-api.*")).collect()] == ["ml-api-1", "ml-api-2"]
    assert [r["pod"] for r in match(df, ("status", "!=", "200")).collect()] == ["ml-api-2"]
    named = df.select(series_name(df, "{{status}} - {{pod}}").alias("n")).collect()
    assert named[0]["n"] == "200 - ml-api-1"


def test_relabel_replace_cases(spark):
    df = spark.createDataFrame([({"__address__": "10.0.0.1:80", "port": "5000"},),
                                ({"__address__": "10.0.0.1", "port": "5000"},),
                                ({"__address__": "a", "port": "b"},)], "labels map<string,string>")
    out = relabel_replace(df, ["__address__", "port"], "__address__", r"([^:]+)(?::\d+)?;(\d+)", "$1:$2")
    assert [r["labels"]["__address__"] for r in out.collect()] == ["10.0.0.1:5000", "10.0.0.1:5000", "a"]
    kept = apply_rules(df, [{"action": "keep", "source_labels": ["port"], "regex": r"\d+"}])
    assert kept.count() == 2
    gone = relabel_replace(df, ["missing"], "port")  # empty result removes the target label
    assert all("port" not in r["labels"] for r in gone.collect())


def test_gauge_reduction_and_colour(spark):
    df = spark.createDataFrame([(T0, 10.0), (T0 + timedelta(seconds=15), 90.0),
                                (T0 + timedelta(seconds=30), float("nan"))], "t timestamp_ntz, value double")
    g = last_not_null(df, []).withColumn("c", threshold_band(F.col("value"), [(None, "green"), (80.0, "red")]))
    r = g.collect()[0]
    assert r["value"] == 90.0 and r["c"] == "red"


def test_running_total_across_chunks_and_resets(spark):
    from tessera.operators.feeds import running_total

    rows = [("a", T0 + timedelta(minutes=40 * i), 1.0) for i in range(80)]  # spans ~2.2 days
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, w double")
    plain = [r["value"] for r in running_total(df, ["k"], weight="w").orderBy("ts").collect()]
    assert plain == [float(i + 1) for i in range(80)]
    daily = running_total(df, ["k"], weight="w", reset_every="1 day").orderBy("ts").collect()
    for r in daily:
        same_day = [x for x in rows if x[1].date() == r["ts"].date() and x[1] <= r["ts"]]
        assert r["value"] == len(same_day)


def test_series_with_a_null_label_is_kept(spark):
    # a series without ``status`` (null label) still gets its windows and running totals
    from tessera.operators.feeds import running_total
    rows = [(None if k == "b" else "200", k, T0 + timedelta(hours=h, seconds=15 * i), float(i))
            for k in ("a", "b") for h in (0, 30) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "status string, k string, ts timestamp_ntz, value double")
    s = range_summary(df, ["status", "k"], "1 minute", "15 seconds", chunk="1 hour")
    assert {r["k"] for r in s.collect()} == {"a", "b"}
    assert s.where(F.col("status").isNull()).count() == s.where(F.col("status").isNotNull()).count()
    tot = running_total(df, ["status", "k"], reset_every="1 day")
    assert tot.where(F.col("status").isNull()).agg(F.max("value")).first()[0] == 4.0
    assert tot.count() == len(rows)


@pytest.mark.parametrize("seed,chunk", [(7, "1 day"), (8, 600)])
def test_closed_both_matches_brute_force(spark, seed, chunk):
    # samples on a 15 s grid put many of them exactly on window edges
    rnd = random.Random(seed)
    t, v, rows = 0, 0.0, []
    for _ in range(150):
        t += 15 * rnd.randint(1, 12)
        v = 0.0 if rnd.random() < 0.05 else v + rnd.randint(0, 5)
        rows.append((t, v))
    df = spark.createDataFrame([("s", T0 + timedelta(seconds=a), b) for a, b in rows],
                               "k string, ts timestamp_ntz, value double")
    got = {int((r["t"] - T0).total_seconds()): (r["n"], r["delta"])
           for r in range_summary(df, ["k"], 300, 60, chunk=chunk, closed="both").collect()}
    assert got == brute(rows, 300, 60, closed="both")
    right = {int((r["t"] - T0).total_seconds()): (r["n"], r["delta"])
             for r in range_summary(df, ["k"], 300, 60, chunk=chunk).collect()}
    assert right == brute(rows, 300, 60) and right != got


def test_scrape_takes_newest_value_per_interval(spark):
    from tessera.operators.feeds import scrape
    # scrape every minute: samples in (T - 1 min, T] give the newest one, stamped T
    rows = [("a", T0 + timedelta(seconds=s), float(v)) for s, v in [(10, 1), (50, 2), (60, 3), (61, 4), (170, 5)]]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double")
    got = {(r["ts"], r["value"]) for r in scrape(df, ["k"], "1 minute").collect()}
    assert got == {(T0 + timedelta(minutes=1), 3.0), (T0 + timedelta(minutes=2), 4.0),
                   (T0 + timedelta(minutes=3), 5.0)}


def test_running_total_with_several_weights_equals_separate_runs(spark):
    from tessera.operators.feeds import running_total
    rnd = random.Random(3)
    rows = [("a" if i % 3 else "b", T0 + timedelta(minutes=7 * i), float(rnd.randint(0, 9)), float(rnd.random()))
            for i in range(400)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double, y double")
    both = running_total(df, ["k"], weight=["x", "y"], out=["cx", "cy"], reset_every="1 day")
    got = {(r["k"], r["ts"]): (r["cx"], round(r["cy"], 9)) for r in both.collect()}
    sx = {(r["k"], r["ts"]): r["value"] for r in running_total(df, ["k"], weight="x", reset_every="1 day").collect()}
    sy = {(r["k"], r["ts"]): round(r["value"], 9)
          for r in running_total(df, ["k"], weight="y", reset_every="1 day").collect()}
    assert got == {key: (sx[key], sy[key]) for key in sx}


def test_latest_closed_both_sees_the_edge_sample(spark):
    from tessera.operators.timeseries import latest
    # a gauge sampled once at 00:00:00; at 00:05:00 only the closed rule still sees it
    df = spark.createDataFrame([("p", T0, 7.0)], "pod string, ts timestamp_ntz, value double")
    t = T0 + timedelta(minutes=5)
    right = {r["t"] for r in latest(df, ["pod"], "1 minute").collect()}
    both = {r["t"]: r["value"] for r in latest(df, ["pod"], "1 minute", closed="both").collect()}
    assert t not in right and both[t] == 7.0


def test_quantile_zero_and_equal_bounds(spark):
    schema = "t timestamp_ntz, path string, le string, value double"
    empty_first = spark.createDataFrame([(T0, "p", "0.1", 0.0), (T0, "p", "0.5", 4.0), (T0, "p", "+Inf", 4.0)], schema)
    assert math.isnan(histogram_quantile(empty_first, 0.0, ["path"]).collect()[0]["value"])
    twice = spark.createDataFrame([(T0, "p", "1", 5.0), (T0, "p", "1.0", 5.0), (T0, "p", "+Inf", 10.0), (T0, "p", "Inf", 0.0)],
                                  schema)
    assert histogram_quantile(twice, 0.5, ["path"]).collect()[0]["value"] == pytest.approx(0.5)


def test_equal_times_are_ordered_by_value(spark):
    rows = [("a", T0 + timedelta(seconds=s), v) for s, v in [(15, 2.0), (15, 1.0), (30, 5.0), (30, 4.0)]]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, ts timestamp_ntz, value double")
        r = range_summary(df, ["k"], "1 minute", "1 minute").collect()[0]
        assert (r["first_v"], r["last_v"], r["delta"]) == (1.0, 5.0, 4.0)


def test_extrapolated_increase_by_hand(spark):
    def value(pairs):
        df = spark.createDataFrame([("a", T0 + timedelta(seconds=s), float(v)) for s, v in pairs],
                                   "k string, ts timestamp_ntz, value double")
        out = {r["t"]: r["value"] for r in increase(df, ["k"], "1 minute", "1 minute").collect()}
        return out[T0 + timedelta(minutes=1)]

    # 45 s sampled; half a minute's start is within 1.1 spacings, but a counter cannot start below zero
    assert value([(15, 0), (30, 10), (45, 20), (60, 30)]) == pytest.approx(30)
    assert value([(15, 5), (30, 15), (45, 25), (60, 35)]) == pytest.approx(30 * (45 + 7.5) / 45)
    # the window starts 45 s before the first sample, more than 1.1 spacings: half a spacing counts
    assert value([(45, 100), (60, 110)]) == pytest.approx(10 * (15 + 7.5) / 15)
    assert value([(15, 50), (60, 50)]) == pytest.approx(0)


def test_matchers_compare_whole_values_with_newlines(spark):
    df = spark.createDataFrame([("ab\n",), ("ab",), ("a\nb",)], "pod string")
    assert [r["pod"] for r in match(df, ("pod", "=~", "ab")).collect()] == ["ab"]
    assert [r["pod"] for r in match(df, ("pod", "=~", "a.b")).collect()] == ["a\nb"]


def test_wide_histogram_equals_one_row_a_bucket(spark):
    from datetime import datetime, timedelta

    from tessera.operators.feeds import to_buckets, to_histogram
    from tessera.plans import dashboard as dash
    rows = [(f"/p{i % 3}", datetime(2024, 1, 1) + timedelta(seconds=7 * i), (i * 37 % 100) / 40) for i in range(600)]
    log = spark.createDataFrame(rows + [("/p0", rows[5][1], 0.3), (None, rows[9][1], 0.1), (None, rows[19][1], 0.2)],
                                "path string, ts timestamp_ntz, duration double")
    bounds = [0.5, 0.1, 2.0]
    for q in (0.0, 0.5, 0.95, 1.0):
        a = dash.latency_quantile(to_buckets(log, ["path"], bounds, reset_every="1 hour", order=["duration"]), q, "2 minutes", "30 seconds")
        b = dash.latency_quantile_wide(to_histogram(log, ["path"], bounds, reset_every="1 hour", order=["duration"]), bounds, q, "2 minutes", "30 seconds")
        norm = lambda df: sorted((str(r.t), str(r.path), str(round(r.value, 9)), r.series) for r in df.select("t", "path", "value", "series").collect())
        assert norm(a) == norm(b) and a.count() > 100


def test_one_request_is_one_row_through_the_shuffle(spark):
    from tessera.plans.derived import latency_histogram
    from tessera.plans import dashboard as dash
    wide = dash.latency_quantile_wide(latency_histogram(spark, "/root/testdata/sf0.001"), [0.1, 0.25, 0.5, 1.0, 2.5, 5.0], 0.95)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" not in plan  # nothing multiplies a request by its buckets; only steps are generated
