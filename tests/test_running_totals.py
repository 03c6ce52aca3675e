"""Running values cut by row counts: a hot hour, a hot second, null labels, resets."""

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.operators import feeds
from tessera.operators.timeseries import counter_delta

T0 = datetime(2024, 1, 1)


def rows():
    out = []
    for i in range(900):  # most rows of one series lie in one hour, many of them in one second
        out.append(("hot", T0 + timedelta(hours=5, milliseconds=i * 20 if i < 200 else 1000 * i + i % 7), i % 5 + 0.5, i))
    for i in range(60):
        out += [("cold", T0 + timedelta(hours=i), 1.5, 1000 + i), (None, T0 + timedelta(minutes=37 * i), 0.25, 2000 + i)]
    return out


def literal(data, reset):
    at, out = defaultdict(float), {}
    for k, t, w, i in sorted(data, key=lambda r: (str(r[0]), r[1], r[3])):
        key = (k, t.date() if reset else 0)
        at[key] += w
        out[i] = at[key]
    return out


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(rows(), "k string, ts timestamp_ntz, w double, i int").repartition(4)


@pytest.mark.parametrize("most, chunk", [(10_000, "1 hour"), (250, "1 minute"), (199, "1 s"), (20, "1 ms")])
def test_chunks_follow_row_counts_and_totals_do_not_change(log, monkeypatch, most, chunk):
    monkeypatch.setattr(feeds, "CHUNK_ROWS", most)
    assert feeds.balanced_chunk(log, ["k"]) == chunk
    for reset in ("1 day", None):
        got = feeds.running_total(log, ["k"], weight="w", order=["i"], reset_every=reset)
        assert {r.i: round(r.value, 6) for r in got.collect()} == literal(rows(), reset)
        assert got.columns == ["k", "ts", "w", "i", "value"]


def test_a_hot_hour_is_many_groups(log, monkeypatch):
    monkeypatch.setattr(feeds, "CHUNK_ROWS", 20)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    width = int(feeds.seconds(feeds.balanced_chunk(log, ["k"])) * 1_000_000)
    pieces = log.where("k = 'hot'").groupBy(F.floor(us / width).alias("p")).count()
    assert pieces.count() > 800 and pieces.agg(F.max("count")).first()[0] <= 20


def test_increase_over_all_samples_of_a_hot_series(spark, monkeypatch):
    monkeypatch.setattr(feeds, "CHUNK_ROWS", 30)
    values = [float((i * 7) % 40) for i in range(900)]
    data = [(k, r[1], v) for k in ("a", None) for r, v in zip(rows()[:900], values)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, value double").repartition(5)
    expected = sum(b - a if b >= a else b for a, b in zip(values, values[1:]))
    assert {(r.k, r.increase, r.samples) for r in counter_delta(df, ["k"]).collect()} == {("a", expected, 900), (None, expected, 900)}
    assert counter_delta(df.limit(0), ["k"]).count() == 0


def test_chunk_must_divide_the_period(log):
    with pytest.raises(ValueError):
        feeds.running_total(log, ["k"], reset_every="90 minutes", chunk="1 hour")
