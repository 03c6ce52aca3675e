"""The streaming ring against the batch operator: late and reordered samples, gaps, resets, expiry."""

import tempfile
from datetime import datetime, timedelta

import numpy as np
import pytest

from tessera.operators.timeseries import range_summary
from tessera.streaming import rates
from tessera.streaming.runs import drain

T0 = datetime(2024, 1, 1)


def literal(samples, range_us, step_us, upto):
    """Every window recounted from its samples."""
    samples = sorted(samples)
    out = {}
    for k in range(samples[0][0] // step_us, upto // step_us + 1):
        inside = [(u, v) for u, v in samples if k * step_us - range_us < u <= k * step_us]
        if inside:
            delta = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
            out[k * step_us] = (len(inside), *inside[0], *inside[-1], round(delta, 6))
    return out


@pytest.mark.parametrize("n_steps", [1, 4, 40])
def test_ring_answers_each_window_once_in_any_number_of_triggers(n_steps):
    rng = np.random.default_rng(n_steps)
    step = 15_000_000
    us = np.cumsum(rng.choice([1, 4, 15, 40, 3000], 300) * 1_000_000 // rng.choice([1, 3], 300))
    values = rng.integers(0, 30, 300).astype(float)
    samples = list(zip(us.tolist(), values.tolist()))
    ring, done, got = np.empty(0, rates._RING), 0, {}
    for upto in sorted(rng.integers(0, us[-1] // step + 50, 25)):
        part = np.array([s for s in samples if done * step < s[0] <= upto * step], rates._SAMPLE)
        ring = np.concatenate([ring, rates.close_intervals(part, step)])
        found = rates.answer(ring, done, int(upto), n_steps, step)
        for i, t in enumerate(found["t_us"].tolist()):
            assert t not in got
            got[t] = (int(found["n"][i]), *(found[f][i] for f in ("first_us", "first_v", "last_us", "last_v")), round(found["delta"][i], 6))
        done = int(upto)
        ring = ring[ring["k"] > done - n_steps + 1]
        assert len(ring) <= n_steps
    assert got == {t: v for t, v in literal(samples, n_steps * step, step, done * step).items() if t > 0}


def write_in_turn(df, parts, path):
    for p in parts:
        df.where(p).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_over_several_batches(spark):
    base = tempfile.mkdtemp(prefix="tessera-ring-")
    rng = np.random.default_rng(5)
    rows = []
    for key, gap in (("a", 20), ("b", 400), (None, 90), ("gone", 30)):
        t = 0
        for i in range(300 if key != "gone" else 40):
            t += int(rng.integers(1, 2 * gap))
            rows.append((key, T0 + timedelta(seconds=t), float(rng.integers(0, 60)), i))
    rows.append(("a", None, 1.0, 0))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double, i int")
    # the batches overlap in time by less than the watermark's delay
    write_in_turn(df, [f"pmod(hash(ts, i), 9) > 0 and coalesce(ts, timestamp_ntz'2024-01-01') {x}" for x in (
        "< timestamp_ntz'2024-01-01 01:00:00'", "between timestamp_ntz'2024-01-01 01:00:00' and timestamp_ntz'2024-01-01 03:00:00'",
        "> timestamp_ntz'2024-01-01 03:00:00'")], f"{base}/in")
    batch = spark.read.parquet(f"{base}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    out = drain(rates.stream_range_summary(stream, ["k"], "30 minutes", "1 minute", watermark="10 minutes"), f"{base}/out", f"{base}/ck")
    key = lambda r: (r.k, r.t, r.n, r.first_us, r.first_v, r.last_us, r.last_v, round(r.delta, 6))
    last = max(r[1] for r in rows if r[1]) - timedelta(minutes=10)
    expected = [key(r) for r in range_summary(batch, ["k"], "30 minutes", "1 minute").where("n >= 2").collect() if r.t <= last]
    got = [key(r) for r in out.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str) and any(r[0] == "gone" for r in got)


def test_one_state_row_a_series_and_expired_series_leave(spark):
    base = tempfile.mkdtemp(prefix="tessera-state-")
    rows = [(k, T0 + timedelta(seconds=30 * i), float(i)) for k in "abc" for i in range(400)] + [
        ("d", T0 + timedelta(seconds=i), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double")
    df.coalesce(1).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
    s = rates.stream_increase(stream, ["k"], "1 hour", "15 seconds", watermark="1 minute")
    q = (s.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 3  # d's samples lie more than an hour back


def test_steps_must_be_whole_milliseconds(spark):
    stream = spark.readStream.format("rate").load().selectExpr("timestamp as ts", "value")
    for bad in ((10, 15), ("1 minute", 0.0001)):
        with pytest.raises(ValueError):
            rates.stream_rate(stream, [], *bad)
