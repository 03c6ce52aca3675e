"""Streaming rate / increase over counter samples with watermarks.

Each series keeps one state row: a ring with one summary per closed step interval (count, first
and last sample, reset-aware increase inside), at most ``range / step`` of them, and the raw
samples of intervals that the watermark has not passed, since late ones may still come between.
When the watermark passes an interval's end its samples are folded into the ring; every step that
has become final is then answered as a difference of prefix totals over the ring, and summaries
that no later window reaches are dropped. A timer at the next step's end makes a series answer (and
at last vanish) although no sample of it comes. So state grows with range / step of a series, and
a step costs one difference instead of a window of its own.

Event time is shifted by one microsecond so that a sample on an edge belongs to the window
that it closes, ``(t - range, t]``. A step is final once the watermark reaches it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import c
from tessera.functions.timecols import micros, ntz_from_micros, seconds
from tessera.operators.timeseries import _extrapolated

#: A closed interval: its number, samples, first and last sample, increase inside.
_RING = np.dtype([("k", "<i8"), ("n", "<i8"), ("first_us", "<i8"), ("first_v", "<f8"), ("last_us", "<i8"),
                  ("last_v", "<f8"), ("inner", "<f8")])
_SAMPLE = np.dtype([("us", "<i8"), ("v", "<f8")])
_STATE = "ring binary, waiting binary, done long"
_SUMMARY = [("t_us", T.LongType()), ("n", T.LongType()), ("first_us", T.LongType()), ("first_v", T.DoubleType()),
            ("last_us", T.LongType()), ("last_v", T.DoubleType()), ("delta", T.DoubleType())]


def _steps(now: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Counter increase between samples: a drop means a reset, so the new value counts."""
    return np.where(now >= before, now - before, now)


def close_intervals(samples: np.ndarray, step_us: int) -> np.ndarray:
    """Ring rows of some samples: one for each interval, in time order (equal times by value)."""
    if not len(samples):
        return np.empty(0, _RING)
    samples = samples[np.lexsort((samples["v"], samples["us"]))]
    k = (samples["us"] - 1) // step_us + 1
    first = np.flatnonzero(np.diff(k, prepend=k[0] - 1))
    last = np.append(first[1:], len(k)) - 1
    step = np.zeros(len(k))
    step[1:] = _steps(samples["v"][1:], samples["v"][:-1])
    step[first] = 0
    ring = np.zeros(len(first), _RING)
    ring["k"], ring["n"] = k[first], last - first + 1
    ring["first_us"], ring["first_v"] = samples["us"][first], samples["v"][first]
    ring["last_us"], ring["last_v"] = samples["us"][last], samples["v"][last]
    ring["inner"] = np.add.reduceat(step, first)
    return ring


def answer(ring: np.ndarray, after: int, upto: int, n_steps: int, step_us: int) -> dict[str, np.ndarray]:
    """Window summaries of the steps in ``(after, upto]`` whose window holds a sample."""
    reach = min(upto, int(ring["k"][-1]) + n_steps - 1) if len(ring) else after
    at = np.arange(max(after + 1, int(ring["k"][0])) if len(ring) else reach + 1, reach + 1)
    lo, hi = np.searchsorted(ring["k"], at - n_steps + 1), np.searchsorted(ring["k"], at, "right") - 1
    filled = lo <= hi
    at, lo, hi = at[filled], lo[filled], hi[filled]
    edge = np.zeros(len(ring))
    edge[1:] = _steps(ring["first_v"][1:], ring["last_v"][:-1])
    total, count = np.cumsum(ring["inner"] + edge), np.cumsum(ring["n"])
    return {"t_us": at * step_us, "n": count[hi] - count[lo] + ring["n"][lo],
            "first_us": ring["first_us"][lo], "first_v": ring["first_v"][lo],
            "last_us": ring["last_us"][hi], "last_v": ring["last_v"][hi],
            "delta": total[hi] - total[lo] + ring["inner"][lo]}


def _update(keys: list[str], n_steps: int, step_us: int):
    """The state function of one series; see the module's docstring."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        ring, waiting, done = np.empty(0, _RING), np.empty(0, _SAMPLE), None
        if state.exists:
            held = state.get
            ring, waiting, done = np.frombuffer(held[0], _RING), np.frombuffer(held[1], _SAMPLE), held[2]
        new = [waiting]
        for b in batches:
            rows = np.empty(len(b), _SAMPLE)
            rows["us"], rows["v"] = b["__us"].to_numpy(np.int64), b["__v"].to_numpy(np.float64)
            new.append(rows)
        waiting = np.concatenate(new)
        mark = state.getCurrentWatermarkMs()
        final = mark * 1000 // step_us if mark > 0 else -(1 << 62)  # the last step that no sample can join
        done = final if done is None else done
        number = (waiting["us"] - 1) // step_us + 1
        waiting, number = waiting[number > done], number[number > done]
        ring = np.concatenate([ring, close_intervals(waiting[number <= final], step_us)])
        waiting = waiting[number > final]
        if final > done:
            out = answer(ring, done, final, n_steps, step_us)
            if len(out["t_us"]):
                yield pd.DataFrame({**{k: [v] * len(out["t_us"]) for k, v in zip(keys, key)}, **out})
            done = final
            ring = ring[ring["k"] > done - n_steps + 1]
        if not len(ring) and not len(waiting):
            state.remove()
            return
        state.update((ring.tobytes(), waiting.tobytes(), int(done)))
        following = done + 1 if len(ring) else int((waiting["us"].min() - 1) // step_us) + 1
        state.setTimeoutTimestamp(max(mark, following * step_us // 1000 - 1))
    return run


def stream_range_summary(stream: DataFrame, keys: list[str], range, step, ts: str = "ts",
                         value: str = "value", watermark: str = "10 minutes") -> DataFrame:
    """Per series and final step ``t``: n, first/last sample and reset-aware delta (n >= 2).

    One row for every step whose window ``(t - range, t]`` holds two samples, once the watermark
    has reached ``t``. Null times or values are left out, null labels are labels; samples behind the
    watermark are dropped. Steps are whole milliseconds.
    """
    range_s, step_s = seconds(range), seconds(step)
    if range_s < step_s or abs(range_s / step_s - round(range_s / step_s)) > 1e-9:
        raise ValueError("range must be a positive whole multiple of step")
    step_us = int(round(step_s * 1_000_000))
    if step_us % 1000:
        raise ValueError("step must be whole milliseconds")
    us = micros(c(ts), stream.schema[ts].dataType)
    names = [f"__k{i}" for i, _ in enumerate(keys)]
    d = stream.select(*[c(k).alias(n) for k, n in zip(keys, names)], us.alias("__us"), c(value).cast("double").alias("__v"))
    d = (d.where(F.col("__us").isNotNull() & F.col("__v").isNotNull())
         .withColumn("__wts", F.timestamp_micros(F.col("__us") - 1)).withWatermark("__wts", watermark))
    out = T.StructType([*[T.StructField(n, d.schema[n].dataType) for n in names],
                        *[T.StructField(n, t) for n, t in _SUMMARY]])
    g = d.groupBy(*names) if names else d.groupBy(F.lit(0).alias("__all"))
    s = g.applyInPandasWithState(_update(names, int(round(range_s / step_s)), step_us), out, _STATE, "append",
                                 "EventTimeTimeout")
    return s.where(F.col("n") >= 2).select(
        *[F.col(n).alias(k) for k, n in zip(keys, names)], ntz_from_micros(F.col("t_us")).alias("t"), *[n for n, _ in _SUMMARY])


def stream_increase(stream: DataFrame, keys: list[str], range, step, ts: str = "ts", value: str = "value",
                    watermark: str = "10 minutes", as_rate: bool = False, extrapolate: bool = True) -> DataFrame:
    s = stream_range_summary(stream, keys, range, step, ts, value, watermark)
    range_s = seconds(range)
    out = _extrapolated(s, range_s, True, as_rate) if extrapolate else \
        (F.col("delta") / range_s if as_rate else F.col("delta"))
    return s.select(*[c(k) for k in keys], "t", out.alias("value"))


def stream_rate(stream: DataFrame, keys: list[str], range, step, ts: str = "ts", value: str = "value",
                watermark: str = "10 minutes", extrapolate: bool = True) -> DataFrame:
    return stream_increase(stream, keys, range, step, ts, value, watermark, True, extrapolate)
