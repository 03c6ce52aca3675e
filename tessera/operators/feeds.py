"""Metric feeds derived from request and prediction tables.

A served-request table becomes cumulative counters and cumulative latency
histograms (one sample per request), the way an exporter would publish them.
Running sums are a prefix scan, so no task ever holds a whole series: a window inside each (series,
chunk), chunks cut so that none holds too many rows, plus the exclusive total of the earlier
chunks from a per-chunk table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.functions.timecols import micros, ntz_from_micros, seconds


#: Spans of time that a series is cut into, the first that keeps every piece within CHUNK_ROWS rows.
CHUNKS = ("1 hour", "1 minute", "1 s", "1 ms")
CHUNK_ROWS = 1_000_000


def balanced_chunk(df: DataFrame, keys: list[str], ts: str = "ts", rows: int | None = None,
                   chunks: tuple[str, ...] = CHUNKS) -> str:
    """The longest of ``chunks`` by which no series has more than ``rows`` rows in a piece, else the shortest.

    Counts are exact and partial before the shuffle, so the cut depends on the data alone: plans
    that cut twice, and reruns after a lost executor, cut alike. Most feeds need one count.
    """
    rows = CHUNK_ROWS if rows is None else rows
    us = micros(c(ts), df.schema[ts].dataType)
    d = df.select(*[c(k).alias(f"__k{i}") for i, k in enumerate(keys)], us.alias("__us"))
    names = [f"__k{i}" for i, _ in enumerate(keys)]
    for chunk in chunks[:-1]:
        piece = F.expr(f"__us div {int(seconds(chunk) * 1_000_000)}")
        most = d.groupBy(*names, piece.alias("__p")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if (most or 0) <= rows:
            return chunk
    return chunks[-1]


def _carried(per_chunk: DataFrame, totals: list[str], offsets: list[str], per_group: int) -> DataFrame:
    """``__jk`` and the totals of earlier chunks of its series and period.

    Chunks are summed inside groups of ``per_group`` first and the groups after them, so that
    a series cut into many pieces is not one task either.
    """
    key = F.col("__jk")
    p = per_chunk.withColumn("__sp", F.struct(*[key.getField(f).alias(f) for f in per_chunk.schema["__jk"].dataType.names
                                                if f != "__chunk"]))
    p = p.withColumns({"__at": key.getField("__chunk"), "__grp": F.coalesce(F.expr(f"__jk.__chunk div {per_group}"), F.lit(0).cast("long"))})
    inside = Window.partitionBy("__sp", "__grp").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumns({f"{o}_in": F.lit(0.0) if per_group == 1 else F.coalesce(F.sum(t).over(inside), F.lit(0.0))
                       for t, o in zip(totals, offsets)})  # a group of one chunk holds nothing earlier
    groups = p.groupBy("__sp", "__grp").agg(*[F.sum(t).alias(t) for t in totals])
    before = Window.partitionBy("__sp").orderBy("__grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("__sp", "__grp", *[F.coalesce(F.sum(t).over(before), F.lit(0.0)).alias(f"{o}_before")
                                              for t, o in zip(totals, offsets)])
    return p.join(groups, ["__sp", "__grp"]).select("__jk", *[(F.col(f"{o}_before") + F.col(f"{o}_in")).alias(o) for o in offsets])


def running_total(df: DataFrame, keys: list[str], ts: str = "ts", weight: str | list[str] | None = None,
                  order: list[str] | None = None, reset_every: str | float | None = None,
                  chunk: str | float | None = None, out: str | list[str] = "value") -> DataFrame:
    """Cumulative sum of ``weight`` (default 1 per row) per series in time order.

    ``weight`` and ``out`` may be lists: several running sums in the same
    order then share one shuffle and one window. ``reset_every`` restarts the
    total at each period boundary (a process restart). ``chunk`` is the span of time of one
    series that one window task sorts; unless given it follows from row counts
    (:func:`balanced_chunk`), so that an hour that holds most rows spreads over the tasks. It must
    divide ``reset_every``. Rows of one instant follow ``order``.
    """
    weights = weight if isinstance(weight, list) else [weight]
    outs = out if isinstance(out, list) else [out]
    if len(weights) != len(outs):
        raise ValueError("one output column per weight")
    if chunk is None:
        chunk = balanced_chunk(df, keys, ts)
    chunk_us = int(seconds(chunk) * 1_000_000)
    reset_us = int(seconds(reset_every) * 1_000_000) if reset_every else None
    if reset_us and reset_us % chunk_us:
        raise ValueError("chunk must divide reset_every")
    kcols = [c(k) for k in keys]
    ws = {f"__w{i}": F.lit(1).cast("double") if w is None else c(w).cast("double") for i, w in enumerate(weights)}
    us = micros(c(ts), df.schema[ts].dataType)
    d = df.withColumns({**ws, "__us": us})
    d = d.withColumns({"__chunk": F.expr(f"__us div {chunk_us}"),
                       "__period": F.expr(f"__us div {reset_us}") if reset_us else F.lit(0)})
    ordering = [F.col("__us")] + [c(o) for o in (order or [])]
    # one non-null struct key per (series, period, chunk): labels may be null, and struct
    # equality keeps such rows in the offset join; the window's partitioning on this key
    # also serves that join, so the full rows are shuffled once
    d = d.withColumn("__jk", F.struct(*[k.alias(f"__k{i}") for i, k in enumerate(kcols)],
                                      F.col("__period"), F.col("__chunk")))
    within = Window.partitionBy("__jk").orderBy(*ordering) \
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({f"__run{i}": F.sum(w).over(within) for i, w in enumerate(ws)})
    if reset_us == chunk_us:
        totals = [F.col(f"__run{i}") for i in range(len(ws))]
    else:
        per_chunk = d.groupBy("__jk").agg(*[F.sum(w).alias(f"__ct{i}") for i, w in enumerate(ws)])
        hour = max(1, int(seconds(CHUNKS[0]) * 1_000_000) // chunk_us)
        d = d.join(_carried(per_chunk, [f"__ct{i}" for i in range(len(ws))], [f"__off{i}" for i in range(len(ws))], hour), "__jk")
        totals = [F.col(f"__off{i}") + F.col(f"__run{i}") for i in range(len(ws))]
    internal = [*ws, "__us", "__chunk", "__period", "__jk", *[f"__run{i}" for i in range(len(ws))],
                *[f"__off{i}" for i in range(len(ws))]]
    return d.withColumns(dict(zip(outs, totals))).drop(*internal)


def to_counters(df: DataFrame, keys: list[str], ts: str = "ts", weight: str | None = None,
                reset_every: str | float | None = None, order: list[str] | None = None) -> DataFrame:
    """Counter samples ``(keys..., ts, value)``: running count (or sum of ``weight``)."""
    out = running_total(df.select(*[c(k) for k in keys], c(ts), *([c(weight)] if weight else []),
                                  *[c(o) for o in (order or [])]),
                        keys, ts, weight, order, reset_every)
    return out.select(*[c(k) for k in keys], c(ts), "value")


def bucket_label(bound: float) -> str:
    return "+Inf" if bound == float("inf") else repr(float(bound))


def to_buckets(df: DataFrame, keys: list[str], bounds: list[float], observed: str = "duration",
               ts: str = "ts", reset_every: str | float | None = None,
               order: list[str] | None = None) -> DataFrame:
    """Cumulative histogram samples ``(keys..., le, ts, value)``.

    Each observation adds 1 to every bucket whose upper bound ``le`` it does
    not exceed; ``+Inf`` is added when missing. All buckets of a series share
    the time order, so their running counts come from one window over the
    requests (one shuffle of the request rows, not one per bucket); the
    per-bucket rows are made after it.
    """
    wide = to_histogram(df, keys, bounds, observed, ts, reset_every, order)
    per_bucket = F.array(*[F.struct(F.lit(bucket_label(b)).alias("le"), F.col(n).alias("value"))
                           for b, n in zip(*histogram_columns(bounds))])
    return wide.select(*[c(k) for k in keys], c(ts), F.inline(per_bucket)).select(*[c(k) for k in keys], "le", c(ts), "value")


def histogram_columns(bounds: list[float]) -> tuple[list[float], list[str]]:
    """Ascending bounds with ``+Inf``, and the names of their columns in a wide histogram."""
    bounds = sorted(set(float(b) for b in bounds) | {float("inf")})
    return bounds, [f"bucket_{i}" for i, _ in enumerate(bounds)]


def to_histogram(df: DataFrame, keys: list[str], bounds: list[float], observed: str = "duration",
                 ts: str = "ts", reset_every: str | float | None = None,
                 order: list[str] | None = None) -> DataFrame:
    """The same histogram with one row per request: ``(keys..., ts, bucket_0, ...)``, see :func:`histogram_columns`."""
    bounds, counts = histogram_columns(bounds)
    hits = {f"__h{i}": (F.col("__obs") <= F.lit(b)).cast("double") for i, b in enumerate(bounds)}
    d = df.select(*[c(k) for k in keys], c(ts), c(observed).alias("__obs"), *[c(o) for o in (order or [])])
    run = running_total(d.withColumns(hits), keys, ts, list(hits), order, reset_every, out=counts)
    return run.select(*[c(k) for k in keys], c(ts), *counts)


def class_counter(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Predictions per class: ``(prediction_class, n)``."""
    return scored.groupBy(c(prediction).alias("prediction_class")).agg(F.count(F.lit(1)).alias("n"))


def scrape(df: DataFrame, keys: list[str], every: str | float = "15 seconds", ts: str = "ts",
           value: str = "value") -> DataFrame:
    """Samples a scraper would store: at each scrape time ``T`` (a multiple of
    ``every``), the newest value of the series in ``(T - every, T]``.

    Only scrape times whose interval saw an update get a sample. One partial
    aggregation on ``(series, T)``, so a hot series is spread over all tasks.
    """
    every_us = int(round(seconds(every) * 1_000_000))
    us = micros(c(ts), df.schema[ts].dataType)
    at = F.expr(f"(__us - 1) div {every_us} + 1") * F.lit(every_us)
    d = df.select(*[c(k) for k in keys], us.alias("__us"), c(value).cast("double").alias("__v"))
    g = d.groupBy(*[c(k) for k in keys], at.alias("__at")).agg(F.max(F.struct("__us", "__v"))["__v"].alias(value))
    return g.select(*[c(k) for k in keys], ntz_from_micros(F.col("__at")).alias(ts), value)
