"""Range-vector analytics over labelled samples: counters, rates, increases.

Samples are rows ``(label columns..., ts, value)``; a series is one
combination of label values. Windows are left-open, right-closed
``(t - range, t]`` and evaluated at step ends ``t = k * step``.

Scale design (no range join, no per-sample fan-out, no whole-series task):

1. Each sample falls in exactly one step interval ``k = ceil(ts / step)``.
   Samples are shuffled once by ``(series, k)``; a ``lag`` inside that
   partition gives the reset-aware step of every sample but the first of an
   interval, and ``groupBy(series, k)`` (same partitioning, no new exchange)
   reduces them to one row per non-empty interval.
2. The interval table (one row per series and step, whatever the raw sample
   rate) gets running sums per series, so any window is a difference of two
   prefix sums. The running sums are two-phase: a window inside each
   (series, day of intervals) plus the exclusive totals of earlier days from
   a per-day table, so a long history is never sorted in one task.
3. Every output step ``K`` is generated exactly once from its last non-empty
   interval and once from its first non-empty interval (``sequence`` +
   ``explode`` bounded by the range in steps); one ``groupBy(series, K)``
   pairs the two rows, which spreads even a hot series over all partitions
   and computes the interval table once.
"""

from __future__ import annotations

import builtins
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.functions.timecols import micros, ntz_from_micros, seconds
from tessera.operators.feeds import CHUNKS, balanced_chunk


DAY_S = 86400.0


def reset_step(value: Column, prev: Column) -> Column:
    """Counter increase between two samples: a drop means a reset, so the new value counts."""
    return F.when(prev.isNull(), F.lit(None).cast("double")) \
            .when(value >= prev, value - prev).otherwise(value)


def _list(value: str | list[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def counter_delta(df: DataFrame, keys: list[str], ts: str = "ts", value: str = "value",
                  chunk: str | float | None = None) -> DataFrame:
    """Total reset-aware increase per series over all its samples.

    ``10, 15, 2, 7`` gives 12. Samples are reduced per (series, chunk) first, so no task holds a
    whole series; unless given, the chunk is cut by row counts (:func:`tessera.operators.feeds.balanced_chunk`).
    """
    chunk = balanced_chunk(df, keys, ts, chunks=("1 day", *CHUNKS)) if chunk is None else chunk
    iv = _intervals(df, keys, seconds(chunk), ts, value, True)
    return (iv.groupBy(*[c(k) for k in keys])
              .agg(F.sum(F.col("__inner0") + F.col("__bstep0")).alias("increase"),
                   F.sum("__n").alias("samples")))


def _with_interval(df: DataFrame, ts: str, step_us: int) -> DataFrame:
    us = micros(c(ts), df.schema[ts].dataType)
    return df.withColumn("__us", us).withColumn("__k", F.expr(f"(__us - 1) div {step_us} + 1"))


def _intervals(df: DataFrame, keys: list[str], step_s: float, ts: str, value: str | list[str],
               counter: bool, chunk_s: float = DAY_S) -> DataFrame:
    """One row per (series, step interval): count, first/last sample, inner increase,
    plus the boundary step to the previous non-empty interval and running sums.

    ``value`` may be several columns, counters that share their samples (a histogram's buckets):
    they travel in one row; a number at the end of a column's name says whose it is.

    Running values are two-phase, so no task sorts a whole series: a window
    inside each (series, chunk of intervals), plus a per-chunk table (one row
    per series and chunk) that carries the neighbours across chunk edges and
    the exclusive totals of earlier chunks. Internal columns carry a ``__``
    prefix so they never meet a label name.
    """
    values = _list(value)
    of = range(len(values))
    step_us = int(round(step_s * 1_000_000))
    per_chunk = max(1, int(chunk_s // step_s))
    # the series is one non-null struct of its labels: a label may be null (a series
    # without it), and struct equality keeps such series in the chunk join below
    sk = F.struct(*[c(k) for k in keys]) if keys else F.lit(0)
    s = _with_interval(df.select(sk.alias("__sk"), c(ts), *[c(v).cast("double").alias(f"__v{i}") for i, v in enumerate(values)]),
                       ts, step_us)
    s = s.where(F.col("__us").isNotNull() & reduce(Column.__and__, [F.col(f"__v{i}").isNotNull() for i in of]))
    sample = ["__us", *[f"__v{i}" for i in of]]
    w_in = Window.partitionBy("__sk", "__k").orderBy(*sample)  # equal times by value
    s = s.withColumns({f"__step{i}": reset_step(F.col(f"__v{i}"), F.lag(f"__v{i}").over(w_in)) if counter
                       else F.lit(0.0) for i in of})
    iv = s.groupBy("__sk", "__k").agg(
        F.count(F.lit(1)).alias("__n"), F.min(F.struct(*sample)).alias("__first"), F.max(F.struct(*sample)).alias("__last"),
        *[F.coalesce(F.sum(f"__step{i}"), F.lit(0.0)).alias(f"__inner{i}") for i in of])
    iv = iv.select("__sk", "__k", "__n", F.col("__first.__us").alias("__first_us"), F.col("__last.__us").alias("__last_us"),
                   *[F.col(f"__first.__v{i}").alias(f"__first_v{i}") for i in of],
                   *[F.col(f"__last.__v{i}").alias(f"__last_v{i}") for i in of], *[f"__inner{i}" for i in of])
    # non-null chunk number: no null filter is inferred from the join, so both join
    # branches keep the same plan and share the sample shuffle
    iv = iv.withColumn("__c", F.coalesce(F.expr(f"__k div {per_chunk}"), F.lit(0).cast("long")))

    # phase 1: neighbours and running sums inside each (series, chunk)
    w_c = Window.partitionBy("__sk", "__c").orderBy("__k")
    run_c = w_c.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def edge(i, previous):
        return F.coalesce(reset_step(F.col(f"__first_v{i}"), previous), F.lit(0.0)) if counter else F.lit(0.0)

    iv = iv.withColumns({"__prev_in": F.lag("__k").over(w_c), "__next_in": F.lead("__k").over(w_c),
                         **{f"__b_in{i}": edge(i, F.lag(f"__last_v{i}").over(w_c)) for i in of}})
    iv = iv.withColumns({"__ncum_in": F.sum("__n").over(run_c),
                         **{f"__cum_in{i}": F.sum(F.col(f"__inner{i}") + F.col(f"__b_in{i}")).over(run_c) for i in of}})

    # phase 2: one row per (series, chunk); same partitioning as phase 1, no exchange
    ch = iv.groupBy("__sk", "__c").agg(
        F.min("__k").alias("__ck_first"), F.max("__k").alias("__ck_last"), F.sum("__n").alias("__cn"),
        *[F.min_by(f"__first_v{i}", "__k").alias(f"__first_v{i}") for i in of],
        *[F.max_by(f"__last_v{i}", "__k").alias(f"__last_v{i}") for i in of],
        *[F.sum(F.col(f"__inner{i}") + F.col(f"__b_in{i}")).alias(f"__csum{i}") for i in of])
    w_ch = Window.partitionBy("__sk").orderBy("__c")
    before = w_ch.rowsBetween(Window.unboundedPreceding, -1)
    ch = ch.withColumns({"__cprev_k": F.lag("__ck_last").over(w_ch), "__cnext_k": F.lead("__ck_first").over(w_ch),
                         **{f"__cb{i}": edge(i, F.lag(f"__last_v{i}").over(w_ch)) for i in of}})
    ch = ch.select("__sk", "__c", "__cprev_k", "__cnext_k", *[f"__cb{i}" for i in of],
                   *[F.coalesce(F.sum(F.col(f"__csum{i}") + F.col(f"__cb{i}")).over(before), F.lit(0.0)).alias(f"__coff{i}")
                     for i in of],
                   F.coalesce(F.sum("__cn").over(before), F.lit(0)).alias("__cnoff"))

    first_in_chunk = F.col("__prev_in").isNull()
    out = iv.join(ch, ["__sk", "__c"])
    kept = ["__first_v", "__last_v", "__inner"]
    return out.select(
        *[F.col("__sk").getField(k).alias(k) for k in keys],
        "__k", "__n", "__first_us", "__last_us", *[f"{x}{i}" for x in kept for i in of],
        F.coalesce("__prev_in", "__cprev_k").alias("__prev_k"),
        F.coalesce("__next_in", "__cnext_k").alias("__next_k"),
        *[F.when(first_in_chunk, F.col(f"__cb{i}")).otherwise(F.col(f"__b_in{i}")).alias(f"__bstep{i}") for i in of],
        *[(F.col(f"__coff{i}") + F.col(f"__cb{i}") + F.col(f"__cum_in{i}")).alias(f"__cum{i}") for i in of],
        (F.col("__cnoff") + F.col("__ncum_in")).alias("__ncum"))


def range_summary(df: DataFrame, keys: list[str], range: str | float, step: str | float,
                  ts: str = "ts", value: str | list[str] = "value", counter: bool = True,
                  chunk: str | float = DAY_S, closed: str = "right") -> DataFrame:
    """Per series and step end ``t``: the samples in ``(t - range, t]``
    (``closed="both"``: ``[t - range, t]``, the older rule).

    Columns: keys, ``t`` (timestamp_ntz), ``t_us``, ``n``, ``first_us``,
    ``first_v``, ``last_us``, ``last_v``, ``delta`` (reset-aware increase
    between first and last sample when ``counter``). One row for every step
    whose window holds at least one sample. ``chunk`` is the span of
    intervals one running-sum task sorts (results do not depend on it).
    Several values that share their samples give arrays ``first_v``, ``last_v``, ``delta``.
    """
    of = builtins.range(len(_list(value)))
    if closed not in ("right", "both"):
        raise ValueError(f"closed must be 'right' or 'both', not {closed!r}")
    range_s, step_s = seconds(range), seconds(step)
    n_steps = range_s / step_s
    if n_steps < 1 or abs(n_steps - round(n_steps)) > 1e-9:
        raise ValueError("range must be a positive whole multiple of step")
    n_steps = int(round(n_steps))
    step_us = int(round(step_s * 1_000_000))
    kcols = [c(k) for k in keys]
    iv = _intervals(df, keys, step_s, ts, value, counter, seconds(chunk))
    k = F.col("__k")

    # Each output step K is emitted once by its last non-empty interval (tag 1)
    # and once by its first (tag 0); one groupBy on (series, K) pairs them up.
    # With closed="both" an interval whose last sample sits exactly on its right
    # edge also emits that sample (tag 2) to the window starting at that edge.
    def tag(x, t):
        return F.struct(x.alias("K"), F.lit(t).alias("T"))
    hi = F.least(F.coalesce(F.col("__next_k") - 1, k + n_steps - 1), k + n_steps - 1)
    lo = F.greatest(k, F.coalesce(F.col("__prev_k") + n_steps, k))
    parts = [F.transform(F.sequence(k, hi), lambda x: tag(x, 1)),
             F.transform(F.sequence(lo, k + n_steps - 1), lambda x: tag(x, 0))]
    if closed == "both":
        on_edge = F.col("__last_us") == k * F.lit(step_us)
        parts.append(F.filter(F.array(tag(k + n_steps, 2)), lambda x: on_edge))
    each = [f"{x}{i}" for x in ("__first_v", "__last_v", "__inner", "__cum") for i in of]
    e = iv.select(*kcols, F.explode(F.concat(*parts)).alias("__e"), "__first_us", "__last_us", "__n", "__ncum", *each)
    kind = F.col("__e.K"), F.col("__e.T")

    def side(t, col, name=None):
        return F.max(F.when(kind[1] == t, F.col(col))).alias(name or f"{col}_{t}")

    aggs = [side(1, "__last_us"), side(1, "__ncum"), side(0, "__first_us"), side(0, "__n"), side(0, "__ncum")]
    aggs += [side(t, f"{x}{i}") for i in of for t, x in ((1, "__last_v"), (1, "__cum"), (0, "__first_v"), (0, "__inner"), (0, "__cum"))]
    if closed == "both":
        aggs += [side(2, "__last_us"), *[side(2, f"__last_v{i}") for i in of]]
    j = e.groupBy(*kcols, kind[0].alias("__K")).agg(*aggs)
    t_us = F.col("__K") * F.lit(step_us)
    n = F.col("__ncum_1") - F.col("__ncum_0") + F.col("__n_0")
    first_us, last_us = F.col("__first_us_0"), F.col("__last_us_1")
    firsts, lasts = [F.col(f"__first_v{i}_0") for i in of], [F.col(f"__last_v{i}_1") for i in of]
    deltas = [F.col(f"__cum{i}_1") - F.col(f"__cum{i}_0") + F.col(f"__inner{i}_0") for i in of]
    if closed == "both":
        edge = F.col("__last_us_2").isNotNull()
        inside = n.isNotNull()
        for i in of:
            at = F.col(f"__last_v{i}_2")
            edge_step = reset_step(firsts[i], at) if counter else F.lit(0.0)
            deltas[i] = F.when(edge & inside, deltas[i] + edge_step).when(edge, F.lit(0.0)).otherwise(deltas[i])
            firsts[i] = F.when(edge, at).otherwise(firsts[i])
            lasts[i] = F.when(inside, lasts[i]).otherwise(at)
        n = F.coalesce(n, F.lit(0)) + F.when(edge, 1).otherwise(0)
        first_us = F.when(edge, F.col("__last_us_2")).otherwise(first_us)
        last_us = F.coalesce(last_us, F.col("__last_us_2"))
    one = (lambda cols: cols[0]) if isinstance(value, str) else (lambda cols: F.array(*cols))
    return j.select(
        *kcols, ntz_from_micros(t_us).alias("t"), t_us.alias("t_us"), n.alias("n"),
        first_us.alias("first_us"), one(firsts).alias("first_v"), last_us.alias("last_us"),
        one(lasts).alias("last_v"), one(deltas).alias("delta"))


def _extrapolated(summary: DataFrame, range_s: float, counter: bool, as_rate: bool, of: int | None = None) -> Column:
    """Extend the observed increase to the window edges.

    An edge gap counts fully while under 1.1 x the mean sample spacing,
    else half a spacing; for counters the start never goes before the
    point where the counter would have been zero. ``of`` names one of several values.
    """
    of_value = (lambda name: F.col(name)) if of is None else (lambda name: F.col(name)[of])
    n = F.col("n").cast("double")
    t_end = F.col("t_us").cast("double")
    t_start = t_end - range_s * 1e6
    dur_start = (F.col("first_us") - t_start) / 1e6
    dur_end = (t_end - F.col("last_us")) / 1e6
    sampled = (F.col("last_us") - F.col("first_us")) / 1e6
    avg_gap = sampled / (n - 1)
    threshold = avg_gap * 1.1
    delta, first_v = of_value("delta"), of_value("first_v")
    ds = F.when(dur_start >= threshold, avg_gap / 2).otherwise(dur_start)
    if counter:
        to_zero = sampled * (first_v / delta)
        ds = F.when((delta > 0) & (first_v >= 0) & (to_zero < ds), to_zero).otherwise(ds)
    de = F.when(dur_end >= threshold, avg_gap / 2).otherwise(dur_end)
    factor = (sampled + ds + de) / sampled
    if as_rate:
        factor = factor / range_s
    return F.when(sampled > 0, delta * factor)


def increase(df: DataFrame, keys: list[str], range: str | float, step: str | float,
             ts: str = "ts", value: str | list[str] = "value", extrapolate: bool = True,
             as_rate: bool = False, closed: str = "right") -> DataFrame:
    """Counter increase over ``(t - range, t]`` (or ``[t - range, t]``) per series
    and step; needs 2 samples. Several values that share their samples keep their names."""
    range_s = seconds(range)
    s = range_summary(df, keys, range, step, ts, value, counter=True, closed=closed).where(F.col("n") >= 2)
    def out(of):
        if extrapolate:
            return _extrapolated(s, range_s, counter=True, as_rate=as_rate, of=of)
        delta = F.col("delta") if of is None else F.col("delta")[of]
        return delta / range_s if as_rate else delta

    named = [out(None).alias("value")] if isinstance(value, str) else [out(i).alias(v) for i, v in enumerate(value)]
    return s.select(*[c(k) for k in keys], "t", *named)


def rate(df: DataFrame, keys: list[str], range: str | float, step: str | float,
         ts: str = "ts", value: str | list[str] = "value", extrapolate: bool = True, closed: str = "right") -> DataFrame:
    """Per-second counter rate over ``(t - range, t]`` (or ``[t - range, t]``) per series and step."""
    return increase(df, keys, range, step, ts, value, extrapolate, as_rate=True, closed=closed)


def latest(df: DataFrame, keys: list[str], step: str | float, lookback: str | float = "5 minutes",
           ts: str = "ts", value: str = "value", closed: str = "right") -> DataFrame:
    """Gauge value at each step: the newest sample in ``(t - lookback, t]``
    (``closed="both"``: ``[t - lookback, t]``)."""
    s = range_summary(df, keys, lookback, step, ts, value, counter=False, closed=closed)
    return s.select(*[c(k) for k in keys], "t", F.col("last_v").alias("value"))


def sum_by(df: DataFrame, by: list[str], value: str = "value", time_col: str | None = "t") -> DataFrame:
    """Sum over series, keeping only ``by`` labels (and the step column)."""
    group = ([time_col] if time_col else []) + list(by)
    return df.groupBy(*[c(g) for g in group]).agg(F.sum(c(value)).alias(value))


def last_not_null(df: DataFrame, keys: list[str], ts: str = "t", value: str = "value") -> DataFrame:
    """Newest non-null value per series (a gauge panel's reduction)."""
    return (df.where(c(value).isNotNull() & ~F.isnan(c(value)))
              .groupBy(*[c(k) for k in keys])
              .agg(F.max(F.struct(c(ts).alias("t"), c(value).alias("v")))["v"].alias(value), F.max(c(ts)).alias(ts)))


def histogram_quantile(df: DataFrame, q: float, by: list[str], le: str = "le",
                       value: str = "value", time_col: str = "t") -> DataFrame:
    """Quantile ``q`` from cumulative bucket rates grouped by ``by`` and step.

    Buckets sort by their upper bound ``le`` (text; ``+Inf`` last). The rank
    ``q * total`` falls in the first bucket whose count reaches it and is
    interpolated linearly inside it; the lowest bucket starts at 0 (or at
    its bound when that is not positive); a rank in the ``+Inf`` bucket gives
    the highest finite bound; no ``+Inf`` bucket, fewer than two buckets or
    a zero total give NaN. Counts are made monotonic first.
    """
    bound = F.when(F.lower(c(le)).isin("+inf", "inf"), F.lit(float("inf"))).otherwise(c(le).cast("double"))
    group = [c(time_col)] + [c(b) for b in by]
    # bounds that are equal as numbers ("1", "1.0") are one bucket
    merged = df.withColumn("__ub", bound).groupBy(*group, "__ub").agg(F.sum(c(value).cast("double")).alias("__cnt"))
    g = merged.groupBy(*group).agg(F.array_sort(F.collect_list(
        F.struct(F.col("__ub").alias("ub"), F.col("__cnt").alias("cnt")))).alias("__b"))
    return _quantile(g, q, group, value)


def histogram_quantile_wide(df: DataFrame, q: float, by: list[str], counts: list[str], bounds: list[float],
                            value: str = "value", time_col: str = "t") -> DataFrame:
    """The same from one row per group and step with a column for each bucket, ascending ``bounds``."""
    group = [c(time_col)] + [c(b) for b in by]
    buckets = F.array(*[F.struct(F.lit(float(b)).alias("ub"), c(n).cast("double").alias("cnt")) for b, n in zip(bounds, counts)])
    return _quantile(df.select(*group, buckets.alias("__b")), q, group, value)


def _quantile(g: DataFrame, q: float, group: list[Column], value: str) -> DataFrame:
    """Quantile of the sorted buckets ``__b`` of each row."""
    mono = F.expr("transform(__b, (x, i) -> named_struct('ub', x.ub, 'cnt', "
                  "array_max(transform(slice(__b, 1, i + 1), y -> y.cnt))))")
    g = g.withColumn("__b", mono)
    nb = F.size("__b")
    last = F.element_at("__b", -1)
    total = last["cnt"]
    rank = F.lit(float(q)) * total
    idx = F.array_position(F.transform("__b", lambda x: x["cnt"] >= rank), True)  # 1-based
    cur = F.element_at("__b", idx.cast("int"))
    prev = F.element_at("__b", F.greatest(idx - 1, F.lit(1)).cast("int"))
    start = F.when(idx > 1, prev["ub"]).otherwise(F.lit(0.0))
    below = F.when(idx > 1, prev["cnt"]).otherwise(F.lit(0.0))
    nan = F.lit(float("nan"))
    # an empty first bucket holds rank 0: nothing to interpolate in
    inside = start + (cur["ub"] - start) * F.coalesce(F.try_divide(rank - below, cur["cnt"] - below), nan)
    result = (F.when(F.lit(q) < 0, F.lit(float("-inf")))
               .when(F.lit(q) > 1, F.lit(float("inf")))
               .when((nb < 2) | (last["ub"] != float("inf")) | total.isNull() | (total == 0), nan)
               .when(idx == nb, F.element_at("__b", -2)["ub"])
               .when((idx == 1) & (cur["ub"] <= 0), cur["ub"])
               .otherwise(inside))
    return g.select(*group, result.alias(value))


def threshold_band(col: Column, steps: list[tuple[float | None, str]]) -> Column:
    """Colour of a value from ``[(None, base), (from_value, colour), ...]`` ascending;
    the highest step the value reaches wins."""
    out = F.lit(None).cast("string")
    for start, colour in steps:
        out = F.lit(colour) if start is None else F.when(col >= F.lit(start), F.lit(colour)).otherwise(out)
    return out
