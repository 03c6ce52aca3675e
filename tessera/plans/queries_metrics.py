"""Queries for metric feeds, label matching, rates, increases and dashboard panels.

The driver's events are sparse (one request per series every ~20 minutes
at sf0.01), so the registered panels use hour-scale windows, where most windows hold
samples; the ``_1m`` and ``_5m`` ones run at the dashboard's own windows and step. Oracles are
brute force: each step joined to every sample of its window.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.labels import time_range
from tessera.operators.feeds import class_counter
from tessera.operators.timeseries import _extrapolated, counter_delta, increase, range_summary, rate
from tessera.plans import dashboard as dash
from tessera.plans.catalog import REQUEST_LOG_SQL, register, rounded
from tessera.plans.derived import (LATENCY_BOUNDS, cpu_counter, latency_buckets, latency_histogram, memory_gauge,
                                   scraped_request_counter,
                                   prediction_class_counter, request_counter)
from tessera.sources.tables import table

# Fixed window parameters of the registered panel queries (seconds).
RANGE_S, STEP_S = 3600, 900          # rate panels: 1 hour window, 15 minute step
LONG_RANGE_S, LONG_STEP_S = 86400, 15     # increase panels: 24 hour window, 15 second step
DIGITS = 9

_DAY = "date_trunc('day', ts)"

REQUEST_COUNTER_SQL = (
    f"select path, status, ts, cast(count(*) over (partition by path, status, {_DAY} order by ts "
    f"rows between unbounded preceding and current row) as double) as value from ({REQUEST_LOG_SQL})")


def _bounds_values():
    rows = [f"('{b!r}', {b!r})" for b in LATENCY_BOUNDS] + ["('+Inf', 'inf'::double)"]
    return "(values " + ", ".join(rows) + ") b(le, ub)"


LATENCY_BUCKETS_SQL = (
    f"select path, le, ts, sum(hit) over (partition by path, le, {_DAY} order by ts "
    f"rows between unbounded preceding and current row) as value from ("
    f"select r.path, r.ts, b.le, case when r.duration <= b.ub then 1.0 else 0.0 end as hit "
    f"from ({REQUEST_LOG_SQL}) r, {_bounds_values()})")

CPU_COUNTER_SQL = (
    f"select pod, ts, sum(duration) over (partition by pod, {_DAY} order by ts "
    f"rows between unbounded preceding and current row) as value from ({REQUEST_LOG_SQL})")

MEMORY_GAUGE_SQL = f"select pod, ts, value * 1e6 as value from ({REQUEST_LOG_SQL})"

CLASS_COUNTER_SQL = (
    f"select prediction_class, ts, cast(count(*) over (partition by prediction_class, {_DAY} "
    f"order by ts rows between unbounded preceding and current row) as double) as value from ("
    f"select *, case when value >= 50 then '1' else '0' end as prediction_class from ({REQUEST_LOG_SQL}))")


def summary_sql(src: str, keys: list[str], range_s: int, step_s: int, counter: bool = True,
                prefix: str = "", closed: str = "right") -> str:
    """CTEs ending in ``{prefix}summ(keys, K, t_us, n, first_us, first_v, last_us, last_v, delta)``."""
    S, R = step_s * 1_000_000, range_s * 1_000_000
    N = R // S
    left = ">=" if closed == "both" else ">"
    spread = N + 1 if closed == "both" else N
    k = ", ".join(keys)
    gk = ", ".join(f"g.{x}" for x in keys)
    on = " and ".join(f"g.{x} = s.{x}" for x in keys)
    st = "case when pv is null then null when v >= pv then v - pv else v end" if counter else "0.0"
    p = prefix
    return f"""{p}s0 as (select {k}, epoch_us(ts) as us, cast(value as double) as v from ({src})),
{p}s1 as (select *, lag(v) over (partition by {k} order by us) as pv from {p}s0),
{p}s as (select *, {st} as st from {p}s1),
{p}g as (select distinct {k}, (us - 1) // {S} + 1 + j as K from {p}s, range(0, {spread}) r(j)),
{p}m as (select {gk}, g.K, s.us, s.v, s.st,
          row_number() over (partition by {gk}, g.K order by s.us) as rn
        from {p}g g join {p}s s on {on} and s.us {left} g.K * {S} - {R} and s.us <= g.K * {S}),
{p}summ as (select {k}, K, K * {S} as t_us, count(*) as n, min(us) as first_us,
          max(case when rn = 1 then v end) as first_v, max(us) as last_us, arg_max(v, us) as last_v,
          coalesce(sum(case when rn > 1 then st end), 0.0) as delta
        from {p}m group by {k}, K)"""


def extrapolated_sql(range_s: int, as_rate: bool, counter: bool = True) -> str:
    """Expression over one summary row; mirrors the Spark column expression."""
    sampled = "((last_us - first_us) / 1e6)"
    avg_gap = f"({sampled} / (cast(n as double) - 1))"
    thr = f"({avg_gap} * 1.1)"
    t_start = f"(cast(t_us as double) - {range_s} * 1e6)"
    dur_start = f"((first_us - {t_start}) / 1e6)"
    dur_end = f"((cast(t_us as double) - last_us) / 1e6)"
    ds = f"(case when {dur_start} >= {thr} then {avg_gap} / 2 else {dur_start} end)"
    if counter:
        to_zero = f"({sampled} * (first_v / delta))"
        ds = f"(case when delta > 0 and first_v >= 0 and {to_zero} < {ds} then {to_zero} else {ds} end)"
    de = f"(case when {dur_end} >= {thr} then {avg_gap} / 2 else {dur_end} end)"
    factor = f"(({sampled} + {ds} + {de}) / {sampled})"
    if as_rate:
        factor = f"({factor} / {range_s})"
    return f"(case when {sampled} > 0 then delta * {factor} end)"


def _t():
    return "make_timestamp(t_us) as t"


def _r(expr: str) -> str:
    return f"round({expr}, {DIGITS})"


# ---- feeds -----------------------------------------------------------------

@register("request_counters", REQUEST_COUNTER_SQL)
def q_request_counters(spark, sf_dir):
    return request_counter(spark, sf_dir)


@register("latency_buckets", LATENCY_BUCKETS_SQL)
def q_latency_buckets(spark, sf_dir):
    return latency_buckets(spark, sf_dir)


@register("cpu_counter", f"select pod, ts, {_r('value')} as value from ({CPU_COUNTER_SQL})")
def q_cpu_counter(spark, sf_dir):
    return rounded(cpu_counter(spark, sf_dir), DIGITS)


@register("class_counter", "select label as prediction_class, count(*) as n from embeddings group by label")
def q_class_counter(spark, sf_dir):
    return class_counter(table(spark, sf_dir, "embeddings"), "label")


# ---- label matching ----------------------------------------------------------

@register("label_match", (
    f"select path, status, count(*) as n from ({REQUEST_COUNTER_SQL}) "
    f"where status = '200' and regexp_full_match(path, '/predict/(click|view)') group by path, status"))
def q_label_match(spark, sf_dir):
    sel = request_counter(spark, sf_dir, ("status", "=", "200"), ("path", "=~", "/predict/(click|view)"))
    return sel.groupBy("path", "status").agg(F.count(F.lit(1)).alias("n"))


@register("label_not_match", (
    f"select status, count(*) as n from ({REQUEST_COUNTER_SQL}) "
    f"where status <> '200' and not regexp_full_match(path, 'predict.*') group by status"))
def q_label_not_match(spark, sf_dir):
    sel = request_counter(spark, sf_dir, ("status", "!=", "200"), ("path", "!~", "predict.*"))
    return sel.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("time_range_filter", (
    f"select path, count(*) as n, max(value) as max_value from ({REQUEST_COUNTER_SQL}) "
    f"where ts > timestamp '2024-01-15 00:00:00' - interval 1 hour and ts <= timestamp '2024-01-15 00:00:00' "
    f"group by path"))
def q_time_range_filter(spark, sf_dir):
    from datetime import datetime, timedelta

    end = datetime(2024, 1, 15)
    start = end - timedelta(hours=1)
    sel = time_range(request_counter(spark, sf_dir, since=start, until=end), start, end)
    return sel.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("max_value"))


# ---- range functions ---------------------------------------------------------

@register("counter_increase_total", (
    f"select path, status, coalesce(sum(st), 0.0) as increase, count(*) as samples from ("
    f"select *, case when pv is null then null when value >= pv then value - pv else value end as st "
    f"from (select *, lag(value) over (partition by path, status order by ts) as pv "
    f"from ({REQUEST_COUNTER_SQL}))) group by path, status"))
def q_counter_increase_total(spark, sf_dir):
    d = counter_delta(request_counter(spark, sf_dir), ["path", "status"])
    return d.select("path", "status", "increase", "samples")


@register("rate_1h", (
    f"with {summary_sql(REQUEST_COUNTER_SQL, ['path', 'status'], RANGE_S, STEP_S)} "
    f"select path, status, {_t()}, {_r(extrapolated_sql(RANGE_S, True))} as value from summ where n >= 2"))
def q_rate_1h(spark, sf_dir):
    return rounded(rate(request_counter(spark, sf_dir), ["path", "status"], RANGE_S, STEP_S), DIGITS)


def _panel_rate(name, range_s):
    """Rates at the dashboard's own windows, every 15 seconds; most windows hold fewer than two events."""
    @register(name, (
        f"with {summary_sql(REQUEST_COUNTER_SQL, ['path', 'status'], range_s, 15)} "
        f"select path, status, {_t()}, {_r(extrapolated_sql(range_s, True))} as value from summ where n >= 2"))
    def q_panel_rate(spark, sf_dir):
        return rounded(rate(request_counter(spark, sf_dir), ["path", "status"], range_s, 15), DIGITS)


_panel_rate("rate_1m", 60)
_panel_rate("rate_5m", 300)


SCRAPED_COUNTER_SQL = (
    f"select path, status, make_timestamp(((epoch_us(ts) - 1) // 60000000 + 1) * 60000000) as ts, "
    f"arg_max(value, ts) as value from ({REQUEST_COUNTER_SQL}) group by all")


@register("scraped_counter", f"select path, status, ts, value from ({SCRAPED_COUNTER_SQL})")
def q_scraped_counter(spark, sf_dir):
    return scraped_request_counter(spark, sf_dir)


@register("rate_1h_closed_both", (
    f"with {summary_sql(SCRAPED_COUNTER_SQL, ['path', 'status'], RANGE_S, STEP_S, closed='both')} "
    f"select path, status, {_t()}, n, {_r(extrapolated_sql(RANGE_S, True))} as value from summ where n >= 2"))
def q_rate_1h_closed_both(spark, sf_dir):
    """The older window rule ``[t - 1h, t]`` on minute-scraped samples, many of them on an edge."""
    s = range_summary(scraped_request_counter(spark, sf_dir), ["path", "status"], RANGE_S, STEP_S,
                      closed="both").where(F.col("n") >= 2)
    return rounded(s.select("path", "status", "t", "n",
                            _extrapolated(s, RANGE_S, counter=True, as_rate=True).alias("value")), DIGITS)


@register("increase_24h_raw", (
    f"with {summary_sql(CLASS_COUNTER_SQL, ['prediction_class'], LONG_RANGE_S, LONG_STEP_S)} "
    f"select prediction_class, {_t()}, {_r('delta')} as value from summ where n >= 2"))
def q_increase_24h_raw(spark, sf_dir):
    inc = increase(prediction_class_counter(spark, sf_dir), ["prediction_class"], LONG_RANGE_S,
                   LONG_STEP_S, extrapolate=False)
    return rounded(inc, DIGITS)


@register("increase_24h", (
    f"with {summary_sql(CLASS_COUNTER_SQL, ['prediction_class'], LONG_RANGE_S, LONG_STEP_S)} "
    f"select prediction_class, {_t()}, {_r(extrapolated_sql(LONG_RANGE_S, False))} as value "
    f"from summ where n >= 2"))
def q_increase_24h(spark, sf_dir):
    inc = increase(prediction_class_counter(spark, sf_dir), ["prediction_class"], LONG_RANGE_S, LONG_STEP_S)
    return rounded(inc, DIGITS)


# ---- dashboard panels -------------------------------------------------------

@register("panel_request_rate", (
    f"with {summary_sql(REQUEST_COUNTER_SQL, ['path', 'status'], RANGE_S, STEP_S)} "
    f"select path, status, {_t()}, {_r(extrapolated_sql(RANGE_S, True))} as value, path as series "
    f"from summ where n >= 2 and status = '200'"))
def q_panel_request_rate(spark, sf_dir):
    return rounded(dash.request_rate(request_counter(spark, sf_dir, dash.OK), RANGE_S, STEP_S), DIGITS)


@register("panel_error_rate", (
    f"with {summary_sql(REQUEST_COUNTER_SQL, ['path', 'status'], RANGE_S, STEP_S)} "
    f"select path, status, {_t()}, {_r(extrapolated_sql(RANGE_S, True))} as value, "
    f"status || ' - ' || path as series from summ where n >= 2 and status <> '200'"))
def q_panel_error_rate(spark, sf_dir):
    return rounded(dash.error_rate(request_counter(spark, sf_dir, dash.FAILED), RANGE_S, STEP_S), DIGITS)


def _quantile_sql(q: float, legend: str, range_s: int = RANGE_S, step_s: int = STEP_S) -> str:
    rates = (f"select path, le, t_us, {extrapolated_sql(range_s, True)} as cnt from summ where n >= 2")
    return f"""with {summary_sql(LATENCY_BUCKETS_SQL, ['path', 'le'], range_s, step_s)},
hb as (select path, t_us, case when le = '+Inf' then 'inf'::double else cast(le as double) end as ub,
              sum(cnt) as cnt from ({rates}) group by path, t_us, le),
hm as (select *, max(cnt) over (partition by path, t_us order by ub rows between unbounded preceding
              and current row) as mc,
              row_number() over (partition by path, t_us order by ub) as i,
              count(*) over (partition by path, t_us) as nb from hb),
tot as (select path, t_us, max(nb) as nb, arg_max(mc, ub) as total, max(ub) as top from hm group by path, t_us),
hit as (select hm.path, hm.t_us, min(i) as idx from hm join tot using (path, t_us)
        where hm.mc >= {q} * tot.total group by hm.path, hm.t_us),
res as (select tot.path, tot.t_us,
          case when tot.nb < 2 or tot.top <> 'inf'::double or tot.total = 0 then 'nan'::double
               when hit.idx = tot.nb then lo2.ub
               when hit.idx = 1 and cur.ub <= 0 then cur.ub
               else coalesce(prv.ub, 0.0) + (cur.ub - coalesce(prv.ub, 0.0))
                    * (({q} * tot.total - coalesce(prv.mc, 0.0)) / (cur.mc - coalesce(prv.mc, 0.0)))
          end as value
        from tot left join hit using (path, t_us)
        left join hm cur on cur.path = tot.path and cur.t_us = tot.t_us and cur.i = hit.idx
        left join hm prv on prv.path = tot.path and prv.t_us = tot.t_us and prv.i = hit.idx - 1
        left join hm lo2 on lo2.path = tot.path and lo2.t_us = tot.t_us and lo2.i = tot.nb - 1)
select make_timestamp(t_us) as t, path, {_r('value')} as value, '{legend}' || path as series from res"""


@register("panel_latency_p95", _quantile_sql(0.95, "p95 - "))
def q_panel_latency_p95(spark, sf_dir):
    return rounded(dash.latency_quantile_wide(latency_histogram(spark, sf_dir), LATENCY_BOUNDS, dash.P95, RANGE_S, STEP_S,
                                              "p95 - {{path}}"), DIGITS)


@register("panel_latency_p50", _quantile_sql(0.5, "median - "))
def q_panel_latency_p50(spark, sf_dir):
    return rounded(dash.latency_quantile_wide(latency_histogram(spark, sf_dir), LATENCY_BOUNDS, dash.P50, RANGE_S, STEP_S,
                                              "median - {{path}}"), DIGITS)


_PRED_RATE_SQL = (
    f"with {summary_sql(REQUEST_COUNTER_SQL, ['path', 'status'], RANGE_S, STEP_S)}, "
    f"pr as (select t_us, sum({extrapolated_sql(RANGE_S, True)}) as value from summ "
    f"where n >= 2 and status = '200' and regexp_full_match(path, '/predict.*') group by t_us) ")


@register("panel_prediction_rate", _PRED_RATE_SQL + f"select {_t()}, {_r('value')} as value from pr")
def q_panel_prediction_rate(spark, sf_dir):
    return rounded(dash.prediction_rate(request_counter(spark, sf_dir, dash.OK, dash.PREDICT), RANGE_S, STEP_S), DIGITS)


@register("panel_prediction_gauge", _PRED_RATE_SQL + (
    f"select {_r('arg_max(value, t_us)')} as value, make_timestamp(max(t_us)) as t, "
    f"case when arg_max(value, t_us) >= 80 then 'red' else 'green' end as colour "
    f"from pr where value is not null and not isnan(value)"))
def q_panel_prediction_gauge(spark, sf_dir):
    return rounded(dash.prediction_rate_gauge(request_counter(spark, sf_dir, dash.OK, dash.PREDICT), RANGE_S, STEP_S), DIGITS)


@register("panel_pod_cpu", (
    f"with {summary_sql(CPU_COUNTER_SQL, ['pod'], RANGE_S, STEP_S)} "
    f"select {_t()}, pod, {_r(f'sum({extrapolated_sql(RANGE_S, True)}) * 100')} as value, pod as series "
    f"from summ where n >= 2 and regexp_full_match(pod, 'ml-api.*') group by t_us, pod"))
def q_panel_pod_cpu(spark, sf_dir):
    return rounded(dash.pod_cpu(cpu_counter(spark, sf_dir, dash.ML_PODS), RANGE_S, STEP_S), DIGITS)


@register("panel_pod_memory", (
    f"with {summary_sql(MEMORY_GAUGE_SQL, ['pod'], RANGE_S, STEP_S, counter=False)} "
    f"select {_t()}, pod, round(sum(last_v), 6) as value, pod as series "
    f"from summ where regexp_full_match(pod, 'ml-api.*') group by t_us, pod"))
def q_panel_pod_memory(spark, sf_dir):
    return rounded(dash.pod_memory(memory_gauge(spark, sf_dir), STEP_S, RANGE_S), 6)


# ---- the panels at the dashboard's own windows, every 15 seconds ---------------

OWN_RANGE_S, OWN_LONG_S, OWN_STEP_S = 60, 300, 15


def _own(src: str, keys: list[str], range_s: int, counter: bool = True) -> str:
    return summary_sql(src, keys, range_s, OWN_STEP_S, counter)


_OWN_RATE = _r(extrapolated_sql(OWN_RANGE_S, True))


@register("panel_request_rate_1m", (
    f"with {_own(REQUEST_COUNTER_SQL, ['path', 'status'], OWN_RANGE_S)} "
    f"select path, status, {_t()}, {_OWN_RATE} as value, path as series from summ where n >= 2 and status = '200'"))
def q_panel_request_rate_1m(spark, sf_dir):
    return rounded(dash.request_rate(request_counter(spark, sf_dir, dash.OK)), DIGITS)


@register("panel_error_rate_1m", (
    f"with {_own(REQUEST_COUNTER_SQL, ['path', 'status'], OWN_RANGE_S)} "
    f"select path, status, {_t()}, {_OWN_RATE} as value, status || ' - ' || path as series "
    f"from summ where n >= 2 and status <> '200'"))
def q_panel_error_rate_1m(spark, sf_dir):
    return rounded(dash.error_rate(request_counter(spark, sf_dir, dash.FAILED)), DIGITS)


def _own_quantile(name: str, q: float, legend: str):
    @register(name, _quantile_sql(q, legend, OWN_RANGE_S, OWN_STEP_S))
    def q_own_quantile(spark, sf_dir):
        return rounded(dash.latency_quantile_wide(latency_histogram(spark, sf_dir), LATENCY_BOUNDS, q,
                                                  legend=legend + "{{path}}"), DIGITS)


_own_quantile("panel_latency_p95_1m", dash.P95, "p95 - ")
_own_quantile("panel_latency_p50_1m", dash.P50, "median - ")


@register("panel_prediction_rate_5m", (
    f"with {_own(REQUEST_COUNTER_SQL, ['path', 'status'], OWN_LONG_S)} "
    f"select {_t()}, {_r(f'sum({extrapolated_sql(OWN_LONG_S, True)})')} as value from summ "
    f"where n >= 2 and status = '200' and regexp_full_match(path, '/predict.*') group by t_us"))
def q_panel_prediction_rate_5m(spark, sf_dir):
    return rounded(dash.prediction_rate(request_counter(spark, sf_dir, dash.OK, dash.PREDICT)), DIGITS)


@register("panel_pod_cpu_1m", (
    f"with {_own(CPU_COUNTER_SQL, ['pod'], OWN_RANGE_S)} "
    f"select {_t()}, pod, {_r(f'sum({extrapolated_sql(OWN_RANGE_S, True)}) * 100')} as value, pod as series "
    f"from summ where n >= 2 and regexp_full_match(pod, 'ml-api.*') group by t_us, pod"))
def q_panel_pod_cpu_1m(spark, sf_dir):
    return rounded(dash.pod_cpu(cpu_counter(spark, sf_dir, dash.ML_PODS)), DIGITS)


@register("panel_pod_memory_5m", (
    f"with {_own(MEMORY_GAUGE_SQL, ['pod'], OWN_LONG_S, counter=False)} "
    f"select {_t()}, pod, round(sum(last_v), 6) as value, pod as series "
    f"from summ where regexp_full_match(pod, 'ml-api.*') group by t_us, pod"))
def q_panel_pod_memory_5m(spark, sf_dir):
    return rounded(dash.pod_memory(memory_gauge(spark, sf_dir)), 6)


_CLASS_INC_SQL = (
    f"with {summary_sql(CLASS_COUNTER_SQL, ['prediction_class'], LONG_RANGE_S, LONG_STEP_S)}, "
    f"ci as (select t_us, prediction_class, sum({extrapolated_sql(LONG_RANGE_S, False)}) as value "
    f"from summ where n >= 2 group by t_us, prediction_class) ")


@register("panel_class_increase", _CLASS_INC_SQL + f"select {_t()}, prediction_class, {_r('value')} as value from ci")
def q_panel_class_increase(spark, sf_dir):
    return rounded(dash.class_increase(prediction_class_counter(spark, sf_dir), LONG_RANGE_S, LONG_STEP_S),
                   DIGITS)


@register("panel_class_distribution", _CLASS_INC_SQL + (
    "select prediction_class, round(sum(value), 6) as total, 'Class ' || prediction_class as series "
    "from ci group by prediction_class"))
def q_panel_class_distribution(spark, sf_dir):
    return rounded(dash.class_distribution(prediction_class_counter(spark, sf_dir), LONG_RANGE_S,
                                           LONG_STEP_S), 6)
