"""Queries for scans, null profiling and filling."""

from __future__ import annotations

from tessera.operators.clean import fill_missing, null_counts, profile
from tessera.plans.catalog import (LINEITEM_COLS, LINEITEM_NULLS_SQL, LINEITEM_NUMERIC,
                                   LINEITEM_STRING, _union, register, rounded)
from tessera.plans.derived import lineitem_with_nulls

_NULL_COUNTS_SQL = f"with t as ({LINEITEM_NULLS_SQL})\n" + _union(
    [f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count from t"
     for c in LINEITEM_COLS])


@register("null_counts", _NULL_COUNTS_SQL)
def q_null_counts(spark, sf_dir):
    return null_counts(lineitem_with_nulls(spark, sf_dir))


def _profile_sql():
    parts = []
    for c in LINEITEM_NUMERIC:
        x = f"cast({c} as double)"
        parts.append(
            f"select '{c}' as column_name, count({c}) as n, round(avg({x}), 6) as mean, "
            f"round(stddev_samp({x}), 6) as stddev, round(min({x}), 6) as min_num, "
            f"round(max({x}), 6) as max_num, cast(null as varchar) as min_str, "
            f"cast(null as varchar) as max_str from t")
    for c in LINEITEM_STRING:
        x = f"try_cast({c} as double)"
        parts.append(
            f"select '{c}' as column_name, count({c}) as n, round(avg({x}), 6) as mean, "
            f"round(stddev_samp({x}), 6) as stddev, cast(null as double) as min_num, "
            f"cast(null as double) as max_num, min({c}) as min_str, max({c}) as max_str from t")
    return f"with t as ({LINEITEM_NULLS_SQL})\n" + _union(parts)


@register("profile", _profile_sql())
def q_profile(spark, sf_dir):
    return rounded(profile(lineitem_with_nulls(spark, sf_dir)))


_FILL_SQL = (f"select * replace (coalesce(l_discount, 0) as l_discount, "
             f"coalesce(l_returnflag, 'unknown') as l_returnflag) from ({LINEITEM_NULLS_SQL})")


@register("fill_missing", _FILL_SQL)
def q_fill_missing(spark, sf_dir):
    return fill_missing(lineitem_with_nulls(spark, sf_dir))
