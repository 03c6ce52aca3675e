"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (or views derived from them with
expressions) in full. ``SQL`` holds the DuckDB oracle for each query that
has one; column names match the Spark output exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column so both engines print the same value."""
    out = []
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("double", "float"):
            out.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


# Fixed column lists of the driver tables used in generated oracle SQL.
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"]
LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_STRING = ["l_returnflag", "l_linestatus"]

LINEITEM_NULLS_SQL = ("select * replace (nullif(l_discount, 0.05) as l_discount, "
                      "nullif(l_returnflag, 'N') as l_returnflag) from lineitem")
LINEITEM_NAN_SQL = (f"select * replace (case when l_tax = 0.02 then cast('NaN' as double) "
                    f"else l_tax end as l_tax) from ({LINEITEM_NULLS_SQL})")
REQUEST_LOG_SQL = ("select event_id, ts, user_id, '/predict/' || event_type as path, "
                   "case when event_type = 'error' then '500' else '200' end as status, "
                   "value / 100 as duration, 'ml-api-' || cast(user_id % 3 as varchar) as pod, value "
                   "from events")


def _union(parts):
    return "\nunion all\n".join(parts)


from tessera.plans import queries_clean  # noqa: E402,F401
from tessera.plans import queries_quality  # noqa: E402,F401
from tessera.plans import queries_metrics  # noqa: E402,F401
from tessera.plans import queries_split  # noqa: E402,F401
from tessera.plans import queries_text  # noqa: E402,F401
from tessera.plans import queries_models  # noqa: E402,F401
from tessera.plans import queries_stream  # noqa: E402,F401
from tessera.plans import queries_store  # noqa: E402,F401
from tessera.plans import queries_io  # noqa: E402,F401
