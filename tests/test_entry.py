import math

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans.catalog import QUERIES, SQL
from tessera.sources.tables import TABLES

SMALL = "/root/testdata/sf0.001"
HEAVY = {"gbt_cv_eval", "gbt_leaf_leaderboard", "text_model_eval"}  # fitted figures: no SQL form


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns


def test_every_query_has_an_oracle_or_is_known_non_sql():
    missing = set(QUERIES) - set(SQL)
    assert missing <= HEAVY


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(SQL) - HEAVY))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SMALL)
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    srows = sorted((tuple(_norm(r[c]) for c in sorted(sdf.columns)) for r in sdf.collect()), key=repr)
    idx = [dcols.index(c) for c in sorted(dcols)]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert srows == drows
