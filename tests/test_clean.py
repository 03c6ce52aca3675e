import math
from decimal import Decimal

import pytest

from tessera.operators.clean import UnfillableColumnError, fill_missing, null_counts, profile


def test_null_counts_ignore_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r["column_name"]: r["null_count"] for r in null_counts(df).collect()}
    assert got == {"x": 1, "s": 1}


def test_null_counts_zero_columns(spark):
    assert null_counts(spark.range(3).select()).count() == 0


def test_fill_keeps_types_and_nan(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None, None, True), (1, 2.5, Decimal("1.25"), float("nan"), "", 3, None)],
        "t tinyint, f float, d decimal(10,2), x double, s string, `a.b` int, flag boolean")
    out = fill_missing(df)
    assert dict(out.dtypes) == dict(df.dtypes)
    rows = out.collect()
    assert rows[0]["t"] == 0 and rows[0]["f"] == 0.0 and rows[0]["d"] == Decimal("0.00")
    assert rows[0]["s"] == "unknown" and rows[1]["s"] == ""
    assert math.isnan(rows[1]["x"]) and rows[0]["x"] == 0.0
    assert rows[0]["a.b"] == 0
    assert rows[1]["flag"] is None  # non-fillable type passes through
    with pytest.raises(UnfillableColumnError):
        fill_missing(df, strict=True)


def test_profile_skips_timestamps_and_types_stats(spark):
    df = spark.createDataFrame([(1, "10", None), (3, "abc", None)], "n int, s string, ts timestamp")
    rows = {r["column_name"]: r for r in profile(df).collect()}
    assert set(rows) == {"n", "s"}
    assert rows["n"]["mean"] == 2.0 and rows["n"]["min_num"] == 1.0 and rows["n"]["max_num"] == 3.0
    assert rows["s"]["mean"] == 10.0 and rows["s"]["min_str"] == "10" and rows["s"]["max_str"] == "abc"


def test_etl_run_end_to_end(spark, tmp_path):
    from tessera.plans.etl import run_pipeline

    src = tmp_path / "raw"
    spark.createDataFrame([(1, "a", 2.0), (2, None, None)], "id int, s string, x double") \
         .write.option("header", True).csv(str(src))
    filled, stats = run_pipeline(spark, str(src), str(tmp_path / "out"), "csv", "parquet")
    back = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert back[1]["s"] == "unknown" and back[1]["x"] == 0.0
    assert {r["column_name"]: r["null_count"] for r in stats} == {"id": 0, "s": 1, "x": 1}
    assert filled.count() == 2


def test_profile_observed_by_the_write_equals_its_own_scan(spark, tmp_path):
    from tessera.operators.clean import observed_profile, profile_with_nulls
    df = spark.createDataFrame([(i, float(i) if i % 3 else None, str(i % 4) if i % 5 else None, i % 2 == 0, f"w{i}") for i in range(90)],
                               "a int, `x.y` double, s string, b boolean, w string").repartition(4)
    for k, part in enumerate((df, df.limit(0), df.where("a = 1"))):
        seen, rows = observed_profile(part)
        seen.write.parquet(str(tmp_path / str(k)))
        near = lambda r: tuple(round(v, 9) if isinstance(v, float) else v for v in r)
        assert [near(r) for r in rows()] == [near(r) for r in sorted(profile_with_nulls(part).collect(), key=lambda r: df.columns.index(r.column_name))]


def test_etl_run_parses_its_source_once(spark, tmp_path):
    from tessera.plans.etl import run_pipeline
    spark.range(50).selectExpr("id", "cast(id as string) as s").write.option("header", True).csv(str(tmp_path / "in"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema="id long, s string")
    jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)
    assert len(jobs) == 1
