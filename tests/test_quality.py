import math

from tessera.operators.quality import check_missing, check_ranges, check_types, run_all_checks, verdict


def test_missing_threshold_inclusive_and_empty(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,), (5,), (6,), (7,), (8,), (9,)], "x int")
    r = check_missing(df, 0.1).collect()[0]
    assert r["missing_fraction"] == 0.1 and r["passed"] is True
    empty = spark.createDataFrame([], "x int")
    r = check_missing(empty).collect()[0]
    assert r["missing_fraction"] is None and r["passed"] is False


def test_missing_nan_counts_only_when_asked(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert check_missing(df, 0.4).collect()[0]["passed"] is True
    assert check_missing(df, 0.4, nan_as_missing=True).collect()[0]["passed"] is False


def test_type_check_is_substring(spark):
    df = spark.createDataFrame([(1, [1], 2)], "a bigint, b array<int>, c int")
    res = {r["column_name"]: r for r in check_types(df, {"a": "int", "b": "int", "c": "Int", "zz": "int"}).collect()}
    assert res["a"]["passed"] and res["b"]["passed"] and not res["c"]["passed"]
    assert res["zz"]["passed"] is None and "not found" in res["zz"]["error"]
    assert check_types(df, {"c": "Int"}, ignore_case=True).collect()[0]["passed"] is True


def test_ranges_nan_text_and_missing(spark):
    df = spark.createDataFrame([(1.0, "10", "abc"), (float("nan"), "9", "1")], "x double, s string, t string")
    res = {r["column_name"]: r for r in check_ranges(df, {"x": (0, 5), "s": (9, 10), "t": (0, 5),
                                                             "m": (0, 1)}).collect()}
    assert res["x"]["passed"] is False and math.isnan(res["x"]["actual_max"])
    assert res["s"]["actual_min"] == 9.0 and res["s"]["actual_max"] == 10.0 and res["s"]["passed"]
    assert res["t"]["passed"] is False and "non-numeric" in res["t"]["error"]
    assert res["m"]["passed"] is None
    nan_ok = check_ranges(df, {"x": (0, 5)}, nan_as_missing=True).collect()[0]
    assert nan_ok["passed"] is True and nan_ok["actual_max"] == 1.0


def test_verdict_ignores_missing_columns_by_default(spark):
    df = spark.createDataFrame([(1,)], "x int")
    res = run_all_checks(df, {"nope": "int"}, {"x": (0, 2)})
    assert verdict(res).collect()[0]["overall_passed"] is True
    assert verdict(res, missing_is_failure=True).collect()[0]["overall_passed"] is False
    nothing = spark.createDataFrame([], res.schema)
    assert verdict(nothing).collect()[0]["overall_passed"] is True
