"""Data-quality checks computed from one aggregate over the input.

Results are a tidy table, one row per (check, column)::

    check, column_name, missing_fraction, expected_type, actual_type,
    expected_min, expected_max, actual_min, actual_max, passed, error

Missing-value and range statistics for all columns come out of a single
``agg`` (one scan, partial aggregation on every executor); type checks need
only the schema. ``verdict`` folds the table into one boolean row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import c, is_floating, is_numeric, is_string, to_double

RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("missing_fraction", T.DoubleType()),
    T.StructField("expected_type", T.StringType()),
    T.StructField("actual_type", T.StringType()),
    T.StructField("expected_min", T.DoubleType()),
    T.StructField("expected_max", T.DoubleType()),
    T.StructField("actual_min", T.DoubleType()),
    T.StructField("actual_max", T.DoubleType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("error", T.StringType()),
])
FIELDS = [f.name for f in RESULT_SCHEMA.fields]


def _row(**values) -> Column:
    """A result struct with every field present (typed nulls for the rest)."""
    return F.struct(*[
        (values[f.name] if isinstance(values.get(f.name), Column)
         else F.lit(values.get(f.name)).cast(f.dataType)).alias(f.name)
        for f in RESULT_SCHEMA.fields])


def _not_found(name: str) -> str:
    return f"Column {name} not found in the dataset"


def _missing_expr(df: DataFrame, name: str, nan_as_missing: bool) -> Column:
    col = c(name)
    cond = col.isNull()
    if nan_as_missing and is_floating(df.schema[name].dataType):
        cond = cond | F.isnan(col)
    return F.count_if(cond)


def _range_value(df: DataFrame, name: str, nan_as_missing: bool) -> tuple[Column, bool]:
    """Numeric view of a column for range checks, and whether it is text."""
    dtype = df.schema[name].dataType
    col = c(name)
    if is_numeric(dtype):
        val = col.cast("double")
        if nan_as_missing and is_floating(dtype):
            val = F.nanvl(val, F.lit(None).cast("double"))
        return val, False
    return to_double(col), True


def _stat_plan(df: DataFrame, missing_cols, ranges, threshold, nan_as_missing):
    """Aggregates and the struct rows built from their one-row result."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    rows = []
    total = F.col("__rows")
    for i, name in enumerate(missing_cols):
        aggs.append(_missing_expr(df, name, nan_as_missing).alias(f"__m{i}"))
        frac = F.when(total > 0, F.col(f"__m{i}") / total)
        rows.append(_row(check="missing_values", column_name=F.lit(name),
                         missing_fraction=frac,
                         passed=F.coalesce(frac <= F.lit(threshold), F.lit(False))))
    for j, (name, (lo, hi)) in enumerate((ranges or {}).items()):
        base = dict(check="value_ranges", column_name=F.lit(name),
                    expected_min=F.lit(float(lo)), expected_max=F.lit(float(hi)))
        if name not in df.columns:
            rows.append(_row(**base, error=F.lit(_not_found(name))))
            continue
        dtype = df.schema[name].dataType
        if not (is_numeric(dtype) or is_string(dtype)):
            rows.append(_row(**base, passed=F.lit(False),
                             error=F.lit(f"Column {name} of type {dtype.simpleString()} has no numeric range")))
            continue
        val, textual = _range_value(df, name, nan_as_missing)
        aggs += [F.min(val).alias(f"__lo{j}"), F.max(val).alias(f"__hi{j}")]
        amin, amax = F.col(f"__lo{j}"), F.col(f"__hi{j}")
        error = F.when(amin.isNull(), F.lit(f"Column {name} has no values"))
        if textual:
            aggs.append(F.count_if(c(name).isNotNull() & val.isNull()).alias(f"__bad{j}"))
            error = F.when(F.col(f"__bad{j}") > 0, F.lit(f"Column {name} has non-numeric values")) \
                     .otherwise(error)
        passed = F.when(error.isNull(), (amin >= float(lo)) & (amax <= float(hi))).otherwise(F.lit(False))
        rows.append(_row(**base, actual_min=amin, actual_max=amax, passed=passed, error=error))
    return aggs, rows


def _materialise(df: DataFrame, aggs, rows) -> DataFrame:
    if not rows:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def partial_stats(df: DataFrame, column_ranges: dict | None = None, missing_threshold: float = 0.1,
                  nan_as_missing: bool = False) -> DataFrame:
    """One row of counts, minima and maxima over ``df``, from which :func:`merged_checks` makes the check rows."""
    return df.agg(*_stat_plan(df, df.columns, column_ranges, missing_threshold, nan_as_missing)[0])


def merged_checks(partials: DataFrame, of: DataFrame, expected_types: dict | None = None, column_ranges: dict | None = None,
                  missing_threshold: float = 0.1, nan_as_missing: bool = False) -> DataFrame:
    """The rows of :func:`run_all_checks` over all that the partial rows stand for; ``of`` gives the schema.

    Counts add up, a least value is the least of the least ones; partials of no rows change nothing.
    """
    _, rows = _stat_plan(of, of.columns, column_ranges, missing_threshold, nan_as_missing)
    merge = {"__lo": F.min, "__hi": F.max}
    merged = partials.agg(*[merge.get(n[:4], lambda x: F.coalesce(F.sum(x), F.lit(0)))(n).alias(n)
                            for n in partials.columns if n.startswith("__")])
    result = merged.select(F.inline(F.array(*rows))) if rows else partials.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return result.unionByName(check_types(of, expected_types)) if expected_types else result


def check_missing(df: DataFrame, threshold: float = 0.1, nan_as_missing: bool = False) -> DataFrame:
    """Per column ``nulls / rows``; passes when ``<= threshold``.

    ``nan_as_missing`` also counts NaN in float/double columns. With zero
    rows the fraction is null and the check fails.
    """
    aggs, rows = _stat_plan(df, df.columns, None, threshold, nan_as_missing)
    return _materialise(df, aggs, rows)


def check_ranges(df: DataFrame, ranges: dict, nan_as_missing: bool = False) -> DataFrame:
    """Actual min and max inside ``[lo, hi]`` (inclusive), nulls ignored.

    NaN sorts above every number, so a NaN fails the upper bound unless
    ``nan_as_missing``. Text is read as numbers; text that is not a number
    yields an error row that fails. A missing column yields an error row
    with ``passed`` null.
    """
    aggs, rows = _stat_plan(df, [], ranges, 0.0, nan_as_missing)
    return _materialise(df, aggs, rows)


def check_types(df: DataFrame, expected: dict, ignore_case: bool = False) -> DataFrame:
    """Expected type name must be a substring of the actual ``simpleString``.

    So ``int`` passes for ``bigint`` and ``array<int>``. Needs the schema only
    (no job); the result is a small frame built from it.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    data = []
    for name, exp in (expected or {}).items():
        if name in actual:
            act = actual[name]
            ok = exp.lower() in act.lower() if ignore_case else exp in act
            data.append(("data_types", name, None, exp, act, None, None, None, None, ok, None))
        else:
            data.append(("data_types", name, None, exp, None, None, None, None, None, None,
                         _not_found(name)))
    return df.sparkSession.createDataFrame(data, RESULT_SCHEMA)


def run_all_checks(df: DataFrame, expected_types: dict | None = None,
                   column_ranges: dict | None = None, missing_threshold: float = 0.1,
                   nan_as_missing: bool = False, ignore_case: bool = False) -> DataFrame:
    """Missing values always; types and ranges when given. One scan in total."""
    aggs, rows = _stat_plan(df, df.columns, column_ranges, missing_threshold, nan_as_missing)
    result = _materialise(df, aggs, rows)
    if expected_types:
        result = result.unionByName(check_types(df, expected_types, ignore_case))
    return result


def verdict(results: DataFrame, missing_is_failure: bool = False) -> DataFrame:
    """One row: ``overall_passed`` plus counts.

    Rows without a ``passed`` value (missing columns) are ignored unless
    ``missing_is_failure``; nothing to check means passed.
    """
    passed = F.col("passed")
    if missing_is_failure:
        passed = F.coalesce(passed, F.lit(False))
    return results.agg(
        F.coalesce(F.bool_and(passed), F.lit(True)).alias("overall_passed"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(passed == F.lit(False)).alias("n_failed"),
        F.count_if(F.col("error").isNotNull()).alias("n_errors"))
