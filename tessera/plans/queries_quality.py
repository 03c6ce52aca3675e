"""Queries for the data-quality checks and the verdict."""

from __future__ import annotations

from tessera.operators.quality import (check_missing, check_ranges, check_types, run_all_checks,
                                       verdict)
from tessera.plans.catalog import (LINEITEM_COLS, LINEITEM_NAN_SQL, LINEITEM_NULLS_SQL, _union,
                                   register)
from tessera.plans.derived import (documents_labelled, lineitem_numeric_strings, lineitem_with_nan,
                                   lineitem_with_nulls)

# Fixed parameters of the registered checks.
THRESHOLD = 0.1
LINEITEM_RANGES = {"l_quantity": (1, 50), "l_discount": (0.0, 0.1), "l_tax": (0.0, 0.05),
                   "l_extendedprice": (0, 200000), "l_comment": (0, 1)}
STRING_RANGES = {"line_text": (1, 7), "line_text_dirty": (1, 7), "qty_text": (1, 50)}
LINEITEM_TYPES = {"l_orderkey": "int", "l_linenumber": "int", "l_quantity": "double",
                  "l_returnflag": "string", "l_shipdate": "date", "l_comment": "string"}

_NULL_D = "cast(null as double)"
_NULL_S = "cast(null as varchar)"


def _sql_row(check, column, frac=_NULL_D, etype=_NULL_S, atype=_NULL_S, emin=_NULL_D,
             emax=_NULL_D, amin=_NULL_D, amax=_NULL_D, passed="cast(null as boolean)",
             error=_NULL_S, source="t"):
    return (f"select '{check}' as \"check\", '{column}' as column_name, {frac} as missing_fraction, "
            f"{etype} as expected_type, {atype} as actual_type, {emin} as expected_min, "
            f"{emax} as expected_max, {amin} as actual_min, {amax} as actual_max, "
            f"{passed} as passed, {error} as error from {source}")


def _missing_sql(cols, nan_cols=(), threshold=THRESHOLD):
    parts = []
    for col in cols:
        cond = f"{col} is null" + (f" or isnan({col})" if col in nan_cols else "")
        frac = (f"case when count(*) > 0 then (count(*) filter (where {cond}))::double / count(*) end")
        parts.append(_sql_row("missing_values", col, frac=frac,
                              passed=f"coalesce(({frac}) <= {threshold}, false)"))
    return parts


def _range_sql(ranges, present, textual=(), nan_cols=()):
    parts = []
    for col, (lo, hi) in ranges.items():
        emin, emax = f"cast({lo} as double)", f"cast({hi} as double)"
        if col not in present:
            parts.append(_sql_row("value_ranges", col, emin=emin, emax=emax,
                                  error=f"'Column {col} not found in the dataset'", source="(select 1)"))
            continue
        if col in textual:
            val = f"try_cast({col} as double)"
        elif col in nan_cols:
            val = f"case when isnan({col}) then null else cast({col} as double) end"
        else:
            val = f"cast({col} as double)"
        amin, amax = f"min({val})", f"max({val})"
        err = f"case when {amin} is null then 'Column {col} has no values' end"
        if col in textual:
            err = (f"case when count(*) filter (where {col} is not null and {val} is null) > 0 "
                   f"then 'Column {col} has non-numeric values' else {err} end")
        passed = f"case when ({err}) is null then {amin} >= {emin} and {amax} <= {emax} else false end"
        parts.append(_sql_row("value_ranges", col, emin=emin, emax=emax, amin=amin, amax=amax,
                              passed=passed, error=err))
    return parts


@register("missing_check", f"with t as ({LINEITEM_NULLS_SQL})\n" + _union(_missing_sql(LINEITEM_COLS)))
def q_missing_check(spark, sf_dir):
    return check_missing(lineitem_with_nulls(spark, sf_dir), THRESHOLD)


@register("missing_check_nan", f"with t as ({LINEITEM_NAN_SQL})\n"
          + _union(_missing_sql(LINEITEM_COLS, nan_cols=("l_quantity", "l_extendedprice",
                                                         "l_discount", "l_tax"))))
def q_missing_check_nan(spark, sf_dir):
    return check_missing(lineitem_with_nan(spark, sf_dir), THRESHOLD, nan_as_missing=True)


_DOCS_LABELLED_SQL = "select * from documents left join labels using (doc_id)"


@register("missing_check_sparse", f"with t as ({_DOCS_LABELLED_SQL})\n" + _union(_missing_sql(
    ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"], threshold=0.5)))
def q_missing_check_sparse(spark, sf_dir):
    return check_missing(documents_labelled(spark, sf_dir), 0.5)


@register("range_check", f"with t as ({LINEITEM_NULLS_SQL})\n"
          + _union(_range_sql(LINEITEM_RANGES, LINEITEM_COLS)))
def q_range_check(spark, sf_dir):
    return check_ranges(lineitem_with_nulls(spark, sf_dir), LINEITEM_RANGES)


@register("range_check_nan", f"with t as ({LINEITEM_NAN_SQL})\n"
          + _union(_range_sql(LINEITEM_RANGES, LINEITEM_COLS, nan_cols=("l_quantity", "l_discount",
                                                                        "l_tax", "l_extendedprice"))))
def q_range_check_nan(spark, sf_dir):
    return check_ranges(lineitem_with_nan(spark, sf_dir), LINEITEM_RANGES, nan_as_missing=True)


_STRINGS_SQL = ("select l_orderkey, cast(l_linenumber as varchar) as line_text, "
                "case when l_linenumber = 7 then 'abc' else cast(l_linenumber as varchar) end "
                "as line_text_dirty, cast(l_quantity as varchar) as qty_text from lineitem")


@register("range_check_strings", f"with t as ({_STRINGS_SQL})\n" + _union(_range_sql(
    STRING_RANGES, list(STRING_RANGES), textual=tuple(STRING_RANGES))))
def q_range_check_strings(spark, sf_dir):
    return check_ranges(lineitem_numeric_strings(spark, sf_dir), STRING_RANGES)


# Spark type names of the lineitem columns, spelled from DuckDB's typeof().
_SPARK_TYPE = ("case lower(typeof({c})) when 'varchar' then 'string' when 'integer' then 'int' "
               "when 'timestamp' then 'timestamp_ntz' else lower(typeof({c})) end")


def _types_sql(expected, present):
    parts = []
    for col, exp in expected.items():
        if col in present:
            act = _SPARK_TYPE.format(c=col)
            parts.append(_sql_row("data_types", col, etype=f"'{exp}'", atype=act,
                                  passed=f"contains({act}, '{exp}')",
                                  source="(select * from t limit 1)"))
        else:
            parts.append(_sql_row("data_types", col, etype=f"'{exp}'",
                                  error=f"'Column {col} not found in the dataset'", source="(select 1)"))
    return parts


@register("type_check", f"with t as ({LINEITEM_NULLS_SQL})\n"
          + _union(_types_sql(LINEITEM_TYPES, LINEITEM_COLS)))
def q_type_check(spark, sf_dir):
    return check_types(lineitem_with_nulls(spark, sf_dir), LINEITEM_TYPES)


_ALL_PARTS = (_missing_sql(LINEITEM_COLS) + _range_sql(LINEITEM_RANGES, LINEITEM_COLS)
              + _types_sql(LINEITEM_TYPES, LINEITEM_COLS))
_ALL_SQL = f"with t as ({LINEITEM_NULLS_SQL}), r as (\n" + _union(_ALL_PARTS) + ")\n"


@register("all_checks", _ALL_SQL + "select * from r")
def q_all_checks(spark, sf_dir):
    return run_all_checks(lineitem_with_nulls(spark, sf_dir), LINEITEM_TYPES, LINEITEM_RANGES, THRESHOLD)


@register("quality_verdict", _ALL_SQL + (
    "select coalesce(bool_and(passed), true) as overall_passed, count(*) as n_checks, "
    "count(*) filter (where passed = false) as n_failed, "
    "count(*) filter (where error is not null) as n_errors from r"))
def q_quality_verdict(spark, sf_dir):
    return verdict(q_all_checks(spark, sf_dir))


@register("quality_verdict_strict", _ALL_SQL + (
    "select coalesce(bool_and(coalesce(passed, false)), true) as overall_passed, count(*) as n_checks, "
    "count(*) filter (where coalesce(passed, false) = false) as n_failed, "
    "count(*) filter (where error is not null) as n_errors from r"))
def q_quality_verdict_strict(spark, sf_dir):
    return verdict(q_all_checks(spark, sf_dir), missing_is_failure=True)
