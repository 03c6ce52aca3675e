"""Null profiling and filling (the ETL transform step).

All per-column statistics come out of ONE aggregate over the input, then
are turned into rows with ``inline`` on a one-row result, so n columns cost
one scan instead of n jobs.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from tessera.functions.columns import c, is_numeric, is_string, to_double


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` for every column; NaN is not null."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], "column_name string, null_count bigint")
    aggs = [F.count_if(c(name).isNull()).alias(f"n{i}") for i, name in enumerate(df.columns)]
    rows = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(f"n{i}").alias("null_count"))
                     for i, name in enumerate(df.columns)])
    return df.agg(*aggs).select(F.inline(rows))


def _stats_rows(df: DataFrame, picked, with_nulls: bool):
    """Aggregates and result structs for :func:`profile` / :func:`profile_with_nulls`.

    Numeric statistics (and null counts) go in one hash aggregate; text
    min/max need variable-width buffers, which force a slower sort-based
    aggregate, so they run as a second aggregate over the text columns only,
    which are thus read twice; :func:`observed_profile` reads everything once.
    """
    num_aggs, str_aggs = [F.count(F.lit(1)).alias("__rows")], [F.count(F.lit(1)).alias("__rows2")]
    for i, (name, dtype) in enumerate(picked):
        col = c(name)
        if with_nulls:
            num_aggs.append(F.count_if(col.isNull()).alias(f"z{i}"))
        if is_numeric(dtype) or is_string(dtype):
            as_num = col.cast("double") if is_numeric(dtype) else to_double(col)
            num_aggs += [F.count(col).alias(f"n{i}"), F.avg(as_num).alias(f"a{i}"),
                         F.stddev_samp(as_num).alias(f"s{i}")]
            if is_numeric(dtype):
                num_aggs += [F.min(as_num).alias(f"lo{i}"), F.max(as_num).alias(f"hi{i}")]
            else:
                str_aggs += [F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}")]
    return num_aggs, str_aggs


def _profile_frame(df: DataFrame, picked, with_nulls: bool) -> DataFrame:
    num_aggs, str_aggs = _stats_rows(df, picked, with_nulls)
    num_structs, str_structs = [], []
    for i, (name, dtype) in enumerate(picked):
        fields = [F.lit(name).alias("column_name")]
        if with_nulls:
            fields.append(F.col(f"z{i}").alias("null_count"))
        if is_numeric(dtype) or is_string(dtype):
            num = is_numeric(dtype)
            fields += [F.col(f"n{i}").alias("n"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                       (F.col(f"lo{i}") if num else F.lit(None).cast("double")).alias("min_num"),
                       (F.col(f"hi{i}") if num else F.lit(None).cast("double")).alias("max_num")]
            if not num:
                str_structs.append(F.struct(F.lit(name).alias("column_name"), F.col(f"lo{i}").alias("min_str"),
                                            F.col(f"hi{i}").alias("max_str")))
        else:
            fields += [F.lit(None).cast(t).alias(n) for n, t in
                       [("n", "bigint"), ("mean", "double"), ("stddev", "double"), ("min_num", "double"),
                        ("max_num", "double")]]
        num_structs.append(F.struct(*fields))
    out = df.agg(*num_aggs).select(F.inline(F.array(*num_structs)))
    if str_structs:
        # one row per text column: bounded by the column count, broadcast
        texts = df.agg(*str_aggs).select(F.inline(F.array(*str_structs)))
        out = out.join(F.broadcast(texts), "column_name", "left")
    else:
        out = out.withColumns({"min_str": F.lit(None).cast("string"), "max_str": F.lit(None).cast("string")})
    cols = ["column_name"] + (["null_count"] if with_nulls else []) + \
        ["n", "mean", "stddev", "min_num", "max_num", "min_str", "max_str"]
    return out.select(*cols)


def profile(df: DataFrame) -> DataFrame:
    """Count, mean, sample stddev, min and max of numeric and string columns.

    Long and typed: ``(column_name, n, mean, stddev, min_num, max_num,
    min_str, max_str)``. Strings get their mean/stddev from the value read as
    a number (null when none is numeric), as ``describe`` does; other types
    (dates, timestamps, booleans, nested) are skipped, as ``describe`` skips them.
    """
    picked = [(name, f.dataType) for name, f in zip(df.columns, df.schema.fields)
              if is_numeric(f.dataType) or is_string(f.dataType)]
    schema = ("column_name string, n bigint, mean double, stddev double, min_num double, "
              "max_num double, min_str string, max_str string")
    if not picked:
        return df.sparkSession.createDataFrame([], schema)
    return _profile_frame(df, picked, with_nulls=False)


def observed_profile(df: DataFrame) -> tuple[DataFrame, Callable[[], list[Row]]]:
    """``df`` observed on its way to a sink, and what returns the rows of :func:`profile_with_nulls` afterwards.

    The statistics are gathered by the action that ``df`` is used in, so they cost no scan of their own.
    Call the second one after that action, which must be the frame's first.
    """
    picked = [(f.name, f.dataType) for f in df.schema.fields]
    num_aggs, str_aggs = _stats_rows(df, picked, True)
    seen = Observation(f"profile-{uuid4().hex}")

    def rows() -> list[Row]:
        got = seen.get
        fields = ["column_name", "null_count", "n", "mean", "stddev", "min_num", "max_num", "min_str", "max_str"]
        return [Row(*fields)(name, *(got.get(f"{x}{i}") for x in "znas"),
                             *([got.get(f"lo{i}"), got.get(f"hi{i}")] if is_numeric(dtype) else [None, None]),
                             *([got.get(f"lo{i}"), got.get(f"hi{i}")] if is_string(dtype) else [None, None]))
                for i, (name, dtype) in enumerate(picked)]

    return df.observe(seen, *num_aggs, *str_aggs[1:]), rows


class UnfillableColumnError(TypeError):
    pass


def fill_missing(df: DataFrame, string_value: str = "unknown", numeric_value=0,
                 strict: bool = False) -> DataFrame:
    """Replace nulls: strings get ``string_value``, numbers get ``numeric_value``.

    NaN stays NaN (``na.fill`` would replace it) and every column keeps its
    type. Other types cannot take either filler: with ``strict`` they raise,
    otherwise they pass through unchanged. One ``select``, so the plan does
    not grow with the column count.
    """
    out = []
    for name, field in zip(df.columns, df.schema.fields):
        dtype = field.dataType
        col = c(name)
        if is_string(dtype):
            out.append(F.coalesce(col, F.lit(string_value)).alias(name))
        elif is_numeric(dtype):
            out.append(F.coalesce(col, F.lit(numeric_value).cast(dtype)).alias(name))
        elif strict:
            raise UnfillableColumnError(f"Column {name} of type {dtype.simpleString()} cannot be filled")
        else:
            out.append(col)
    return df.select(*out)


def profile_with_nulls(df: DataFrame) -> DataFrame:
    """Null counts for every column plus the :func:`profile` statistics, in one pass.

    ``(column_name, null_count, n, mean, stddev, min_num, max_num, min_str, max_str)``;
    statistics are null for columns :func:`profile` skips.
    """
    schema = ("column_name string, null_count bigint, n bigint, mean double, stddev double, "
              "min_num double, max_num double, min_str string, max_str string")
    if not df.columns:
        return df.sparkSession.createDataFrame([], schema)
    return _profile_frame(df, [(n, f.dataType) for n, f in zip(df.columns, df.schema.fields)], with_nulls=True)
