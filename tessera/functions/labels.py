"""Label matchers and series naming.

Regex matchers are fully anchored: ``pod=~"ml-api.*"`` must not match
``xml-api-1``. A series without the label compares as the empty string.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import c


def anchored(pattern: str) -> str:
    """The whole value, a trailing newline included; a dot matches newlines too."""
    return rf"\A(?s:{pattern})\z"


def label_value(df: DataFrame, label: str, labels_col: str = "labels") -> Column:
    """A label as text: a column of that name, else a key of the label map, else ''."""
    if label in df.columns:
        return F.coalesce(c(label), F.lit(""))
    if labels_col in df.columns:
        return F.coalesce(F.element_at(c(labels_col), F.lit(label)), F.lit(""))
    return F.lit("")


def matcher(df: DataFrame, label: str, op: str, value: str, labels_col: str = "labels") -> Column:
    """Predicate for one matcher: ``=``, ``!=``, ``=~`` or ``!~``."""
    v = label_value(df, label, labels_col)
    if op == "=":
        return v == F.lit(value)
    if op == "!=":
        return v != F.lit(value)
    if op == "=~":
        return v.rlike(anchored(value))
    if op == "!~":
        return ~v.rlike(anchored(value))
    raise ValueError(f"Unknown matcher: {op}")


def match(df: DataFrame, *matchers: tuple[str, str, str], labels_col: str = "labels") -> DataFrame:
    """Keep rows satisfying every ``(label, op, value)`` matcher."""
    out = df
    for label, op, value in matchers:
        out = out.where(matcher(df, label, op, value, labels_col))
    return out


def select_metric(df: DataFrame, name: str, metric_col: str = "metric") -> DataFrame:
    """Samples of one metric (a partition filter when the store is partitioned by it)."""
    return df.where(c(metric_col) == F.lit(name))


def _bound(value, dtype) -> Column:
    """A time bound in the column's own type; text goes through a cast, so a
    wall-clock bound on ``timestamp_ntz`` does not move with the session zone."""
    if hasattr(value, "isoformat"):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(dtype)


def time_range(df: DataFrame, start, end, ts: str = "ts") -> DataFrame:
    """Samples with ``start < ts <= end`` (a dashboard's visible range); pushed to the scan."""
    dtype = df.schema[ts].dataType
    return df.where((c(ts) > _bound(start, dtype)) & (c(ts) <= _bound(end, dtype)))


_TEMPLATE = re.compile(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}")


def series_name(df: DataFrame, template: str, labels_col: str = "labels") -> Column:
    """Legend text such as ``{{status}} - {{path}}`` from label values."""
    parts, pos = [], 0
    for m in _TEMPLATE.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(label_value(df, m.group(1), labels_col))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")
