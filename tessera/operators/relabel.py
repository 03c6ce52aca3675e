"""Target relabelling on label maps (``map<string,string>``).

Source label values are joined with ``;`` (a missing label is ''); the
regex is fully anchored. ``keep`` drops rows that do not match; ``replace``
writes the expanded replacement to the target label when the regex
matches (an empty result removes the label) and leaves the row alone
otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.functions.labels import anchored


def joined_sources(labels: Column, sources: list[str], separator: str = ";") -> Column:
    return F.concat_ws(separator, *[F.coalesce(F.element_at(labels, F.lit(s)), F.lit("")) for s in sources])


def relabel_keep(df: DataFrame, sources: list[str], regex: str, labels_col: str = "labels",
                 separator: str = ";") -> DataFrame:
    return df.where(joined_sources(c(labels_col), sources, separator).rlike(anchored(regex)))


def relabel_drop(df: DataFrame, sources: list[str], regex: str, labels_col: str = "labels",
                 separator: str = ";") -> DataFrame:
    return df.where(~joined_sources(c(labels_col), sources, separator).rlike(anchored(regex)))


def relabel_replace(df: DataFrame, sources: list[str], target: str, regex: str = "(.*)",
                    replacement: str = "$1", labels_col: str = "labels", separator: str = ";") -> DataFrame:
    labels = c(labels_col)
    val = joined_sources(labels, sources, separator)
    pat = anchored(regex)
    new = F.regexp_replace(val, F.lit(pat), F.lit(replacement))
    without = F.map_filter(labels, lambda k, v: k != F.lit(target))
    updated = F.when(new == "", without).otherwise(
        F.map_concat(without, F.create_map(F.lit(target), new)))
    return df.withColumn(labels_col, F.when(val.rlike(pat), updated).otherwise(labels))


def apply_rules(df: DataFrame, rules: list[dict], labels_col: str = "labels") -> DataFrame:
    """Apply ``[{action, source_labels, regex, target_label, replacement}]`` in order."""
    out = df
    for r in rules:
        action = r.get("action", "replace")
        sources = r.get("source_labels", [])
        regex = r.get("regex", "(.*)")
        if action == "keep":
            out = relabel_keep(out, sources, regex, labels_col)
        elif action == "drop":
            out = relabel_drop(out, sources, regex, labels_col)
        elif action == "replace":
            out = relabel_replace(out, sources, r["target_label"], regex, r.get("replacement", "$1"),
                                  labels_col)
        else:
            raise ValueError(f"Unknown relabel action: {action}")
    return out
