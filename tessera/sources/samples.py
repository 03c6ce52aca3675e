"""A stored sample table that scans prune: folders by metric and day, row groups by labels and time.

Labels of a sample ``(metric, labels map, ts, value)`` are stored as columns of their own,
``label_<name>`` (null: the series has no such label), because neither partition folders nor
row-group statistics can be asked for a map's entries. Files are cut by row counts in the order
(metric, day, labels, time), so one hot metric or day is many files and a file holds few series.

A read states its metric, its time range and its label matchers as filters on those columns; what
a regex implies about the value (one text, a few, a prefix) goes to the scan, and the regex itself
decides what is left. Batch and stream read the same folders.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.functions.labels import anchored, time_range
from tessera.session import remove
from tessera.streaming.runs import scratch_path

#: Fixed value: what a label's column is called.
PREFIX = "label_"
#: Samples that one task sorts and writes.
FILE_ROWS = 500_000
_PLAIN = re.compile(r"[A-Za-z0-9 _/:,;=@#%&~<>\"'`!-]*")
_GROUP = re.compile(r"(?P<head>[^()|]*)\((?P<inner>[^()]*)\)(?P<tail>[^()|]*)")


def write_samples(samples: DataFrame, path: str, labels: Iterable[str], mode: str = "append") -> None:
    """Append samples to the store; ``labels`` names the label columns that the store has.

    A sample with a label that is not named is refused, and so is one without a metric or a time: nothing
    that could not be found again is stored. Null values are kept. The samples are computed once, into a folder
    that goes again: their number says how many tasks sort and write them, :data:`FILE_ROWS` rows or so each.
    """
    names = sorted(set(labels))
    known = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    stray = F.array_except(F.map_keys(F.coalesce("labels", F.create_map().cast("map<string,string>"))), known)
    odd = F.when(F.col("metric").isNull() | F.col("ts").isNull(), F.lit("a sample without metric or time")) \
           .when(F.size(stray) > 0, F.concat(F.lit("labels that the store does not have: "), F.concat_ws(", ", stray)))
    cols = [F.element_at("labels", F.lit(n)).alias(PREFIX + n) for n in names]
    flat = samples.select(F.when(odd.isNotNull(), F.raise_error(odd).cast("string")).otherwise(F.col("metric")).alias("metric"),
                          F.to_date("ts").alias("day"), *cols, "ts", "value")
    order = ["metric", "day", *[PREFIX + n for n in names], "ts"]
    spark, unsorted = samples.sparkSession, scratch_path(samples.sparkSession, "unsorted-samples")
    try:
        flat.write.parquet(unsorted)
        rows = spark.read.schema(flat.schema).parquet(unsorted)
        parts = max(1, math.ceil(rows.count() / FILE_ROWS))
        (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .write.mode(mode).partitionBy("metric", "day").parquet(path))
    finally:
        remove(spark, unsorted)


def implied(pattern: str) -> tuple[str, list[str]] | None:
    """What an anchored regex says plainly: ``("in", texts)``, ``("prefix", [text])``, or nothing.

    The first is exact and the second only necessary.
    """
    if _PLAIN.fullmatch(pattern):
        return "in", [pattern]
    m = _GROUP.fullmatch(pattern)
    head, inner, tail = (m["head"], m["inner"], m["tail"]) if m else ("", pattern, "")
    choices = inner.split("|")
    if len(choices) > 1 and all(_PLAIN.fullmatch(x) for x in (head, tail, *choices)):
        return "in", [head + x + tail for x in choices]
    if "|" in pattern:
        return None
    start = _PLAIN.match(pattern).group()
    if pattern[len(start):len(start) + 1] in ("?", "*", "{"):
        start = start[:-1]  # the last plain character is optional
    return ("prefix", [start]) if start else None


def label_filter(df: DataFrame, label: str, op: str, value: str) -> Column:
    """One matcher on the store's columns, in a form that scans take; a missing label is the empty text."""
    if PREFIX + label not in df.columns:
        hit = {"=": value == "", "!=": value != ""}.get(op)
        if hit is None:
            hit = F.lit("").rlike(anchored(value))
            return hit if op == "=~" else ~hit
        return F.lit(hit)
    col = c(PREFIX + label)
    if op == "=":
        return col == value if value else col.isNull() | (col == "")
    if op == "!=":
        return col.isNull() | (col != value) if value else col.isNotNull() & (col != "")
    text = F.coalesce(col, F.lit(""))
    if op == "!~":
        return ~text.rlike(anchored(value))
    if op != "=~":
        raise ValueError(f"Unknown matcher: {op}")
    plain = implied(value)
    if plain is None:
        return text.rlike(anchored(value))
    kind, texts = plain
    if kind == "in":
        found = col.isin([t for t in texts if t])
        return found | col.isNull() | (col == "") if "" in texts else found
    return col.startswith(texts[0]) & text.rlike(anchored(value))


def _pruned(df: DataFrame, metric: str | None, matchers, start, end) -> DataFrame:
    if metric is not None:
        df = df.where(F.col("metric") == metric)
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    if start is not None:
        dtype = df.schema["ts"].dataType
        day = lambda x: F.to_date(F.lit(x.isoformat(sep=" ") if hasattr(x, "isoformat") else x).cast(dtype))
        df = time_range(df.where((F.col("day") >= day(start)) & (F.col("day") <= day(end))), start, end)
    for label, op, value in matchers:
        df = df.where(label_filter(df, label, op, value))
    return df


def _plain_names(df: DataFrame) -> DataFrame:
    """Labels under their own names; the store's day goes."""
    return df.select("metric", *[c(n).alias(n[len(PREFIX):]) for n in df.columns if n.startswith(PREFIX)], "ts", "value")


def read_store(spark: SparkSession, path: str, metric: str | None = None, matchers: Iterable[tuple[str, str, str]] = (),
               start=None, end=None) -> DataFrame:
    """Samples ``(metric, labels..., ts, value)`` of one metric in ``(start, end]`` that every matcher keeps."""
    return _plain_names(_pruned(spark.read.parquet(path), metric, matchers, start, end))


def read_store_stream(spark: SparkSession, path: str, metric: str | None = None, matchers: Iterable[tuple[str, str, str]] = (),
                      start=None, end=None, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream of the store's files as they arrive."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _plain_names(_pruned(reader.parquet(path), metric, matchers, start, end))
