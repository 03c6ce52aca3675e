"""The ETL run: scan -> profile -> fill -> write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.clean import fill_missing, observed_profile, profile_with_nulls
from tessera.sources.files import extract
from tessera.sources.sinks import load


def transform(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Filled frame (lazy) and the column profile (one aggregate over the input)."""
    return fill_missing(df, strict=strict), profile_with_nulls(df)


def run_pipeline(spark: SparkSession, source_path: str, destination_path: str, source_format: str = "csv",
                 dest_format: str = "parquet", schema=None, strict: bool = False):
    """Extract, profile, fill and load; returns ``(filled frame, profile rows)``.

    The source is parsed once (after an inference, if no schema is given): the profile is observed
    by the write itself. The returned frame stays lazy.
    """
    df = extract(spark, source_path, source_format, schema)
    seen, profile_rows = observed_profile(df)
    load(fill_missing(seen, strict=strict), destination_path, dest_format)
    return fill_missing(df, strict=strict), profile_rows()
