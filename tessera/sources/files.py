"""File scans: CSV, Parquet, JSON, chosen by name or by path suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.columns import c

SCAN_FORMATS = ("csv", "parquet", "json")


def extract(spark: SparkSession, path: str, format: str = "csv",
            schema: StructType | str | None = None) -> DataFrame:
    """Read ``path`` as csv (header + inferred types), parquet or line-delimited json.

    Passing ``schema`` skips the inference pass CSV and JSON otherwise need,
    which matters when the input is large. Unknown formats raise before any job.
    """
    if format not in SCAN_FORMATS:
        raise ValueError(f"Unsupported format: {format}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if format == "csv":
        reader = reader.option("header", "true")
        if schema is None:
            reader = reader.option("inferSchema", "true")
        return reader.csv(path)
    if format == "parquet":
        return reader.parquet(path)
    return reader.json(path)


#: Column of a line that does not fit the schema, beside whatever could be read of it.
CORRUPT = "_corrupt_record"


def extract_checked(spark: SparkSession, path: str, format: str = "csv",
                    schema: StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of a csv or json scan that fit the schema, and the lines that do not (column ``line``).

    The schema is the given one, or inferred as in :func:`extract`; a JSON inference leaves malformed lines
    out of account. A csv line is malformed with too few or too many fields, or one that is no value of its
    type; empty lines are no rows. The two frames scan the files each for itself.
    """
    if format not in ("csv", "json"):
        raise ValueError(f"Unsupported format: {format}")
    if schema is None:
        schema = extract(spark, path, format).schema
    known = StructType([f for f in schema.fields if f.name != CORRUPT])
    whole = StructType([*known.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.option("header", "true").csv(path) if format == "csv" else reader.json(path)
    names = [c(f.name) for f in known.fields]
    # a line is judged by the columns that are read of it, and the corrupt column alone cannot be asked for: a
    # condition that always holds keeps every column in the scan, a count's too
    whole_line = F.hash(*[c(f.name) if "map<" not in f.dataType.simpleString() else F.to_json(c(f.name)) for f in known.fields]) >= -(1 << 31)
    odd = rows.where(c(CORRUPT).isNotNull() & whole_line).select(c(CORRUPT).alias("line"))
    return rows.where(c(CORRUPT).isNull() & whole_line).select(*names), odd


def read_training(spark: SparkSession, path: str, format: str | None = None,
                  schema: StructType | str | None = None) -> DataFrame:
    """Training-set scan: format from ``format`` or else from the path suffix."""
    if format is None:
        if path.endswith(".csv"):
            format = "csv"
        elif path.endswith(".parquet"):
            format = "parquet"
        else:
            raise ValueError(f"Unsupported file format: {path}")
    if format not in ("csv", "parquet"):
        raise ValueError(f"Unsupported file format: {path}")
    return extract(spark, path, format, schema)


SAMPLE_SCHEMA = "metric string, labels map<string,string>, ts timestamp, value double"


def read_samples(spark: SparkSession, path: str, format: str = "parquet",
                 metric: str | None = None) -> DataFrame:
    """Stored metric samples ``(metric, labels, ts, value)``.

    When the store is partitioned by ``metric`` on disk the filter prunes
    whole folders.
    """
    if format == "parquet":
        df = spark.read.parquet(path)
    elif format == "json":
        df = spark.read.schema(SAMPLE_SCHEMA).json(path)
    else:
        raise ValueError(f"Unsupported format: {format}")
    if metric is not None:
        df = df.where(df["metric"] == metric)
    return df
