"""Access to the parquet tables a query reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``; filters and projections reach the reader."""
    if name not in TABLES:
        raise ValueError(f"Unknown table: {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """The same table as a stream of its files, some to a micro-batch; a table may be a folder or one file."""
    folder, path = sf_dir.rstrip("/"), f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema).option("maxFilesPerTrigger", files_per_trigger)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
