"""Service logs: ``<asctime> [<LEVEL>] - <message>`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import c

# Fixed formats of the service log lines.
LINE_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \[([A-Z]+)\] - (.*)$"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"
ELAPSED_PATTERN = r"prediction completed in ([0-9]+(?:\.[0-9]+)?) seconds"


def parse_service_log(df: DataFrame, col: str = "value") -> DataFrame:
    """``(ts, level, message, seconds)``; lines that do not match give null fields."""
    line = c(col)
    ok = line.rlike(LINE_PATTERN)
    stamp = F.regexp_extract(line, LINE_PATTERN, 1)
    msg = F.regexp_extract(line, LINE_PATTERN, 3)
    secs = F.regexp_extract(msg, ELAPSED_PATTERN, 1)
    return df.select(
        F.when(ok, F.to_timestamp_ntz(stamp, F.lit(TIME_FORMAT))).alias("ts"),
        F.when(ok, F.regexp_extract(line, LINE_PATTERN, 2)).alias("level"),
        F.when(ok, msg).alias("message"),
        F.when(secs != "", secs.cast("double")).alias("seconds"))


def read_service_log(spark: SparkSession, path: str) -> DataFrame:
    """Parse a log file (or folder) line by line."""
    return parse_service_log(spark.read.text(path), "value")


def format_log_line(ts, level, message):
    """The line a service writes: ``asctime [LEVEL] - message``."""
    return F.concat(F.date_format(ts, TIME_FORMAT), F.lit(" ["), level, F.lit("] - "), message)
