"""Time helpers: epoch microseconds, interval parsing, stamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"ms": 0.001, "s": 1, "sec": 1, "second": 1, "seconds": 1, "m": 60, "min": 60,
          "minute": 60, "minutes": 60, "h": 3600, "hour": 3600, "hours": 3600,
          "d": 86400, "day": 86400, "days": 86400}


def seconds(spec) -> float:
    """``"15 seconds"``, ``"1m"``, ``"24 hours"`` or a number of seconds."""
    if isinstance(spec, (int, float)):
        return float(spec)
    m = re.fullmatch(r"\s*([0-9.]+)\s*([a-zA-Z]+)\s*", spec)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"Cannot read duration: {spec!r}")
    return float(m.group(1)) * _UNITS[m.group(2).lower()]


def micros(col: Column, dtype: T.DataType) -> Column:
    """Epoch microseconds of a timestamp, timestamp_ntz (read as UTC wall time) or seconds."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(F.from_utc_timestamp(col.cast("timestamp"), F.current_timezone()))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.DateType):
        return F.unix_micros(F.from_utc_timestamp(col.cast("timestamp"), F.current_timezone()))
    return (col.cast("double") * 1_000_000).cast("long")


def ntz_from_micros(col: Column) -> Column:
    """UTC wall-clock ``timestamp_ntz`` from epoch microseconds, whatever the session zone."""
    return F.to_utc_timestamp(F.timestamp_micros(col), F.current_timezone()).cast("timestamp_ntz")


def stamp(col: Column) -> Column:
    """``yyyyMMdd_HHmmss`` text of a timestamp (model version names)."""
    return F.date_format(col, "yyyyMMdd_HHmmss")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two timestamps, with microsecond precision."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def seconds_text(micros_col: Column, digits: int = 4) -> Column:
    """Seconds as text with ``digits`` decimals, rounded half-up on the exact
    microsecond value (integer arithmetic, so every engine prints the same)."""
    unit = 10 ** (6 - digits)
    q = F.floor((micros_col + F.lit(unit // 2)) / F.lit(unit)).cast("long")
    return F.format_string(f"%d.%0{digits}d", F.floor(q / 10 ** digits).cast("long"), q % (10 ** digits))
