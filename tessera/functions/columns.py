"""Small helpers for naming and classifying columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
FLOATING_TYPES = (T.FloatType, T.DoubleType)


def quote(name: str) -> str:
    """Backquote a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    """Column reference that survives names such as ``a.b``."""
    return F.col(quote(name))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, FLOATING_TYPES)


def is_string(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


# Fixed value: text shapes that can be read as a double (decimal, exponent, nan, inf).
NUMERIC_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"


def to_double(col: Column) -> Column:
    """Text as double, null when it is not a number.

    The regex guard keeps non-numeric text away from the parser, whose
    failure path is far slower than a regex test.
    """
    return F.when(col.rlike(NUMERIC_TEXT), col.try_cast("double"))
