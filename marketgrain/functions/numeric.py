"""Arithmetic that keeps NULL where a quotient has no value, and number cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, NUMERIC)


def ratio(top: Column, bottom: Column, default: float | None = None) -> Column:
    """``top / bottom``; NULL (or ``default``) where either side is NULL or the divisor is zero."""
    quotient = F.try_divide(top, bottom)
    return quotient if default is None else F.coalesce(quotient, F.lit(default))


def finite(col: Column) -> Column:
    """The value as double with NaN and infinities turned into NULL."""
    number = col.cast("double")
    bad = F.isnan(number) | (F.abs(number) == float("inf"))
    return F.when(~bad, number)


def to_number(col: Column, kind: T.DataType) -> Column:
    """Best-effort double of a column of any type; what is no finite number becomes NULL."""
    if isinstance(kind, T.StringType):
        return finite(col.try_cast("double"))
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double") * 86400.0
    if isinstance(kind, T.TimestampNTZType):
        return finite(F.unix_micros(col.cast("timestamp")) / 1e6)
    if isinstance(kind, T.TimestampType):
        return finite(F.unix_micros(col) / 1e6)
    if isinstance(kind, T.BooleanType):
        return col.cast("int").cast("double")
    return finite(col)


def safe_float(col: Column, default: float = 0.0) -> Column:
    return F.coalesce(finite(col.try_cast("double")), F.lit(default))


def safe_bool(col: Column, default: bool = False) -> Column:
    return F.coalesce(col.try_cast("boolean"), F.lit(default))


def flag(condition: Column) -> Column:
    """0/1 integer of a condition; NULL counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def count_where(condition: Column) -> Column:
    """Number of rows for which ``condition`` holds, 0 for an empty input."""
    return F.coalesce(F.count_if(condition), F.lit(0))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    share = ratio(part * 100.0, whole)
    return share if digits is None else F.round(share, digits)


def clamp(col: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(col, F.lit(high)), F.lit(low))
