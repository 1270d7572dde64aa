"""Values: what counts as a number, milliseconds, intervals."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column types accepted as numbers. Decimals, booleans and text are not.
NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def finite(value: Column) -> Column:
    """The double itself, or null if it is NaN or infinite."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def any_to_double(df: DataFrame, column: str) -> Column:
    """A column of any type as a finite double; types that are no plain number give null."""
    dtype = df.schema[column].dataType
    if not isinstance(dtype, NUMERIC_TYPES):
        return F.lit(None).cast("double")
    value = F.col(column).cast("double")
    return finite(value) if isinstance(dtype, (T.DoubleType, T.FloatType)) else value


def finite_only(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose value is not a finite number."""
    return df.withColumn(column, any_to_double(df, column)).filter(F.col(column).isNotNull())


def negate(value: Column) -> Column:
    return -value


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def truncate_millis(ts: Column) -> Column:
    """A timestamp at wire precision. The wire carries whole milliseconds only."""
    return F.timestamp_millis(F.unix_millis(ts.cast("timestamp")))


def utc_day(ts: Column) -> Column:
    """The day of a timestamp in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts.cast("timestamp")) / 86_400_000_000).cast("int"))


def floor_div(number: Column, width: int) -> Column:
    """Whole-number quotient, rounded down, without going through doubles for the remainder."""
    return ((number - F.pmod(number, F.lit(width))) / width).cast("bigint")


def interval_seconds(text: str | int) -> int:
    """``10``, ``"10"``, ``"10s"``, ``"1m"``, ``"2h"`` or ``"1d"`` as whole seconds."""
    if isinstance(text, int):
        return text
    match = re.fullmatch(r"\s*(\d+)\s*([smhd]?)\s*", text)
    if not match:
        raise ValueError(f"not an interval: {text!r}")
    return int(match[1]) * {"": 1, "s": 1, "m": 60, "h": 3600, "d": 86400}[match[2]]


def auto_interval(range_seconds: float, max_points: int) -> int:
    """Bucket width that shows a range in at most ``max_points`` buckets, in whole seconds."""
    return max(1, math.ceil(range_seconds / max_points))
