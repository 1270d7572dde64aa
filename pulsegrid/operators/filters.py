"""Predicates of panel queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.tags import tag
from pulsegrid.functions.values import utc_day


def measurement_is(name: str) -> Column:
    return F.col("name") == name


def tag_eq(df: DataFrame, key: str, value: str) -> Column:
    """A tag has a value. Mind that the tag ``name`` is not the measurement's name."""
    return tag(df, key) == value


def tag_re(df: DataFrame, key: str, pattern: str) -> Column:
    """A tag as a whole matches a pattern; a row without the tag does not."""
    return F.coalesce(tag(df, key).rlike(f"^(?:{pattern})$"), F.lit(False))


def time_range(df: DataFrame, start: str, end: str) -> Column:
    """start <= ts < end, and the same for the (UTC) day column ``d`` of stored points, so that
    whole days are skipped."""
    first, last = (F.lit(t).cast("timestamp") for t in (start, end))
    inside = (F.col("ts") >= first) & (F.col("ts") < last)
    if "d" in df.columns:
        inside &= (F.col("d") >= utc_day(first)) & (F.col("d") <= utc_day(last))
    return inside


def lookback(now: str, minutes: int = 30) -> tuple[Column, Column]:
    """The default range of a panel: the minutes up to ``now``."""
    end = F.lit(now).cast("timestamp")
    return end - F.make_interval(mins=F.lit(minutes)), end
