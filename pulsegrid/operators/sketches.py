"""Quantile sketches as a column of buckets: kept once per series and narrow bucket, merged for any wider one.

A sketch is bounded (some 25 KB at the usual size) whatever it has seen. Its ranks are within half a per cent, nearly always, however
often sketches were merged. Count, least and greatest value stand beside it and are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.buckets import time_bucket

SIZE = 1000  # of a sketch: its rank error falls with it
PARTS = ["n", "low", "high", "sketch"]


def sketch_of(value: str, size: int = SIZE) -> list[Column]:
    """Aggregates for a group-by, over a table or a stream: n, low, high and sketch. Nulls are left out."""
    number = F.col(value).cast("double")
    return [F.count(number).alias("n"), F.min(number).alias("low"), F.max(number).alias("high"),
            F.kll_sketch_agg_double(number, F.lit(size)).alias("sketch")]


def sketch_buckets(df: DataFrame, width: int, keys: list[str], value: str, ts: str = "ts", size: int = SIZE) -> DataFrame:
    """(bucket, keys, n, low, high, sketch) of the values that are not null; buckets without any give no row."""
    rows = df.filter(F.col(value).isNotNull())
    return rows.groupBy(time_bucket(width, ts).alias("bucket"), *keys).agg(*sketch_of(value, size))


def widen_sketches(sketches: DataFrame, width: int, keys: list[str]) -> DataFrame:
    """Sketches of buckets ``width`` seconds wide, a multiple of what they were; values are not read again."""
    return sketches.groupBy(time_bucket(width, "bucket").alias("bucket"), *keys).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantile(fraction: float) -> Column:
    """A quantile of the sketch in a row; 0 and 1 are exact."""
    if fraction in (0, 1):
        return F.col("high" if fraction else "low")
    return F.kll_sketch_get_quantile_double("sketch", F.lit(float(fraction)))
