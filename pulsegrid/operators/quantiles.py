"""Exact percentiles of groups of any size.

A built-in exact percentile holds every distinct value of a group in one task. Here rows are
counted in coarse bins of their magnitude first. A second read keeps the rows of bins that hold a wanted rank,
a thousandth of an octave each, and counts these by fine bin and value. All bins are counted with partial aggregation, and the number of bins in a window, and
of distinct doubles in a fine bin, is bounded (about four million) whatever the group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.skew import salted_join

FINE_BITS = 32  # fine bins per power of two: 2 ** 32
COARSE_SHIFT = 22  # fine bins in a coarse bin: 2 ** 22
OPENED = 20_000  # coarse bins with a wanted rank that are sent to the rows; some 100 bytes each


def _fine_bin(value: Column) -> Column:
    """A whole number that never falls as the value rises: its binary logarithm, finely cut.

    Infinity is above all numbers and NaN above infinity, as Spark sorts them.
    """
    endless = float("inf")
    size = F.floor((F.log2(F.abs(value)) + 1075) * float(2 ** FINE_BITS)) + 1
    return F.coalesce(
        F.when(F.isnan(value), F.lit(2 ** 62)).when(value == endless, F.lit(2 ** 61))
        .when(value == -endless, F.lit(-2 ** 61)).when(value > 0, size).when(value < 0, -size),
        F.lit(0)).cast("bigint")


def _ranks(quantiles: list[float], total: Column) -> Column:
    """Zero-based ranks on both sides of every quantile."""
    sides = []
    for q in quantiles:
        place = F.lit(float(q)) * (total - 1)
        sides += [F.floor(place), F.ceil(place)]
    return F.array_distinct(F.array(*[s.cast("bigint") for s in sides]))


def _held(ranks: Column, end: Column, count: Column) -> Column:
    """Those ranks that fall into the last ``count`` rows before ``end``."""
    return F.filter(ranks, lambda r: (r >= end - count) & (r < end))


def exact_percentiles(df: DataFrame, keys: list[str], value: str,
                      quantiles: dict[str, float]) -> DataFrame:
    """Keys, ``n`` (values that are not null) and one column per quantile, interpolated linearly.

    ``quantiles`` maps column names to fractions. Groups without any value give no row. The first read is done at
    once, to see how many bins are opened.
    """
    fractions = list(quantiles.values())
    # the keys as one struct, and bins, are never null: so no join adds a null filter of its own
    rows = (df.filter(F.col(value).isNotNull())
            .select(F.struct(*keys).alias("_key"), F.col(value).alias("_value"))
            .withColumn("_fine", _fine_bin(F.col("_value")))
            .withColumn("_coarse", F.shiftright("_fine", COARSE_SHIFT)))

    # first read: coarse bins are counted straight from the rows, and no value is shuffled
    in_key = Window.partitionBy("_key").orderBy("_coarse")
    start = (F.col("_end") - F.col("_count")).alias("_start")
    coarse = (rows.groupBy("_key", "_coarse").agg(F.count("*").alias("_count"))
              .withColumn("n", F.sum("_count").over(
                  in_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
              .withColumn("_end", F.sum("_count").over(in_key))
              .withColumn("_ranks", _held(_ranks(fractions, F.col("n")), F.col("_end"),
                                          F.col("_count")))
              .filter(F.size("_ranks") > 0).select("_key", "_coarse", "n", "_ranks", start))

    # second read: only rows of opened bins go on. Few bins go to the rows, many meet them by key
    few = coarse.limit(OPENED + 1).collect()
    if len(few) <= OPENED:
        opened = rows.join(F.broadcast(df.sparkSession.createDataFrame(few, coarse.schema)), ["_key", "_coarse"])
    else:
        opened = salted_join(rows, coarse, ["_key", "_coarse"], ["_value"])
    counted = (opened.groupBy("_key", "_coarse", "n", "_ranks", "_start", "_fine", "_value")
               .agg(F.count("*").alias("_count")))

    in_coarse = Window.partitionBy("_key", "_coarse").orderBy("_fine")
    fine = (counted.groupBy("_key", "_coarse", "n", "_ranks", "_start", "_fine")
            .agg(F.sum("_count").alias("_count"))
            .withColumn("_end", F.col("_start") + F.sum("_count").over(in_coarse))
            .withColumn("_ranks", _held(F.col("_ranks"), F.col("_end"), F.col("_count")))
            .filter(F.size("_ranks") > 0).select("_key", "_fine", "n", "_ranks", start))

    in_fine = Window.partitionBy("_key", "_fine").orderBy("_value")
    hits = (counted.select("_key", "_fine", "_value", "_count").join(fine, ["_key", "_fine"])
            .withColumn("_end", F.col("_start") + F.sum("_count").over(in_fine))
            .select("_key", "n", "_value", F.explode(
                _held(F.col("_ranks"), F.col("_end"), F.col("_count"))).alias("_rank")))

    results = []
    for name, q in quantiles.items():
        place = F.lit(float(q)) * (F.col("n") - 1)
        below = F.max(F.when(F.col("_rank") == F.floor(place), F.col("_value")))
        above = F.max(F.when(F.col("_rank") == F.ceil(place), F.col("_value")))
        part = place - F.floor(place)
        # two equal ends, such as infinities, have nothing between them
        results.append(F.when((part == 0) | (below == above), below).otherwise(
            below * (1 - part) + above * part).alias(name))
    found = hits.groupBy("_key", "n").agg(*results)
    return found.select("_key.*", "n", *quantiles)


def approximate_percentiles(quantiles: dict[str, float], value: str,
                            accuracy: int = 10000) -> list[Column]:
    """Aggregates for a group-by: bounded sketches, within 1/accuracy of the rank."""
    return [F.percentile_approx(value, q, accuracy).alias(name) for name, q in quantiles.items()]
