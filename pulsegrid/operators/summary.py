"""Instruments: raw observations summarised as gauge, counter, meter, histogram or timer.

Observations are rows (ts, keys, value). Summaries are per key, or per key and tick if the tick
is one of the keys.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.values import finite, floor_div
from pulsegrid.operators.buckets import cumulative, time_bucket
from pulsegrid.operators.quantiles import approximate_percentiles, exact_percentiles
from pulsegrid.operators.skew import explode_in_chunks, join_series

# Percentiles and moving rates a summary has, and the ticks of the rates.
PERCENTILES = {"95thPercentile": 0.95, "98thPercentile": 0.98, "99thPercentile": 0.99,
               "999thPercentile": 0.999}
RATE_MINUTES = {"OneMinuteRate": 1, "FiveMinuteRate": 5, "FifteenMinuteRate": 15}
TICK_SECONDS = 5


def summarise_gauge(df: DataFrame, keys: list[str], value: str = "value", ts: str = "ts") -> DataFrame:
    """The last finite value; keys that have none give no row."""
    last = F.max(F.struct(F.col(ts), F.col("_v")))["_v"].alias("Value")
    rows = df.withColumn("_v", finite(F.col(value).try_cast("double"))).filter(F.col("_v").isNotNull())
    return rows.groupBy(*keys).agg(last)


def summarise_counter(df: DataFrame, keys: list[str], delta: Column | None = None) -> DataFrame:
    """How often, or the sum of ``delta`` if given."""
    count = F.count("*") if delta is None else F.sum(delta)
    return df.groupBy(*keys).agg(count.cast("double").alias("Count"))


def counter_history(df: DataFrame, keys: list[str], width: int, ts: str = "ts") -> DataFrame:
    """The running count at the end of every bucket that has observations."""
    counts = df.groupBy(*keys, time_bucket(width, ts).alias("bucket")).agg(F.count("*").alias("_n"))
    return cumulative(counts, keys, "_n", "Count", width * 4096).drop("_n")


def _moments(value: str) -> list[Column]:
    return [F.max(value).alias("Max"), F.avg(value).alias("Mean"), F.min(value).alias("Min"),
            F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("StdDev"), F.sum(value).alias("Sum")]


def summarise_histogram(df: DataFrame, keys: list[str], value: str = "value",
                        exact: bool = True) -> DataFrame:
    """Count, Max, Mean, Min, StdDev, Sum and four percentiles.

    A key with one observation has StdDev 0. The percentiles are exact; with ``exact=False``
    they come from bounded sketches in one pass, within 1/10000 of the rank.
    """
    rows = df.filter(F.col(value).isNotNull())
    basics = [F.count(value).cast("double").alias("Count"), *_moments(value)]
    if not exact:
        return rows.groupBy(*keys).agg(*basics, *approximate_percentiles(PERCENTILES, value))
    percentiles = exact_percentiles(rows, keys, value, PERCENTILES).drop("n")
    # a struct is null-safe as a join key
    basic = rows.groupBy(F.struct(*keys).alias("_key")).agg(*basics)
    percentiles = percentiles.select(F.struct(*keys).alias("_key"), *PERCENTILES)
    return basic.join(percentiles, "_key").select(
        "_key.*", *[c for c in basic.columns if c != "_key"], *PERCENTILES)


def _tick_counts(df: DataFrame, keys: list[str], ts: str, until: str, tick_seconds: int) -> DataFrame:
    """Observations per key and completed tick before ``until``."""
    last = F.floor(F.unix_seconds(F.lit(until).cast("timestamp")) / tick_seconds).cast("bigint")
    tick = floor_div(F.unix_micros(F.col(ts)), tick_seconds * 1_000_000)
    rows = df.withColumn("_tick", tick).filter(F.col("_tick") < last)
    return rows.groupBy(*keys, "_tick").agg(F.count("*").alias("_n"))


def decay(minutes: float, tick_seconds: float) -> float:
    """What one tick leaves of a rate: 1 - alpha."""
    return math.exp(-tick_seconds / (60 * minutes))


def _meter_columns(until: str, tick_seconds: int, minutes: dict[str, float]) -> list[Column]:
    """Aggregates over tick counts. The moving rate is a sum in which a tick that lies k ticks
    back weighs alpha * (1 - alpha)^k, except the first one, which sets the rate: it weighs
    (1 - alpha)^k. So a rate is an ordinary sum, and no list of ticks is ever gathered."""
    last = F.floor(F.unix_seconds(F.lit(until).cast("timestamp")) / tick_seconds) - 1
    count = F.sum("_n")
    first = F.min("_tick")
    seconds = (last + 1 - first) * tick_seconds
    columns = [count.cast("double").alias("Count"), (count / seconds).alias("MeanRate")]
    for name, m in minutes.items():
        keep = decay(m, tick_seconds)
        recent = F.sum((1 - keep) * F.col("_n") * F.pow(F.lit(keep), last - F.col("_tick")))
        started = keep * F.min_by("_n", "_tick") * F.pow(F.lit(keep), last - first)
        columns.append(((recent + started) / tick_seconds).alias(name))
    return columns


def summarise_meter(df: DataFrame, keys: list[str], until: str, ts: str = "ts",
                    tick_seconds: int = TICK_SECONDS,
                    minutes: dict[str, float] = RATE_MINUTES) -> DataFrame:
    """Count, mean rate and moving rates per second, as read at ``until``.

    A meter starts with the tick of its first observation.
    """
    ticks = _tick_counts(df, keys, ts, until, tick_seconds)
    return ticks.groupBy(*keys).agg(*_meter_columns(until, tick_seconds, minutes))


def summarise_timer(df: DataFrame, keys: list[str], until: str, value: str = "value",
                    ts: str = "ts", tick_seconds: int = TICK_SECONDS,
                    minutes: dict[str, float] = RATE_MINUTES) -> DataFrame:
    """A meter and Max, Mean, Min, StdDev and Sum of the values; a timer has no percentiles."""
    last = F.floor(F.unix_seconds(F.lit(until).cast("timestamp")) / tick_seconds) * tick_seconds
    rows = df.filter(F.unix_micros(F.col(ts)) < last * 1_000_000)
    meter = summarise_meter(df, keys, until, ts, tick_seconds, minutes)
    values = rows.groupBy(F.struct(*keys).alias("_key")).agg(*_moments(value))
    rates = [c for c in meter.columns if c not in keys]
    meter = meter.select(F.struct(*keys).alias("_key"), *rates)
    return meter.join(values, "_key").select("_key.*", *rates, "Max", "Mean", "Min", "StdDev", "Sum")


def ewma_rate(df: DataFrame, keys: list[str], until: str, report_seconds: int, ts: str = "ts",
              tick_seconds: int = TICK_SECONDS,
              minutes: dict[str, float] = RATE_MINUTES) -> DataFrame:
    """The moving rates of each key at the end of every report interval, from its first one on.

    A rate after an interval is A * (rate before) + b, with b a sum over the interval's ticks.
    Intervals are composed in blocks: within a block as a running sum scaled by powers of A (a
    block is short enough for these to stay in range), and from block to block by the few blocks
    before that still count. A block spans about ten hours times the shortest rate's minutes.
    """
    per_report = report_seconds // tick_seconds
    if per_report * tick_seconds != report_seconds:
        raise ValueError("a report interval must be a whole number of ticks")
    names = list(minutes)
    keep = {name: decay(m, tick_seconds) for name, m in minutes.items()}
    fade = {name: keep[name] ** per_report for name in names}
    fastest = per_report * tick_seconds / (60 * min(minutes.values()))
    block = max(1, min(4096, int(575 / fastest)))

    ticks = _tick_counts(df, keys, ts, until, tick_seconds)
    place = F.col("_tick") - F.col("_report") * per_report
    reports = ticks.withColumn("_report", floor_div(F.col("_tick"), per_report)).groupBy(
        *keys, "_report").agg(
            F.min("_tick").alias("_first"), F.min_by("_n", "_tick").alias("_first_n"),
            *[F.sum((1 - keep[n]) / tick_seconds * F.col("_n")
                    * F.pow(F.lit(keep[n]), per_report - 1 - place)).alias(f"_b_{n}")
              for n in names])
    end = F.floor(F.unix_seconds(F.lit(until).cast("timestamp")) / report_seconds).cast("bigint")

    # one row per key and interval, silent ones too: each interval adds those up to the next. A
    # key has at most one row per interval here, however many observations it had; what follows is
    # dealt to tasks by key and block
    by_key = Window.partitionBy(*keys).orderBy("_report")
    first_place = F.col("_first") - F.col("_report") * per_report
    starts = F.lag("_report").over(by_key).isNull()
    inputs = [(F.col(f"_b_{n}") + F.when(
        starts, keep[n] * F.col("_first_n") / tick_seconds
        * F.pow(F.lit(keep[n]), per_report - 1 - first_place)).otherwise(0.0)).alias(n) for n in names]
    rows = reports.filter(F.col("_report") < end).select(
        *keys, "_report", (F.coalesce(F.lead("_report").over(by_key), end) - 1).alias("_until"), *inputs)
    rows = explode_in_chunks(rows, keys, "_report", "_until", "_at_report", block)
    here = F.col("_at_report") == F.col("_report")
    dense = rows.select(
        *keys, F.col("_at_report").alias("_report"), F.col("_chunk").alias("_block"),
        *[F.when(here, F.col(n)).otherwise(0.0).alias(n) for n in names])

    # within a block: sum of b_i * A^(j-i), written as A^j * sum of b_i * A^-i
    at = F.col("_report") - F.col("_block") * block
    running = Window.partitionBy(*keys, "_block").orderBy("_report")

    def scaled(n: str) -> Column:
        if block == 1:
            return F.col(n)
        return F.sum(F.col(n) * F.pow(F.lit(fade[n]), -at)).over(running) * F.pow(F.lit(fade[n]), at)

    inside = dense.select("*", at.alias("_at"), *[scaled(n).alias(f"_in_{n}") for n in names])
    ends = inside.groupBy(*keys, "_block").agg(
        F.max("_at").alias("_last"),
        *[F.max_by(f"_in_{n}", "_at").alias(n) for n in names])

    # from block to block: a block's end fades by the intervals of those after it. Blocks are whole but for a
    # key's first and last, and what came ``reach`` blocks before is below the precision of a double
    slowest = per_report * tick_seconds / (60 * max(minutes.values()))
    reach = 1 + math.ceil(40 / (slowest * block))
    by_key = Window.partitionBy(*keys).orderBy("_block")  # one row for each block
    carried = ends.select(*keys, "_block", *[
        reduce(add, [F.coalesce(F.lag(n, j).over(by_key), F.lit(0.0)) * fade[n] ** (block * (j - 1))
                     for j in range(1, reach + 1)]).alias(f"_before_{n}") for n in names])
    joined = join_series(inside, carried, keys, ["_block"])
    return joined.select(
        *keys, F.timestamp_seconds((F.col("_report") + 1) * report_seconds).alias("at"),
        *[(F.col(f"_in_{n}") + F.col(f"_before_{n}") * F.pow(F.lit(fade[n]), F.col("_at") + 1)).alias(n)
          for n in names])


def as_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """Summary columns as a map of fields."""
    others = [c for c in df.columns if c not in names]
    pairs = [x for n in names for x in (F.lit(n), F.col(n))]
    return df.select(*others, F.map_filter(F.create_map(*pairs), lambda _k, v: v.isNotNull())
                     .alias("fields"))
