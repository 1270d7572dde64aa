"""Time-bucketed aggregates by tag, and what is done to their result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.tags import group_tag, tag
from pulsegrid.functions.values import floor_div
from pulsegrid.operators.quantiles import exact_percentiles
from pulsegrid.operators.skew import explode_in_chunks, join_series, with_next


def time_bucket(width: int, ts: str = "ts") -> Column:
    """Start of the bucket of ``width`` seconds that a timestamp falls into, counted from 1970."""
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width * 1_000_000)))


def aggregate(how: str, value: str, ts: str) -> Column:
    """An aggregate of a panel by its name."""
    if how == "last":
        # of points at the same time the greatest value counts
        return F.max(F.when(F.col(value).isNotNull(), F.struct(ts, value)))[value]
    return {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "count": F.count}[how](value)


def bucket_agg(df: DataFrame, width: int, keys: list[str], aggregates: dict[str, tuple[str, str]],
               ts: str = "ts") -> DataFrame:
    """One row per bucket and keys. ``aggregates``: column name to (how, value column).

    How: sum, mean, max, min, count, last or median. All but median are partial aggregates, so
    neither a hot key nor a hot bucket is ever gathered; a median takes ranks of counted values
    instead, and the extremes of the same column are then ranks too.
    """
    rows = df.withColumn("bucket", time_bucket(width, ts))
    by = ["bucket", *keys]
    ranked: dict[str, dict[str, float]] = {
        value: {} for how, value in aggregates.values() if how == "median"}
    plain = []
    for name, (how, value) in aggregates.items():
        place = {"min": 0.0, "median": 0.5, "max": 1.0}.get(how)
        if value in ranked and place is not None:
            ranked[value][name] = place
        else:
            plain.append(aggregate(how, value, ts).alias(name))
    result = rows.groupBy(*by).agg(*plain) if plain or not ranked else None
    for value, quantiles in ranked.items():
        found = exact_percentiles(rows, by, value, quantiles).drop("n")
        result = found if result is None else join_series(result, found, keys, ["bucket"], "left")
    return result.select(*by, *aggregates)


def fill_null(bucketed: DataFrame, start: str, end: str, width: int, keys: list[str]) -> DataFrame:
    """A row for every bucket of the range, for each series that has any; empty ones are null.

    Every bucket that is there adds the empty ones up to the next (the first one also those
    before it), so the input is read once. A series has at most one row per bucket here,
    however many measurements it had; what it is filled with is dealt to tasks by chunks of time.
    """
    first, last = (F.lit(t).cast("timestamp") for t in (start, end))
    begin = floor_div(F.unix_seconds(first), width)
    # the last bucket is the one that holds the moment before the end
    stop = floor_div(F.unix_micros(last) - 1, width * 1_000_000)
    index = floor_div(F.unix_seconds("bucket"), width)
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_i")
    rows = (bucketed.withColumn("_i", index)
            .withColumn("_before", F.lag("_i").over(order))
            .withColumn("_after", F.coalesce(F.lead("_i").over(order), stop + 1)))
    rows = rows.withColumns({
        "_low": F.when(F.col("_before").isNull(), F.least(begin, F.col("_i"))).otherwise(F.col("_i")),
        "_high": F.greatest(F.col("_after") - 1, F.col("_i"))})
    rows = explode_in_chunks(rows, keys, "_low", "_high", "_at")
    here = F.col("_at") == F.col("_i")
    return rows.select(*[
        F.timestamp_seconds(F.col("_at") * width).alias(c) if c == "bucket"
        else F.col(c) if c in keys else F.when(here, F.col(c)).alias(c) for c in bucketed.columns])


def connect_nulls(bucketed: DataFrame, keys: list[str], value: str, width: int) -> DataFrame:
    """Fill null buckets between two known ones on the straight line through them."""
    index = floor_div(F.unix_seconds("bucket"), width)
    known = (bucketed.filter(F.col(value).isNotNull())
             .select(*keys, index.alias("_i"), F.col(value).alias("_v")))
    gaps = with_next(known, keys, "_i", ["_v"]).filter(F.col("next__i") > F.col("_i") + 1)
    step = (F.col("next__v") - F.col("_v")) / (F.col("next__i") - F.col("_i"))
    gaps = gaps.withColumns({"_low": F.col("_i") + 1, "_high": F.col("next__i") - 1})
    line = (explode_in_chunks(gaps, keys, "_low", "_high", "_at")
            .select(*keys, F.timestamp_seconds(F.col("_at") * width).alias("bucket"),
                    (F.col("_v") + step * (F.col("_at") - F.col("_i"))).alias("_line")))
    return (join_series(bucketed, line, keys, ["bucket"], "left")
            .withColumn(value, F.coalesce(value, "_line")).select(*bucketed.columns))


def series_reduce(bucketed: DataFrame, keys: list[str], value: str, how: str) -> DataFrame:
    """One number per series: ``current`` (its last value that is not null) or ``avg``."""
    if how == "current":
        number = F.max(F.when(F.col(value).isNotNull(), F.struct("bucket", value)))[value]
    else:
        number = F.avg(value)
    return bucketed.groupBy(*keys).agg(number.alias(value))


def unpivot_aggregates(bucketed: DataFrame, keys: list[str], aggregates: list[str]) -> DataFrame:
    """Several aggregates of one query as rows labelled by ``col``."""
    return bucketed.unpivot(["bucket", *keys], aggregates, "col", "value")


def threshold_level(value: Column | str, warn: float, critical: float) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value >= critical, "critical").when(value >= warn, "warn").otherwise("ok")


def count_members(df: DataFrame, key: str = "service") -> DataFrame:
    """How many values a tag has."""
    return df.agg(F.count_distinct(tag(df, key)).alias("members"))


def tag_values(df: DataFrame, key: str, all_value: str = ".+") -> DataFrame:
    """Options of a panel variable: the values of a tag, and ``All``, which stands for any."""
    values = df.select(tag(df, key).alias("value")).filter(F.col("value").isNotNull()).distinct()
    options = values.select(F.col("value").alias("text"), "value")
    every = df.sparkSession.range(1).select(F.lit("All").alias("text"), F.lit(all_value).alias("value"))
    return options.unionByName(every)


def series_columns(df: DataFrame, keys: list[str]) -> list[Column]:
    return [group_tag(df, k).alias(k) for k in keys]


def cumulative(bucketed: DataFrame, keys: list[str], value: str, total: str,
               chunk_width: int) -> DataFrame:
    """Running total over the buckets of each series, in chunks of ``chunk_width`` seconds."""
    rows = bucketed.withColumn("_chunk", time_bucket(chunk_width, "bucket"))
    chunks = rows.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_chunk")
                                .rowsBetween(Window.unboundedPreceding, -1))
    chunks = chunks.select(*keys, "_chunk", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum(value).over(Window.partitionBy(*keys, "_chunk").orderBy("bucket"))
    return (join_series(rows.withColumn("_inside", inside), chunks, keys, ["_chunk"])
            .withColumn(total, F.col("_before") + F.col("_inside"))
            .select(*bucketed.columns, total))
