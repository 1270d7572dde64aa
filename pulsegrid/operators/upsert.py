"""Last write wins: points, latest rows, values carried forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.values import floor_div, truncate_millis
from pulsegrid.operators.pack import long_fields, pack_fields
from pulsegrid.operators.skew import explode_in_chunks, with_next


def upsert_points(df: DataFrame, order: Column | str) -> DataFrame:
    """One row per point (name, tags, ts in ms): its fields merged, the last write of each kept.

    ``order`` ranks the writes. Applying it twice, or to shuffled input, changes nothing.
    """
    rows = df.withColumn("ts", truncate_millis(F.col("ts"))).withColumn(
        "_order", F.col(order) if isinstance(order, str) else order)
    rows = long_fields(rows.select("ts", "name", "tags", "fields", "_order"))
    return pack_fields(rows, ["ts", "name"], order="_order").select("ts", "name", "tags", "fields")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, by ``order`` and then by the other columns."""
    others = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *others)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col(f"_newest.{c}").alias(c) for c in df.columns])


def carry_forward(updates: DataFrame, keys: list[str], value: str, until: str, width: int,
                  ts: str = "ts", expire: int | None = None) -> DataFrame:
    """The value of each key at every tick, from its first update up to ``until`` (exclusive).

    A tick shows the last update at or before it. A value stays until it is overwritten, or for
    ``expire`` seconds if given.
    """
    micros = width * 1_000_000
    tick = floor_div(F.unix_micros(F.col(ts)) + (micros - 1), micros)
    end = F.floor((F.unix_seconds(F.lit(until).cast("timestamp")) - 1) / width) + 1
    newest = F.max(F.struct(F.col(ts), F.col(value))).alias("_newest")
    set_at = (updates.withColumn("_tick", tick).groupBy(*keys, "_tick").agg(newest)
              .select(*keys, "_tick", F.col(f"_newest.{value}").alias(value)))
    held = with_next(set_at, keys, "_tick", [])
    stop = F.coalesce(F.col("next__tick"), end)
    if expire is not None:
        stop = F.least(stop, F.col("_tick") + -(-expire // width))
    stop = F.least(stop, end)
    shown = held.withColumn("_last", stop - 1).filter(F.col("_last") >= F.col("_tick"))
    return explode_in_chunks(shown, keys, "_tick", "_last", "_at").select(
        *keys, F.timestamp_seconds(F.col("_at") * width).alias("tick"), value)
