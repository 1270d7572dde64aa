"""Group single field values into measurements, and take measurements apart again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.schema import tag_entries


def pack_fields(df: DataFrame, keys: list[str], field: str = "field", value: str = "value",
                order: Column | str | None = None, tags: str = "tags") -> DataFrame:
    """Rows (keys, tags, field, value) to one row per keys and tags with a map of fields.

    Of a repeated field the value that is last by ``order`` counts (the greatest one without an
    order, or among equals). Copies are reduced before the shuffle, so a field repeated very
    often costs nothing; what is collected per measurement is one value per field name.
    """
    rank = F.lit(0) if order is None else (F.col(order) if isinstance(order, str) else order)
    newest = F.max(F.struct(rank.alias("order"), F.col(value).alias("value")))
    single = (df.withColumn("_tags", tag_entries(tags))
              .groupBy(*keys, "_tags", F.col(field).alias("_field")).agg(newest.alias("_newest")))
    packed = single.groupBy(*keys, "_tags").agg(
        F.map_from_entries(F.collect_list(F.struct("_field", "_newest.value"))).alias("fields"))
    return packed.withColumn(tags, F.map_from_entries("_tags")).drop("_tags")


def drop_empty(df: DataFrame) -> DataFrame:
    """Measurements with at least one field."""
    return df.filter(F.size("fields") > 0)


def long_fields(df: DataFrame) -> DataFrame:
    """One row (field, value) per field of a measurement."""
    others = [c for c in df.columns if c != "fields"]
    return df.select(*others, F.explode("fields").alias("field", "value"))


def wide_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """The named fields as columns, null where a measurement lacks one."""
    others = [c for c in df.columns if c != "fields"]
    return df.select(*others, *[F.col("fields")[f].alias(f) for f in fields])
