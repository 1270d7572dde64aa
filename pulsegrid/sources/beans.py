"""Captured attributes of management beans as measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.tags import literal_map, overlay_map, scope_match
from pulsegrid.functions.values import any_to_double
from pulsegrid.operators.pack import pack_fields
from pulsegrid.schema import TAGS

# The only field of an attribute that is a measurement of its own.
SINGLE_FIELD = "Value"
NAME_KEY = "name"


def bean_value(df: DataFrame) -> Column:
    """The attribute as a double: from ``value_double``, else ``value_long``; text gives null."""
    return F.coalesce(any_to_double(df, "value_double"), any_to_double(df, "value_long"))


def bean_tags(fixed_tags: dict[str, str], named: Column) -> Column:
    """Fixed tags, then the domain as ``group``, then key properties; the later win.

    The key property ``name`` is no tag of a bean that is named by it. As key properties come
    last, a bean may replace ``group`` by one of its own.
    """
    properties = F.when(named, F.map_filter("key_props", lambda k, _v: k != NAME_KEY)).otherwise(
        F.col("key_props")).cast(TAGS)
    group = F.create_map(F.lit("group"), F.col("domain"))
    return overlay_map(overlay_map(literal_map(fixed_tags), group), properties)


def mbean_to_measurements(attrs: DataFrame, fixed_tags: dict[str, str] | None = None,
                          scope: str = "*:*") -> DataFrame:
    """Rows (scan_ts, address, domain, key_props, attr, value_*) to measurements.

    A bean with a key property ``name`` is one measurement of that name with all its numeric
    attributes as fields. Any other bean gives one measurement per numeric attribute, named by
    it. Attributes that are no finite number are left out, and so are beans without any.
    Both kinds share one pass over the attributes; ``address`` is kept.
    """
    named = F.col("key_props")[NAME_KEY].isNotNull()
    rows = (attrs.filter(scope_match(scope)).withColumn("_value", bean_value(attrs))
            .filter(F.col("_value").isNotNull())
            .select(F.col("scan_ts").alias("ts"), "address",
                    F.coalesce(F.col("key_props")[NAME_KEY], F.col("attr")).alias("name"),
                    bean_tags(fixed_tags or {}, named).alias("tags"),
                    F.when(named, F.col("attr")).otherwise(SINGLE_FIELD).alias("field"),
                    F.col("_value").alias("value")))
    return pack_fields(rows, ["ts", "address", "name"]).select("ts", "address", "name", "tags", "fields")


def pack_bean(attrs: DataFrame) -> DataFrame:
    """All numeric attributes of each bean as one map, without naming or tagging it."""
    rows = attrs.withColumn("value", bean_value(attrs)).filter(F.col("value").isNotNull())
    rows = rows.select("scan_ts", "address", "domain", F.col("key_props").alias("tags"),
                       F.col("attr").alias("field"), "value")
    return pack_fields(rows, ["scan_ts", "address", "domain"]).withColumnRenamed("tags", "key_props")
