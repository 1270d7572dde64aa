"""The one record type, and the identity of a series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAGS = T.MapType(T.StringType(), T.StringType())
FIELDS = T.MapType(T.StringType(), T.DoubleType())

MEASUREMENT = T.StructType([
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("tags", TAGS, False),
    T.StructField("fields", FIELDS, False),
])

TOPIC_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

MEASUREMENT_COLUMNS = [f.name for f in MEASUREMENT.fields]


def tag_entries(tags: Column | str = "tags") -> Column:
    """Tags as a sorted list of pairs: a map can be neither hashed nor joined on, this can."""
    return F.sort_array(F.map_entries(tags))


def series_key(name: Column | str = "name", tags: Column | str = "tags") -> Column:
    """Identity of a series: its name and its whole tag set, whatever the map order."""
    name = F.col(name) if isinstance(name, str) else name
    return F.struct(name.alias("name"), tag_entries(tags).alias("tags"))


def series_hash(name: Column | str = "name", tags: Column | str = "tags") -> Column:
    return F.xxhash64(name, tag_entries(tags))
