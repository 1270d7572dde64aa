"""Decode topic records of either form, and keep those that cannot be decoded apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.schema import MEASUREMENT_COLUMNS, tag_entries
from pulsegrid.sources.codec import decode_avro_v1, encode_avro_v1
from pulsegrid.sources.snapshot_json import (
    explode_parsed, parse_snapshot, run_fields, run_tags, snapshot_error)


def envelope_kind(value: Column | str = "value") -> Column:
    """Which decoder a record needs, from its first byte."""
    first = F.hex(F.substring(value, 1, 1))
    return (F.when(first == "01", "avro").when(first == "7B", "json")
            .when(first == "00", "registry").otherwise("unknown"))


def decode_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Topic records to measurements, with the other columns kept.

    Gives the columns of a measurement and ``error``. A record that cannot be decoded gives one
    row with the error set; a JSON record gives as many rows as it has measurements. A null
    record gives none. The input is read once and nothing is shuffled.
    """
    others = [c for c in df.columns if c != value]
    kind = F.col("_kind")
    rows = df.filter(F.col(value).isNotNull()).withColumn("_kind", envelope_kind(value))
    rows = rows.withColumn("_binary", decode_avro_v1(F.when(kind == "avro", F.col(value))))
    rows = rows.withColumn("_text", F.when(kind == "json", F.col(value).cast("string")))
    rows = parse_snapshot(rows, "_text")
    unknown = F.concat(F.lit("magic byte not recognized: "),
                       F.coalesce(F.hex(F.substring(value, 1, 1)), F.lit("")))
    rows = rows.withColumn("error", F.when(kind == "avro", F.col("_binary.error"))
                           .when(kind == "json", snapshot_error())
                           .when(kind == "registry", "schema registry records are not supported")
                           .otherwise(unknown))
    # rows pass through a generator here: a filter on the error is not moved before it, which
    # would decode every record a second time
    parsed = ["_kind", "_binary", "_header", "_metrics", "error"]
    rows = rows.select(*others, F.explode(F.array(F.struct(*parsed))).alias("_parsed"))
    rows = explode_parsed(rows.select(*others, *[f"_parsed.{c}" for c in parsed]))
    rows = rows.filter((kind != "json") | F.col("error").isNotNull() | F.col("_run").isNotNull())

    def pick(binary: Column, json: Column) -> Column:
        return F.when(kind == "avro", binary).when(kind == "json", json)

    return rows.select(
        *others,
        pick(F.timestamp_millis("_binary.ms"), F.col("_ts")).alias("ts"),
        pick(F.col("_binary.name"), F.col("_group")).alias("name"),
        pick(F.col("_binary.tags"), run_tags()).alias("tags"),
        pick(F.col("_binary.fields"), run_fields()).alias("fields"),
        "error")


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Measurements, and records that failed, so that one bad record does not stop the rest.

    Records that failed keep their ``payload``, if decoding was given one, to be read again later.
    """
    return (decoded.filter(F.col("error").isNull()).drop("error", "payload"),
            decoded.filter(F.col("error").isNotNull()).drop(*MEASUREMENT_COLUMNS))


def struct_to_measurement(df: DataFrame, struct: str = "measurement") -> DataFrame:
    """A struct (timestamp in ms, name, tags, fields) as measurement columns; null gives no row."""
    return df.filter(F.col(struct).isNotNull()).select(
        *[c for c in df.columns if c != struct],
        F.timestamp_millis(f"{struct}.timestamp").alias("ts"),
        *[F.col(f"{struct}.{c}").alias(c) for c in ("name", "tags", "fields")])


def measurement_to_struct(df: DataFrame, struct: str = "measurement") -> DataFrame:
    """Measurement columns as one struct (timestamp in ms, name, tags, fields)."""
    packed = F.struct(F.unix_millis("ts").alias("timestamp"), "name", "tags", "fields")
    return df.withColumn(struct, packed).drop(*MEASUREMENT_COLUMNS)


def to_topic_records(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Measurements as key and value of a topic: the key is the series, as four bytes."""
    number = F.hash("name", tag_entries("tags"))
    key = F.unhex(F.right(F.lpad(F.hex(number), F.lit(16), F.lit("0")), F.lit(8)))
    return encode_avro_v1(df, "value").select(key.alias("key"), "value", *(keep or []))
