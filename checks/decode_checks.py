"""Binary and JSON records, the envelope, and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.roles import MEASUREMENTS_SQL, events, json_text, measurements
from pulsegrid.operators.pack import long_fields
from pulsegrid.sources.codec import decode_avro_v1, encode_avro_v1
from pulsegrid.sources.envelope import (
    decode_envelope, measurement_to_struct, split_rejects, struct_to_measurement)
from pulsegrid.sources.snapshot_json import explode_snapshot_json
from pulsegrid.sources.text import format_measurements


def _records(spark, sf_dir):
    """Topic records of all kinds: binary, JSON, of a schema registry, unknown."""
    rows = measurements(spark, sf_dir, "event_id", "event_type", "user_id", "value", "props")
    rows = encode_avro_v1(rows, "binary")
    value = (F.when(F.col("event_type").isin("view", "click"), F.col("binary"))
             .when(F.col("event_type").isin("signup", "error"), json_text().cast("binary"))
             .when(F.col("event_id") % 2 == 0, F.concat(F.unhex(F.lit("00")), F.col("props").cast("binary")))
             .otherwise(F.concat(F.lit("x"), F.col("props")).cast("binary")))
    return rows.select("event_id", value.alias("value"))


_DECODED_SQL = f"""
    WITH {MEASUREMENTS_SQL}, e AS (SELECT m.*, user_id, event_type, event_id % 7 AS k,
        CAST(json_extract(props, '$.k') AS DOUBLE) AS kv FROM m JOIN events USING (event_id)),
    rows AS (
      SELECT event_id, ts, name, service, CAST(NULL AS VARCHAR) AS job, CAST(NULL AS VARCHAR) AS system,
        'Value' AS field, e.value
        FROM e WHERE event_type IN ('view', 'click')
      UNION ALL SELECT event_id, ts, name, service, NULL, NULL, 'OneMinuteRate', value / 60
        FROM e WHERE event_type IN ('view', 'click')
      UNION ALL SELECT event_id, ts, 'org.apache.samza.m', NULL, 'j' || user_id,
        CASE WHEN k < 3 THEN 'sys' WHEN k = 5 THEN 'commit' END,
        ['buffered-count', 'messages-behind', 'bytes-read', 'sends', 'restore-time', 'calls', 'window_ns'][k + 1], value
        FROM e WHERE event_type = 'signup'
      UNION ALL SELECT event_id, ts, 'org.apache.samza.m', NULL, 'j' || user_id, NULL, 'k', kv FROM e WHERE event_type = 'signup')
"""


@query("d01_decode_envelope", f"{_DECODED_SQL} SELECT * FROM rows")
def envelope(spark, sf_dir):
    good, _bad = split_rejects(decode_envelope(_records(spark, sf_dir)))
    rows = long_fields(good).filter(~F.col("field").rlike("Percentile"))
    return rows.select("event_id", "ts", "name",
                       *[F.col("tags")[t].alias(t) for t in ("service", "job", "system")], "field", "value")


@query("r05_split_rejects", """
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'schema registry records are not supported'
      ELSE 'magic byte not recognized: 78' END AS error
    FROM events WHERE event_type = 'purchase'""")
def rejects(spark, sf_dir):
    _good, bad = split_rejects(decode_envelope(_records(spark, sf_dir)))
    return bad


@query("d02_decode_avro_v1", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT event_id, epoch_ms(ts) AS ms, name, grp AS "group", service, topic, dash,
      CASE WHEN topic IS NULL THEN 3 ELSE 4 END AS tags, value, value / 60 AS rate, value * 2 AS high, 6 AS fields,
      CAST(NULL AS VARCHAR) AS error
    FROM m""")
def decoded(spark, sf_dir):
    rows = encode_avro_v1(measurements(spark, sf_dir, "event_id"))
    rows = rows.select("event_id", decode_avro_v1("value").alias("d"))
    tags, fields = F.col("d.tags"), F.col("d.fields")
    return rows.select(
        "event_id", "d.ms", "d.name", tags["group"].alias("group"), tags["service"].alias("service"),
        tags["topic"].alias("topic"), tags["name"].alias("dash"), F.size(tags).alias("tags"),
        fields["Value"].alias("value"), fields["OneMinuteRate"].alias("rate"),
        fields["999thPercentile"].alias("high"), F.size(fields).alias("fields"), "d.error")


@query("d03_encode_avro_v1", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT event_id, '0101' AS head, CAST(2 + 6 + (1 + length(name))
      + 1 + (5 + length(dash) + 1) + (6 + length(grp) + 1) + (8 + length(service) + 1)
      + coalesce(6 + length(topic) + 1, 0) + 1
      + 1 + (1 + 5 + 8) + (1 + 13 + 8) + 3 * (1 + 14 + 8) + (1 + 15 + 8) + 1 AS INTEGER) AS bytes
    FROM m""")
def encoded(spark, sf_dir):
    rows = encode_avro_v1(measurements(spark, sf_dir, "event_id"))
    return rows.select("event_id", F.hex(F.substring("value", 1, 2)).alias("head"),
                       F.octet_length("value").alias("bytes"))


@query("d04_explode_snapshot_json", f"""
    WITH {MEASUREMENTS_SQL}, e AS (SELECT event_id, ts, user_id, event_id % 7 AS k, events.value,
        CAST(json_extract(props, '$.k') AS DOUBLE) AS kv
      FROM events JOIN (SELECT event_id, ts AS ms FROM m) USING (event_id), (SELECT 1) WHERE event_type <> 'error')
    SELECT event_id, 'org.apache.samza.m' AS name, 'j' || user_id AS job, '1.0' AS version, CAST(NULL AS VARCHAR) AS count,
      CASE WHEN k < 3 THEN 'sys' WHEN k = 5 THEN 'commit' END AS system,
      CASE WHEN k < 2 THEN 'topic' END AS topic, ['5', '10', NULL, '4', '4', NULL, NULL][k + 1] AS "partition",
      CASE WHEN k = 6 THEN 2 ELSE 1 END AS fields, value AS first, CASE WHEN k = 6 THEN kv END AS k
    FROM e
    UNION ALL SELECT event_id, 'org.apache.samza.m', 'j' || user_id, '1.0', NULL, NULL, NULL, NULL, 1, NULL, kv
    FROM e WHERE k <> 6""")
def snapshot_json(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("text", json_text()).select("event_id", "text")
    df = explode_snapshot_json(rows, "text")
    tags, fields = F.col("tags"), F.col("fields")
    named = F.map_values(F.map_filter("fields", lambda k, _v: k != "k"))
    return df.select(
        "event_id", "name", tags["job"].alias("job"), tags["samza-version"].alias("version"),
        tags["count"].alias("count"), tags["system"].alias("system"), tags["topic"].alias("topic"),
        tags["partition"].alias("partition"), F.size("fields").alias("fields"),
        F.get(named, 0).alias("first"), fields["k"].alias("k"))


@query("d06_struct_round_trip", f"""
    WITH {MEASUREMENTS_SQL} SELECT event_id, epoch_ms(ts) AS ms, ts, name, service, value FROM m
    WHERE name <> 'RequestsPerSec'""")
def structs(spark, sf_dir):
    packed = measurement_to_struct(measurements(spark, sf_dir, "event_id"))
    packed = packed.withColumn("measurement", F.when(
        F.col("measurement.name") != "RequestsPerSec", F.col("measurement")))
    ms = packed.select("event_id", F.col("measurement.timestamp").alias("ms"), "measurement")
    return struct_to_measurement(ms).select(
        "event_id", "ms", "ts", "name", F.col("tags")["service"].alias("service"),
        F.col("fields")["Value"].alias("value"))


@query("s07_format_measurements", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT name || ',group=' || grp || ',name=main,service=' || service || coalesce(',topic=' || topic, '')
      || strftime(ts, ' [%d/%m/%Y AD at %H:%M:%S UTC] ') || chr(10)
      || 'Value=' || CAST(value AS VARCHAR) || chr(9) || 'Zero=0.0' || chr(9) || chr(10) || chr(10) AS value
    FROM m""")
def formatted(spark, sf_dir):
    df = measurements(spark, sf_dir, "value").withColumn(
        "fields", F.create_map(F.lit("Zero"), F.lit(0.0), F.lit("Value"), F.col("value"))).drop("value")
    return format_measurements(df)
