"""Topic, stored points, archive, dashboard, and the streaming jobs.

Each query writes what it reads back below the shared folder of the session.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.panel_checks import ASKED, NUMBER_SQL, SERIES_SQL
from checks.registry import query
from checks.roles import HOUR, MEASUREMENTS_SQL, events, in_files, json_text, measurements, panel_input, table
from pulsegrid.operators import buckets
from pulsegrid.operators.pack import long_fields
from pulsegrid.plans.dashboard import bundle_dashboard, cluster_dashboard
from pulsegrid.plans.panels import PANELS, evaluate_sketches, evaluate_store
from pulsegrid.schema import TOPIC_RECORD, series_hash
from pulsegrid.session import work_dir
from pulsegrid.sources.envelope import decode_envelope
from pulsegrid.sources.points import compact_points, read_points, stored_points, write_archive, write_points
from pulsegrid.sources.topic import order_by_series, read_topic, write_files, write_topic
from pulsegrid.streaming.jobs import (
    drop_redelivered, keep_panel_numbers, load_topic_to_points, read_panel_numbers, store_stream, stream_panel,
    stream_panel_series, stream_sketches, tick_trigger, union_streams)

TOPIC = {"consumer.topic": "metrics", "consumer.auto.offset.reset": "earliest"}


def _topic(spark, sf_dir, label: str) -> str:
    """A topic as files: every event's measurement, and JSON snapshots of the clicks."""
    path = work_dir(spark, label)
    write_topic(measurements(spark, sf_dir), format="parquet", path=path)
    rows = events(spark, sf_dir).filter(F.col("event_type") == "click")
    (rows.select(F.lit(None).cast("binary").alias("key"), json_text().cast("binary").alias("value"),
                 F.lit("metrics").alias("topic"), F.lit(99).alias("partition"),
                 F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
     .write.mode("append").parquet(path))
    return path


def _records(spark, path: str):
    return spark.read.schema(TOPIC_RECORD).option("recursiveFileLookup", "true").parquet(path)


@query("s01_read_topic", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT name, count(*) AS n, round(sum(value), 3) AS total FROM m GROUP BY name
    UNION ALL SELECT 'org.apache.samza.m',
      2 * count(*) - count(*) FILTER (event_id % 7 = 6), round(sum(value), 3)
      FROM events WHERE event_type = 'click'""")
def read_from_topic(spark, sf_dir):
    path, out = _topic(spark, sf_dir, "s01-topic"), work_dir(spark, "s01-out")
    stream = decode_envelope(read_topic(spark, TOPIC, "parquet", path).select("value"))
    job = store_stream(stream.select("name", "fields"), f"{out}/rows", f"{out}/checkpoint", None)
    job.awaitTermination()
    measured = F.filter(F.map_entries("fields"), lambda e: ~e["key"].rlike("Rate|Percentile|^k$"))
    total = F.aggregate(measured, F.lit(0.0), lambda a, e: a + e["value"])
    rows = spark.read.schema("name string, fields map<string,double>").parquet(f"{out}/rows")
    return rows.groupBy("name").agg(F.count("*").alias("n"), F.round(F.sum(total), 3).alias("total"))


@query("s02_write_topic", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT name, service, coalesce(topic, '') AS topic, count(*) AS n, CAST(1 AS BIGINT) AS keys, CAST(1 AS BIGINT) AS partitions, 4 AS key_bytes
    FROM m GROUP BY ALL""")
def written_topic(spark, sf_dir):
    path = work_dir(spark, "s02-topic")
    write_topic(measurements(spark, sf_dir), format="parquet", path=path)
    rows = decode_envelope(_records(spark, path))
    tags = F.col("tags")
    return rows.groupBy("name", tags["service"].alias("service"),
                        F.coalesce(tags["topic"], F.lit("")).alias("topic")).agg(
        F.count("*").alias("n"), F.count_distinct("key").alias("keys"),
        F.count_distinct("partition").alias("partitions"), F.max(F.octet_length("key")).alias("key_bytes"))


@query("s02_three_appends", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT name, service, coalesce(topic, '') AS topic, 3 * count(*) AS n, round(3 * sum(value), 3) AS total,
      true AS placed_once, true AS goes_on FROM m GROUP BY ALL""")
def three_appends(spark, sf_dir):
    """Two writes of one writer and a stream of another, whose batch is tried again: no place is taken twice."""
    path, out = work_dir(spark, "s02a-topic"), work_dir(spark, "s02a")
    df = measurements(spark, sf_dir)
    write_topic(df, format="parquet", path=path)
    before = _records(spark, path).agg(F.max("offset")).first()[0]
    write_topic(df, format="parquet", path=path)
    df.write.parquet(f"{out}/rows")
    stream = spark.readStream.schema(df.schema).parquet(f"{out}/rows")
    job = write_topic(stream, format="parquet", path=path, checkpoint=f"{out}/checkpoint", trigger={"availableNow": True})
    job.awaitTermination()
    write_files(df, "metrics", "parquet", path, f"{job.id}-0")
    rows = decode_envelope(_records(spark, path))
    rows = rows.withColumn("place", F.struct(F.pmod(F.hash("key"), F.lit(16)), "offset"))
    tags = F.col("tags")
    return rows.groupBy("name", tags["service"].alias("service"), F.coalesce(tags["topic"], F.lit("")).alias("topic")).agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("fields")["Value"]), 3).alias("total"),
        (F.count_distinct("place") == F.count("*")).alias("placed_once"),
        (F.count_if(F.col("offset") > before) == 2 * F.count_if(F.col("offset") <= before)).alias("goes_on"))


_REWRITTEN_SQL = f"""
    WITH {MEASUREMENTS_SQL},
    writes AS (SELECT 0 AS batch, event_id, ts, name, service, topic, 'Value' AS field, value FROM m
      UNION ALL SELECT 0, event_id, ts, name, service, topic, 'OneMinuteRate', value / 60 FROM m
      UNION ALL SELECT 1, event_id, ts, name, service, topic, 'Value', value + 1000 FROM m WHERE value >= 50)
    SELECT ts, name, service, topic, field,
      arg_max(value, struct_pack(b := batch, e := event_id, v := value)) AS value
    FROM writes GROUP BY ALL"""


def _write_twice(spark, sf_dir, path: str) -> None:
    """All measurements, then a later batch that corrects some values. Both are written twice,
    as a retried batch would be."""
    df = measurements(spark, sf_dir, "event_id")
    first = df.withColumn("fields", F.map_filter("fields", lambda k, _v: k.isin("Value", "OneMinuteRate")))
    second = df.filter(F.col("fields")["Value"] >= 50).withColumn(
        "fields", F.create_map(F.lit("Value"), F.col("fields")["Value"] + 1000))
    for _attempt in range(2):
        write_points(first, path, 0, "event_id", writer="job")
        write_points(second, path, 1, "event_id", writer="job")


def _flat_points(df):
    return long_fields(df.select("ts", "name", "tags", "fields")).select(
        "ts", "name", F.col("tags")["service"].alias("service"), F.col("tags")["topic"].alias("topic"),
        "field", "value")


@query("s03_write_points", _REWRITTEN_SQL)
def stored(spark, sf_dir):
    path = work_dir(spark, "s03")
    _write_twice(spark, sf_dir, path)
    return _flat_points(read_points(spark, path))


@query("s03_compact_points", _REWRITTEN_SQL)
def compacted(spark, sf_dir):
    path, target = work_dir(spark, "s03c"), work_dir(spark, "s03c-target")
    _write_twice(spark, sf_dir, path)
    compact_points(spark, path, target)
    return _flat_points(read_points(spark, target))


_TWO_WRITERS_SQL = f"""
    WITH {MEASUREMENTS_SQL},
    writes AS (SELECT 0 AS made, event_id, ts, name, service, topic, 'Value' AS field, value FROM m
      UNION ALL SELECT 0, event_id, ts, name, service, topic, 'OneMinuteRate', value / 60 FROM m
      UNION ALL SELECT 1, event_id, ts, name, service, topic, 'Value', value + 1000 FROM m WHERE value >= 50)
    SELECT ts, name, service, topic, field,
      arg_max(value, struct_pack(b := made, e := event_id, v := value)) AS value
    FROM writes GROUP BY ALL"""


def _two_parts(spark, sf_dir):
    """All measurements with two fields, and later corrections of some values."""
    df = measurements(spark, sf_dir, "event_id")
    return (df.withColumn("fields", F.map_filter("fields", lambda k, _v: k.isin("Value", "OneMinuteRate"))),
            df.filter(F.col("fields")["Value"] >= 50).withColumn(
                "fields", F.create_map(F.lit("Value"), F.col("fields")["Value"] + 1000)))


@query("s03_two_writers", _TWO_WRITERS_SQL)
def two_writers(spark, sf_dir):
    """Two jobs that both count their batches from 0."""
    path = work_dir(spark, "s03w")
    first, second = _two_parts(spark, sf_dir)
    write_points(first, path, 0, "event_id", writer="scanner")
    write_points(second, path, 0, "event_id", writer="topic")
    return _flat_points(read_points(spark, path))


@query("s03_write_after_compaction", _TWO_WRITERS_SQL)
def written_after_compaction(spark, sf_dir):
    path, target = work_dir(spark, "s03x"), work_dir(spark, "s03x-target")
    first, second = _two_parts(spark, sf_dir)
    write_points(first, path, 0, "event_id")
    compact_points(spark, path, target)
    write_points(second, target, 0, "event_id")
    return _flat_points(read_points(spark, target))


@query("s03_default_writer", _TWO_WRITERS_SQL)
def default_writer(spark, sf_dir):
    """Two callers that name no writer, both with batch 0: neither erases the other."""
    path = work_dir(spark, "s03n")
    for part in _two_parts(spark, sf_dir):
        write_points(part, path, 0, "event_id")
    return _flat_points(read_points(spark, path))


@query("s03_write_before_compaction", _TWO_WRITERS_SQL)
def written_before_compaction(spark, sf_dir):
    """The target has newer values already when older ones are compacted into it, twice."""
    path, target = work_dir(spark, "s03b"), work_dir(spark, "s03b-target")
    first, second = _two_parts(spark, sf_dir)
    write_points(first, path, 0, "event_id")
    write_points(second, target, 0, "event_id")
    compact_points(spark, path, target)
    compact_points(spark, path, target)
    return _flat_points(read_points(spark, target))


@query("s03_compact_closed_days", f"""
    WITH {MEASUREMENTS_SQL},
    writes AS (SELECT 0 AS made, event_id, ts, name, service, topic, 'Value' AS field, value FROM m
      UNION ALL SELECT 0, event_id, ts, name, service, topic, 'OneMinuteRate', value / 60 FROM m
      UNION ALL SELECT 1, event_id, ts, name, service, topic, 'Value', value + 1000 FROM m WHERE value >= 50
      UNION ALL SELECT 2, event_id, ts, name, service, topic, 'Value', value + 2000 FROM m WHERE value >= 75),
    points AS (SELECT ts, name, service, topic, field,
      arg_max(value, struct_pack(b := made, e := event_id, v := value)) AS value FROM writes GROUP BY ALL)
    SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS commits FROM points""")
def compacted_days(spark, sf_dir):
    """Commits before, during and after the compaction of twenty days, which leaves one folder of each of these."""
    path = work_dir(spark, "s03d")
    first, second = _two_parts(spark, sf_dir)
    write_points(first, path, 0, "event_id", writer="job")
    write_points(second, path, 1, "event_id", writer="job")
    compact_points(spark, path, before="2024-01-21")
    folders = stored_points(spark, path).groupBy("d").agg(F.count_distinct("commit").cast("int").alias("commits"))
    folders = folders.select("d", "commits").checkpoint()
    third = second.filter(F.col("fields")["Value"] >= 1075).withColumn("fields", F.create_map(
        F.lit("Value"), F.col("fields")["Value"] + 1000))
    write_points(third, path, 2, "event_id", writer="job")
    write_points(second, path, 1, "event_id", writer="job")  # tried again: it keeps its rank
    compact_points(spark, path, before="2024-01-11")
    rows = read_points(spark, path)
    return _flat_points(rows).withColumn("d", F.to_date("ts")).join(folders, "d").drop("d")


@query("s03_panel_over_points", SERIES_SQL["Q09"])
def panel_over_points(spark, sf_dir):
    path = work_dir(spark, "s03p")
    # one point per event, or events of a series at the same moment would be one
    df = measurements(spark, sf_dir, "event_id")
    write_points(df.withColumn("tags", F.map_concat("tags", F.create_map(
        F.lit("event"), F.col("event_id").cast("string")))), path, 0)
    return evaluate_store(spark, path, "Q09", ASKED, HOUR).withColumn("value", F.round("value", 6))


@query("s04_write_archive", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d') AS d, name, count(*) AS n, round(sum(value), 3) AS total
    FROM m GROUP BY ALL""")
def archived(spark, sf_dir):
    path = work_dir(spark, "s04")
    write_archive(measurements(spark, sf_dir), path)
    rows = spark.read.schema("name string, fields map<string,double>, d string").parquet(path)
    return rows.groupBy("d", "name").agg(F.count("*").alias("n"),
                                         F.round(F.sum(F.col("fields")["Value"]), 3).alias("total"))


_LOADED_SQL = f"""
    WITH {MEASUREMENTS_SQL},
    p AS (SELECT DISTINCT ts, name, service, topic FROM m)
    SELECT name, strftime(ts, '%Y-%m-%d') AS d, count(*) AS points FROM p GROUP BY ALL
    UNION ALL
    SELECT 'org.apache.samza.m', strftime(d, '%Y-%m-%d'), count(*) FROM (
      SELECT DISTINCT make_timestamp(epoch_us(ts) // 1000 * 1000) AS d, user_id,
        unnest(CASE WHEN event_id % 7 = 6 THEN ['-'] ELSE ['-', CASE event_id % 7 WHEN 0 THEN 'a' WHEN 1 THEN 'b'
          WHEN 2 THEN 'c' WHEN 3 THEN 'd' WHEN 4 THEN 'e' ELSE 'f' END] END) AS tags
      FROM events WHERE event_type = 'click') GROUP BY ALL"""


def _load(spark, sf_dir, label: str):
    path, out = _topic(spark, sf_dir, f"{label}-topic"), work_dir(spark, f"{label}-out")
    records = read_topic(spark, TOPIC, "parquet", path)
    load_topic_to_points(records, out, f"{out}/checkpoint", None).awaitTermination()
    # a second run finds nothing new
    load_topic_to_points(records, out, f"{out}/checkpoint", None).awaitTermination()
    return read_points(spark, out).groupBy("name", F.col("d").cast("string").alias("d")).agg(F.count("*").alias("points"))


@query("s08_sink_connect", _LOADED_SQL)
def connect_sink(spark, sf_dir):
    return _load(spark, sf_dir, "s08")


@query("r02_load_topic_to_points", _LOADED_SQL)
def continuous_load(spark, sf_dir):
    return _load(spark, sf_dir, "r02")


@query("r02_loaded_values", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT event_id, ts, name, service, coalesce(topic, '') AS topic, value, round(value / 60, 9) AS rate FROM m""")
def loaded_values(spark, sf_dir):
    """Every field of every point that came through the topic, in two appends; each event is a point of its own."""
    path, out = work_dir(spark, "r02v-topic"), work_dir(spark, "r02v-out")
    rows = measurements(spark, sf_dir, "event_id")
    rows = rows.withColumn("tags", F.map_concat("tags", F.create_map(F.lit("event"), F.col("event_id").cast("string"))))
    for part in (0, 1):
        write_topic(rows.filter(F.col("event_id") % 2 == part).drop("event_id"), format="parquet", path=path)
        load_topic_to_points(read_topic(spark, TOPIC, "parquet", path), out, f"{out}/checkpoint", None).awaitTermination()
    tags, fields = F.col("tags"), F.col("fields")
    return read_points(spark, out).select(
        tags["event"].cast("bigint").alias("event_id"), "ts", "name", tags["service"].alias("service"),
        F.coalesce(tags["topic"], F.lit("")).alias("topic"), fields["Value"].alias("value"),
        F.round(fields["OneMinuteRate"], 9).alias("rate"))


def _bundle_sql() -> str:
    parts = []
    for panel_id in PANELS:
        sql = NUMBER_SQL.get(panel_id, SERIES_SQL[panel_id])
        parts.append(f"SELECT '{panel_id}' AS panel, count(*) AS n, count(value) AS known, "
                     f"round(sum(value), 3) AS total FROM ({sql})")
    return " UNION ALL ".join(parts)


@query("s09_bundle_dashboard", _bundle_sql())
def bundled(spark, sf_dir):
    # panels with a width of their own are stored by the hour here, like the others
    out = work_dir(spark, "s09")
    paths = bundle_dashboard(panel_input(spark, sf_dir), cluster_dashboard("main", 3), ASKED, out, HOUR)
    total = None
    for panel_id, path in zip(PANELS, paths):
        one = spark.read.schema("value double").parquet(path).agg(
            F.lit(panel_id).alias("panel"), F.count("*").alias("n"), F.count("value").alias("known"),
            F.round(F.sum(F.round("value", 6)), 3).alias("total"))
        total = one if total is None else total.unionByName(one)
    return total


def _bundle_values_sql() -> str:
    parts = []
    for panel_id, panel in PANELS.items():
        number = panel_id in NUMBER_SQL
        key = panel.by[0] if panel.by else "CAST(NULL AS VARCHAR)"
        columns = ("CAST(NULL AS TIMESTAMP) AS bucket", "CAST(NULL AS VARCHAR) AS series") if number else ("bucket", "series")
        level = "level" if panel.levels else "CAST(NULL AS VARCHAR) AS level"
        parts.append(f"SELECT '{panel_id}' AS panel, {key} AS key, {', '.join(columns)}, round(value, 4) AS value, {level} "
                     f"FROM ({NUMBER_SQL.get(panel_id, SERIES_SQL[panel_id])})")
    return " UNION ALL ".join(parts)


@query("s09_bundle_values", _bundle_values_sql())
def bundled_values(spark, sf_dir):
    """Every stored row of every panel."""
    out = work_dir(spark, "s09v")
    paths = bundle_dashboard(panel_input(spark, sf_dir), cluster_dashboard("main", 3), ASKED, out, HOUR)
    shown = None
    for (panel_id, panel), path in zip(PANELS.items(), paths, strict=True):
        rows = spark.read.parquet(path)
        rows = rows.select(
            F.lit(panel_id).alias("panel"), (F.col(panel.by[0]) if panel.by else F.lit(None).cast("string")).alias("key"),
            *[(F.col(c) if c in rows.columns else F.lit(None).cast(kind)).alias(c)
              for c, kind in (("bucket", "timestamp"), ("series", "string"))], F.round("value", 4).alias("value"),
            (F.col("level") if "level" in rows.columns else F.lit(None).cast("string")).alias("level"))
        shown = rows if shown is None else shown.unionByName(rows)
    return shown


def _points_stream(spark, sf_dir, label: str, extra: str = "event_id"):
    """Measurements as a stream of files, in which later rows never come before earlier days."""
    path = work_dir(spark, label)
    measurements(spark, sf_dir, extra).repartition(4).write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@query("r01_tick_trigger", """
    SELECT event_type AS name, count(*) AS n FROM events GROUP BY event_type""")
def ticked(spark, sf_dir):
    assert tick_trigger("10s") == {"processingTime": "10 seconds"}
    out = work_dir(spark, "r01")
    stream = _points_stream(spark, sf_dir, "r01-in", "event_type").select(F.col("event_type").alias("name"))
    store_stream(stream, f"{out}/rows", f"{out}/checkpoint", None).awaitTermination()
    return spark.read.schema("name string").parquet(f"{out}/rows").groupBy("name").agg(F.count("*").alias("n"))


@query("r03_stream_panel", f"""
    WITH {MEASUREMENTS_SQL}, a AS (
      SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket, service, round(sum(value), 3) AS total,
        round(avg(value), 6) AS mean, max(value) AS high, min(value) AS low, count(value) AS n,
        list(value ORDER BY ts DESC, value DESC)[1] AS newest
      FROM m WHERE dash = 'main' GROUP BY ALL)
    SELECT * FROM a WHERE bucket + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM m)""")
def panel_of_stream(spark, sf_dir):
    out = work_dir(spark, "r03")
    df = _points_stream(spark, sf_dir, "r03-in")
    panel = stream_panel(df, F.col("tags")["name"] == "main", {"service": F.col("tags")["service"]}, "1h", {
        "total": ("sum", "Value"), "mean": ("mean", "Value"), "high": ("max", "Value"),
        "low": ("min", "Value"), "n": ("count", "Value"), "newest": ("last", "Value")}, "1 hour")
    store_stream(panel, f"{out}/rows", f"{out}/checkpoint", None).awaitTermination()
    rows = spark.read.schema(panel.schema).parquet(f"{out}/rows")
    return rows.withColumn("total", F.round("total", 3)).withColumn("mean", F.round("mean", 6))


def _closed_sql(panel_id: str) -> str:
    """The panel's oracle without empty hours, of the hours that the stream has closed."""
    newest = f"SELECT max(ts) - INTERVAL 1 HOUR FROM m WHERE name = '{PANELS[panel_id].measurement}'"
    return (f"WITH {MEASUREMENTS_SQL} SELECT * FROM ({SERIES_SQL[panel_id]}) "
            f"WHERE value IS NOT NULL AND bucket + INTERVAL 1 HOUR <= ({newest})")


def _register_stream(panel_id: str) -> None:
    @query(f"r03_stream_{panel_id.lower()}", _closed_sql(panel_id))
    def shown(spark, sf_dir):
        out = work_dir(spark, f"r03-{panel_id}")
        rows = _points_stream(spark, sf_dir, f"r03-{panel_id}-in")
        panel = stream_panel_series(rows, panel_id, ASKED, HOUR, "1 hour")
        store_stream(panel, f"{out}/rows", f"{out}/checkpoint", None).awaitTermination()
        stored_rows = spark.read.schema(panel.schema).parquet(f"{out}/rows")
        return stored_rows.withColumn("value", F.round("value", 6))


for _panel_id in ("Q01", "Q08", "Q13", "Q14"):
    _register_stream(_panel_id)


def _closed_number_sql(panel_id: str) -> str:
    """The panel's number over the hours that the stream has closed."""
    newest = f"SELECT max(ts) - INTERVAL 1 HOUR FROM m WHERE name = '{PANELS[panel_id].measurement}'"
    by = ", ".join(PANELS[panel_id].by)
    value = ("arg_max(value, bucket)" if PANELS[panel_id].reduce == "current" else "avg(value)")
    return (f"WITH {MEASUREMENTS_SQL} SELECT {by + ', ' if by else ''}round({value}, 4) AS value FROM ({SERIES_SQL[panel_id]}) "
            f"WHERE value IS NOT NULL AND bucket + INTERVAL 1 HOUR <= ({newest}) {'GROUP BY ' + by if by else ''}")


def _register_number(panel_id: str) -> None:
    @query(f"r03_stream_{panel_id.lower()}", _closed_number_sql(panel_id))
    def shown(spark, sf_dir):
        """Ten days a batch."""
        out = work_dir(spark, f"r03-{panel_id}")
        stream = in_files(measurements(spark, sf_dir), F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)), f"{out}/in", 3)
        keep_panel_numbers(stream, panel_id, ASKED, f"{out}/kept", f"{out}/checkpoint", HOUR, "1 hour", None).awaitTermination()
        return read_panel_numbers(spark, f"{out}/kept", panel_id).withColumn("value", F.round("value", 4))


for _panel_id in ("Q05", "Q07", "Q11"):
    _register_number(_panel_id)


@query("r03_stream_q12", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS bucket, service, max(value) AS high, min(value) AS low, true AS middle
    FROM m WHERE name = 'NumDelayedOperations' AND time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY
      <= (SELECT max(ts) - INTERVAL 1 HOUR FROM m WHERE name = 'NumDelayedOperations') GROUP BY ALL""")
def medians_of_stream(spark, sf_dir):
    """Sketches of closed hours, stored by the stream and merged to days. A median's rank is within a hundredth of the half."""
    out = work_dir(spark, "r03-q12")
    stream = in_files(measurements(spark, sf_dir), F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)), f"{out}/in", 3)
    closed = stream_sketches(stream, "Q12", ASKED, "1h", "1 hour")
    store_stream(closed, f"{out}/rows", f"{out}/checkpoint", None).awaitTermination()
    sketches = spark.read.schema(closed.schema).parquet(f"{out}/rows")
    shown = evaluate_sketches(sketches, "Q12", ASKED, 24 * HOUR, fill=False)
    days = shown.groupBy("bucket", "service").pivot("series", ["max", "median", "min"]).agg(F.first("value"))
    rows = measurements(spark, sf_dir).filter(F.col("name") == "NumDelayedOperations").select(
        buckets.time_bucket(24 * HOUR).alias("bucket"), F.col("tags")["service"].alias("service"),
        F.col("fields")["Value"].alias("v"))
    below, upto = F.count_if(F.col("v") < F.col("median")), F.count_if(F.col("v") <= F.col("median"))
    slack = 1 + 0.01 * F.count("*")
    ranked = rows.join(days, ["bucket", "service"]).groupBy("bucket", "service", "max", "min").agg(
        ((below <= F.count("*") / 2 + slack) & (upto >= F.count("*") / 2 - slack)).alias("middle"))
    # the last day has closed hours only in part
    newest = measurements(spark, sf_dir).filter(F.col("name") == "NumDelayedOperations").agg(F.max("ts")).first()[0]
    closed_days = F.unix_seconds("bucket") + 24 * HOUR <= F.unix_seconds(F.lit(newest)) - HOUR
    return ranked.filter(closed_days).select("bucket", "service", F.col("max").alias("high"), F.col("min").alias("low"), "middle")


@query("r04_two_sources", """
    WITH slow AS (SELECT TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * (o_orderkey % 480) AS ts, o_totalprice AS value FROM orders),
    both_ AS (SELECT 'west' AS dc, ts, value FROM events UNION ALL SELECT 'east', ts, value FROM slow)
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS bucket, dc, count(*) AS n, round(sum(value), 2) AS total FROM both_
    WHERE time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= least((SELECT max(ts) FROM events), (SELECT max(ts) FROM slow))
    GROUP BY ALL""")
def two_sources(spark, sf_dir):
    """Events come at once, orders in four later batches of five days: the panel waits for the orders."""
    out = work_dir(spark, "r04t")
    west = measurements(spark, sf_dir).withColumn("name", F.lit("n"))
    hour = F.pmod("o_orderkey", F.lit(480))
    east = table(spark, sf_dir, "orders").select(
        F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + hour * 3600).alias("ts"),
        F.lit("n").alias("name"), F.expr("cast(map() as map<string,string>)").alias("tags"),
        F.create_map(F.lit("Value"), F.col("o_totalprice")).alias("fields"), F.floor(hour / 120).alias("part"))
    west.coalesce(1).write.parquet(f"{out}/west")
    fast = spark.readStream.schema(west.schema).parquet(f"{out}/west")
    slow = in_files(east, F.col("part"), f"{out}/east", 4).drop("part")
    both = union_streams({"west": fast, "east": slow}, delays={"west": "0 seconds", "east": "0 seconds"})
    panel = stream_panel(both, F.lit(True), {"dc": F.col("tags")["dc"]}, "1d",
                         {"n": ("count", "Value"), "total": ("sum", "Value")}, None)
    store_stream(panel, f"{out}/rows", f"{out}/checkpoint", None).awaitTermination()
    return spark.read.schema(panel.schema).parquet(f"{out}/rows").withColumn("total", F.round("total", 2))


@query("r04_multi_source_union", """
    SELECT CASE WHEN value >= 50 THEN 'west' ELSE 'east' END AS dc, event_type AS name, count(*) AS n
    FROM events GROUP BY ALL""")
def several_streams(spark, sf_dir):
    out = work_dir(spark, "r04")
    df = _points_stream(spark, sf_dir, "r04-in", "event_type").withColumn("name", F.col("event_type"))
    high = F.col("fields")["Value"] >= 50
    both = union_streams({"west": df.filter(high), "east": df.filter(~high)})
    rows = both.select("name", F.col("tags")["dc"].alias("dc"))
    store_stream(rows, f"{out}/rows", f"{out}/checkpoint", None).awaitTermination()
    stored_rows = spark.read.schema(rows.schema).parquet(f"{out}/rows")
    return stored_rows.groupBy("dc", "name").agg(F.count("*").alias("n"))


@query("r06_series_order", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT name, service, coalesce(topic, '') AS topic, count(*) AS n, true AS ordered FROM m GROUP BY ALL""")
def series_in_order(spark, sf_dir):
    """Whether times never fall along a series, over the tasks and the rows in them."""
    path = work_dir(spark, "r06")
    ordered = order_by_series(measurements(spark, sf_dir))
    ordered.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("series", series_hash())
    from pyspark.sql import Window
    before = F.lag("ts").over(Window.partitionBy("series").orderBy("place"))
    rows = rows.withColumn("ok", F.coalesce(F.col("ts") >= before, F.lit(True)))
    tags = F.col("tags")
    return rows.groupBy("name", tags["service"].alias("service"),
                        F.coalesce(tags["topic"], F.lit("")).alias("topic")).agg(
        F.count("*").alias("n"), F.bool_and("ok").alias("ordered"))


@query("r07_drop_redelivered", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT name, count(*) AS n FROM (SELECT DISTINCT ts, name, service, topic FROM m) GROUP BY name""")
def redelivered(spark, sf_dir):
    path, out = work_dir(spark, "r07-in"), work_dir(spark, "r07")
    df = measurements(spark, sf_dir)
    df.unionByName(df).hint("rebalance").write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    once = drop_redelivered(stream, "40 days")
    store_stream(once, f"{out}/rows", f"{out}/checkpoint", None).awaitTermination()
    rows = spark.read.schema(df.schema).parquet(f"{out}/rows")
    return rows.groupBy("name").agg(F.count("*").alias("n"))


@query("r07_drop_redelivered_spread", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT name, count(*) AS n FROM (SELECT DISTINCT ts, name, service, topic FROM m) GROUP BY name""")
def redelivered_spread(spark, sf_dir):
    path, out = work_dir(spark, "r07s-in"), work_dir(spark, "r07s")
    df = measurements(spark, sf_dir)
    copies = df.withColumn("offset", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    copies.hint("rebalance").write.parquet(path)
    stream = spark.readStream.schema(copies.schema).parquet(path)
    once = drop_redelivered(stream, "40 days", spread=["offset"]).drop("offset")
    store_stream(once, f"{out}/rows", f"{out}/checkpoint", None).awaitTermination()
    rows = spark.read.schema(df.schema).parquet(f"{out}/rows")
    return rows.groupBy("name").agg(F.count("*").alias("n"))


@query("r07_copies_that_differ", f"""
    WITH {MEASUREMENTS_SQL}, d AS (SELECT * FROM m UNION ALL SELECT * REPLACE (value + 1000 AS value) FROM m WHERE value >= 50)
    SELECT DISTINCT ts, name, service, coalesce(topic, '') AS topic, value FROM d""")
def redelivered_changed(spark, sf_dir):
    """Two deliveries of every point, and for half of them a third and a fourth with another value: one of each stays."""
    path, out = work_dir(spark, "r07d-in"), work_dir(spark, "r07d")
    df = measurements(spark, sf_dir)
    changed = df.filter(F.col("fields")["Value"] >= 50).withColumn(
        "fields", F.transform_values("fields", lambda k, v: F.when(k == "Value", v + 1000).otherwise(v)))
    twice = df.unionByName(changed)
    twice.unionByName(twice).hint("rebalance").write.parquet(path)
    once = drop_redelivered(spark.readStream.schema(df.schema).parquet(path), "40 days")
    store_stream(once, f"{out}/rows", f"{out}/checkpoint", None).awaitTermination()
    tags = F.col("tags")
    return spark.read.schema(df.schema).parquet(f"{out}/rows").select(
        "ts", "name", tags["service"].alias("service"), F.coalesce(tags["topic"], F.lit("")).alias("topic"),
        F.col("fields")["Value"].alias("value"))


@query("r07_drop_redelivered_batch", f"""
    WITH {MEASUREMENTS_SQL} SELECT DISTINCT ts, name, service, coalesce(topic, '') AS topic FROM m""")
def redelivered_batch(spark, sf_dir):
    df = measurements(spark, sf_dir)
    once = drop_redelivered(df.unionByName(df))
    tags = F.col("tags")
    return once.select("ts", "name", tags["service"].alias("service"),
                       F.coalesce(tags["topic"], F.lit("")).alias("topic"))
