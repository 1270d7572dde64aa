"""Panels Q01 to Q15, bucketed aggregates, time shaping, and the predicates of panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.roles import END, HOUR, MEASUREMENTS_SQL, START, measurements, panel_input
from pulsegrid.functions.tags import group_tag, series_label, tag
from pulsegrid.functions.values import auto_interval, negate
from pulsegrid.operators import buckets
from pulsegrid.operators.filters import lookback, measurement_is, tag_eq, tag_re, time_range
from pulsegrid.operators.pack import long_fields, wide_fields
from pulsegrid.plans.panels import PANELS, Range, evaluate, panel_series

ASKED = Range(dash="main", start=START, end=END, interval="1h")

GRID = """generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR) g(bucket)"""


def _panel_sql(where: str, key: str | None, columns: dict[str, str], labels: dict[str, str],
               level: str = "") -> str:
    """Oracle of a panel: hourly aggregates of matching rows on a full grid of hours."""
    keys = f", {key}" if key else ""
    series = f"SELECT DISTINCT {key} FROM hourly" if key else "SELECT 1 AS one FROM hourly LIMIT 1"
    on = "USING (bucket" + keys + ")"
    aggregates = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    rows = " UNION ALL ".join(
        f"SELECT bucket{keys}, {labels[name]} AS series, round({name}, 6) AS value{level.format(v=name)} FROM filled"
        for name in columns)
    return f"""WITH {MEASUREMENTS_SQL},
    hourly AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket{keys}, {aggregates}
      FROM m WHERE dash = 'main' AND {where} GROUP BY ALL),
    filled AS (SELECT * FROM (SELECT * FROM ({series}), {GRID}) LEFT JOIN hourly {on})
    {rows}"""


def _number_sql(where: str, key: str | None, expr: str, how: str) -> str:
    keys = f", {key}" if key else ""
    number = "arg_max(v, bucket)" if how == "current" else "avg(v)"
    return f"""WITH {MEASUREMENTS_SQL},
    hourly AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket{keys}, {expr} AS v
      FROM m WHERE dash = 'main' AND {where} GROUP BY ALL)
    SELECT {key + ', ' if key else ''}round({number}, 6) AS value FROM hourly GROUP BY ALL"""


def _level(warn: float, critical: float) -> str:
    return (", CASE WHEN {v} >= %s THEN 'critical' WHEN {v} >= %s THEN 'warn' "
            "WHEN {v} IS NOT NULL THEN 'ok' END AS level") % (critical, warn)


def _rate(name: str, key: str, where: str = "", sign: str = "", label: str | None = None) -> str:
    return _panel_sql(f"name = '{name}' AND topic IS NOT NULL{where}", key,
                      {"v": f"{sign}sum(value / 60)"}, {"v": label or key})


SERVER = " AND grp = 'kafka.server'"
LAST = "list(value ORDER BY ts DESC, value DESC)[1]"

SERIES_SQL = {
    "Q01": _rate("BytesInPerSec", "topic"),
    "Q02": _rate("MessagesInPerSec", "topic"),
    "Q03": _rate("FailedFetchRequestsPerSec", "topic"),
    "Q04": _rate("BytesOutPerSec", "topic"),
    "Q05": _panel_sql("name = 'ActiveControllerCount' AND grp = 'kafka.controller'", None,
                      {"v": "sum(value)"}, {"v": "'sum'"}),
    "Q06": _panel_sql("name = 'UnderReplicatedPartitions'" + SERVER, "service",
                      {"v": "avg(value)"}, {"v": "service"}),
    "Q07": _panel_sql("name = 'PartitionCount'" + SERVER, "service", {"v": LAST}, {"v": "service"}),
    "Q08": _panel_sql("name = 'LogFlushRateAndTimeMs' AND grp = 'kafka.log'", "service",
                      {"v": "max(value)"}, {"v": "service"}, _level(6, 12)),
    "Q09": _rate("BytesInPerSec", "service", SERVER),
    "Q10": _rate("BytesOutPerSec", "service", SERVER),
    "Q11": _panel_sql("name = 'RequestsPerSec' AND grp = 'kafka.network'", None,
                      {"v": "avg(value / 60)"}, {"v": "'mean'"}),
    "Q12": _panel_sql("name = 'NumDelayedOperations'", "service",
                      {"a": "max(value)", "b": "median(value)", "c": "min(value)"},
                      {"a": "'max'", "b": "'median'", "c": "'min'"}),
    "Q13": _panel_sql("name = 'LogFlushRateAndTimeMs' AND grp = 'kafka.log'", "service",
                      {"a": "sum(value * 2)", "b": "sum(value * 1.5)", "c": "sum(value * 0.5)"},
                      {"a": "'999thPercentile'", "b": "'99thPercentile'", "c": "'95thPercentile'"},
                      _level(100, 250)),
    "Q14": _rate("BytesOutPerSec", "service", sign="-", label="'Output'"),
    "Q15": _rate("BytesInPerSec", "service", label="'Input'"),
}

NUMBER_SQL = {
    "Q05": _number_sql("name = 'ActiveControllerCount' AND grp = 'kafka.controller'", None,
                       "sum(value)", "current"),
    "Q07": _number_sql("name = 'PartitionCount'" + SERVER, "service", LAST, "avg"),
    "Q11": _number_sql("name = 'RequestsPerSec' AND grp = 'kafka.network'", None,
                       "avg(value / 60)", "avg"),
}

SHORT = Range(dash="main", start="2024-01-05 00:00:00", end="2024-01-05 12:00:00", interval="10s")


def _own_width_sql(panel_id: str) -> str:
    """The panel's oracle over half a day, in buckets of its own width."""
    micros = SHORT.width(PANELS[panel_id]) * 1_000_000
    first, last = (f"epoch_us(TIMESTAMP '{t}')" for t in (SHORT.start, SHORT.end))
    sql = SERIES_SQL[panel_id].replace("time_bucket(INTERVAL 1 HOUR, ts)",
                                       f"make_timestamp(epoch_us(ts) // {micros} * {micros})")
    sql = sql.replace("dash = 'main' AND", f"dash = 'main' AND ts >= '{SHORT.start}' AND ts < '{SHORT.end}' AND")
    return sql.replace(GRID, f"(SELECT make_timestamp(x * {micros}) AS bucket FROM range({first} // {micros}, "
                             f"({last} - 1) // {micros} + 1) t(x)) g")


def _register_own_width(panel_id: str) -> None:
    @query(f"{panel_id.lower()}_{TITLES[panel_id]}_own_width", _own_width_sql(panel_id))
    def shown(spark, sf_dir):
        rows = panel_series(panel_input(spark, sf_dir), PANELS[panel_id], SHORT)
        return rows.withColumn("value", F.round("value", 6))


TITLES = {
    "Q01": "topic_input_bytes", "Q02": "topic_input_messages", "Q03": "topic_failed_fetches",
    "Q04": "topic_output_bytes", "Q05": "controllers", "Q06": "under_replicated_partitions",
    "Q07": "partition_count", "Q08": "log_flush_98th_max", "Q09": "cluster_input",
    "Q10": "cluster_output", "Q11": "requests", "Q12": "delayed_operations",
    "Q13": "log_flush_percentiles", "Q14": "throughput_out", "Q15": "throughput_in",
}


def _register_panel(panel_id: str) -> None:
    name = f"{panel_id.lower()}_{TITLES[panel_id]}"

    def series(spark, sf_dir):
        shown = panel_series(panel_input(spark, sf_dir), PANELS[panel_id], ASKED, HOUR)
        return shown.withColumn("value", F.round("value", 6))

    def number(spark, sf_dir):
        shown = evaluate(panel_input(spark, sf_dir), panel_id, ASKED, HOUR)
        return shown.withColumn("value", F.round("value", 6))

    if panel_id in NUMBER_SQL:
        query(name, NUMBER_SQL[panel_id])(number)
        query(f"{name}_series", SERIES_SQL[panel_id])(series)
    else:
        query(name, SERIES_SQL[panel_id])(series)


for _panel_id in PANELS:
    _register_panel(_panel_id)
for _panel_id in ("Q01", "Q08", "Q12", "Q13", "Q14", "Q15"):
    _register_own_width(_panel_id)


# bucketed aggregates, one by one

_EXPRESSIONS = {"sum": "round(sum(value), 4)", "mean": "round(avg(value), 6)", "max": "max(value)",
                "min": "min(value)", "median": "round(median(value), 6)", "last": LAST,
                "count": "count(value)"}


def _register_aggregate(item: str, how: str) -> None:
    @query(f"{item}_bucket_{how}", f"""
        WITH {MEASUREMENTS_SQL}
        SELECT time_bucket(INTERVAL 1 DAY, ts) AS bucket, name, {_EXPRESSIONS[how]} AS value
        FROM m GROUP BY ALL""")
    def run(spark, sf_dir):
        rows = wide_fields(measurements(spark, sf_dir), ["Value"])
        table = buckets.bucket_agg(rows, 24 * HOUR, ["name"], {"value": (how, "Value")})
        places = {"sum": 4, "mean": 6, "median": 6}
        return table.withColumn("value", F.round("value", places[how])) if how in places else table


for _item, _how in (("a09", "count"), ("a09a", "sum"), ("a09b", "mean"), ("a09c", "max"),
                    ("a09d", "min"), ("a09e", "median"), ("a09f", "last")):
    _register_aggregate(_item, _how)


@query("a10_multi_agg", f"""
    WITH {MEASUREMENTS_SQL},
    a AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS bucket, service, max(value) AS hi,
            median(value) AS mid, min(value) AS lo FROM m GROUP BY ALL)
    SELECT bucket, service, 'max' AS col, hi AS value FROM a
    UNION ALL SELECT bucket, service, 'median', round(mid, 6) FROM a
    UNION ALL SELECT bucket, service, 'min', lo FROM a""")
def multi_agg(spark, sf_dir):
    df = measurements(spark, sf_dir)
    rows = wide_fields(df.withColumn("service", group_tag(df, "service")), ["Value"])
    table = buckets.bucket_agg(rows, 24 * HOUR, ["service"], {
        "max": ("max", "Value"), "median": ("median", "Value"), "min": ("min", "Value")})
    shown = buckets.unpivot_aggregates(table, ["service"], ["max", "median", "min"])
    return shown.withColumn("value", F.round("value", 6))


def _daily_mean(spark, sf_dir):
    rows = wide_fields(measurements(spark, sf_dir), ["Value"])
    return buckets.bucket_agg(rows, 24 * HOUR, ["name"], {"value": ("mean", "Value")})


@query("a11_series_reduce", f"""
    WITH {MEASUREMENTS_SQL},
    a AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS bucket, name, avg(value) AS v FROM m GROUP BY ALL)
    SELECT name, round(arg_max(v, bucket), 6) AS current, round(avg(v), 6) AS average
    FROM a GROUP BY name""")
def series_reduce(spark, sf_dir):
    daily = _daily_mean(spark, sf_dir)
    current = buckets.series_reduce(daily, ["name"], "value", "current")
    average = buckets.series_reduce(daily, ["name"], "value", "avg")
    return current.join(average.withColumnRenamed("value", "average"), "name").select(
        "name", F.round("value", 6).alias("current"), F.round("average", 6).alias("average"))


@query("a12_count_members", "SELECT count(DISTINCT user_id % 3) AS members FROM events")
def count_members(spark, sf_dir):
    return buckets.count_members(measurements(spark, sf_dir))


@query("a13_tag_values", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT DISTINCT topic AS text, topic AS value FROM m WHERE topic IS NOT NULL
    UNION ALL SELECT 'All', '.+'""")
def tag_values(spark, sf_dir):
    return buckets.tag_values(measurements(spark, sf_dir), "topic")


# shaping in time

@query("t01_time_bucket", """
    SELECT event_id, time_bucket(INTERVAL 10 SECOND, ts) AS ten_seconds,
      time_bucket(INTERVAL 1 MINUTE, ts) AS minute, time_bucket(INTERVAL 1 HOUR, ts) AS hour
    FROM events""")
def time_bucket(spark, sf_dir):
    from checks.roles import events
    return events(spark, sf_dir).select(
        "event_id", buckets.time_bucket(10).alias("ten_seconds"),
        buckets.time_bucket(60).alias("minute"), buckets.time_bucket(HOUR).alias("hour"))


def _hourly_by_topic(spark, sf_dir):
    df = measurements(spark, sf_dir)
    rows = wide_fields(df.withColumn("topic", group_tag(df, "topic")), ["Value"])
    return buckets.bucket_agg(rows, HOUR, ["name", "topic"], {"value": ("sum", "Value")})


_HOURLY = f"""{MEASUREMENTS_SQL},
    hourly AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket, name, coalesce(topic, '') AS topic,
      sum(value) AS v FROM m GROUP BY ALL),
    filled AS (SELECT * FROM (SELECT * FROM (SELECT DISTINCT name, topic FROM hourly), {GRID})
      LEFT JOIN hourly USING (bucket, name, topic))"""


@query("t02_fill_null", f"WITH {_HOURLY} SELECT bucket, name, topic, round(v, 4) AS value FROM filled")
def fill_null(spark, sf_dir):
    filled = buckets.fill_null(_hourly_by_topic(spark, sf_dir), START, END, HOUR, ["name", "topic"])
    return filled.withColumn("value", F.round("value", 4))


@query("t03_lookback", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT name, count(*) AS n,
      count(*) FILTER (ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 14400 MINUTE
        AND ts < TIMESTAMP '2024-01-20 12:00:00') AS inside
    FROM m GROUP BY name""")
def lookback_counts(spark, sf_dir):
    start, end = lookback("2024-01-20 12:00:00", 14400)
    return measurements(spark, sf_dir).groupBy("name").agg(
        F.count("*").alias("n"), F.count_if((F.col("ts") >= start) & (F.col("ts") < end)).alias("inside"))


@query("t04_auto_interval", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT time_bucket(INTERVAL 25920 SECOND, ts, TIMESTAMP '1970-01-01') AS bucket, name,
      round(sum(value), 4) AS value FROM m GROUP BY ALL""")
def auto_interval_buckets(spark, sf_dir):
    rows = wide_fields(measurements(spark, sf_dir), ["Value"])
    table = buckets.bucket_agg(rows, auto_interval(30 * 86400, 100), ["name"], {"value": ("sum", "Value")})
    return table.withColumn("value", F.round("value", 4))


@query("t05_threshold_level", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT event_id, name, CASE WHEN value >= 100 THEN 'critical' WHEN value >= 50 THEN 'warn'
      ELSE 'ok' END AS level FROM m""")
def threshold_level(spark, sf_dir):
    df = wide_fields(measurements(spark, sf_dir, "event_id"), ["Value"])
    return df.select("event_id", "name", buckets.threshold_level("Value", 50, 100).alias("level"))


@query("t06_connect_nulls", f"""
    WITH {_HOURLY},
    near AS (SELECT *,
        last_value(CASE WHEN v IS NOT NULL THEN bucket END IGNORE NULLS) OVER before AS b0,
        last_value(v IGNORE NULLS) OVER before AS v0,
        first_value(CASE WHEN v IS NOT NULL THEN bucket END IGNORE NULLS) OVER after AS b1,
        first_value(v IGNORE NULLS) OVER after AS v1
      FROM filled WINDOW
        before AS (PARTITION BY name, topic ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        after AS (PARTITION BY name, topic ORDER BY bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT bucket, name, topic, round(CASE WHEN v IS NOT NULL THEN v
      ELSE v0 + (v1 - v0) * (epoch(bucket) - epoch(b0)) / (epoch(b1) - epoch(b0)) END, 9) AS value
    FROM near""")
def connect_nulls(spark, sf_dir):
    filled = buckets.fill_null(_hourly_by_topic(spark, sf_dir), START, END, HOUR, ["name", "topic"])
    joined = buckets.connect_nulls(filled, ["name", "topic"], "value", HOUR)
    return joined.withColumn("value", F.round("value", 9))


# predicates and projections of panels

@query("f04_tag_eq", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT event_id, name, service FROM m
    WHERE service = 'broker-1' AND dash = 'main' AND grp = 'kafka.server'""")
def filter_tag_eq(spark, sf_dir):
    df = measurements(spark, sf_dir, "event_id")
    keep = tag_eq(df, "service", "broker-1") & tag_eq(df, "name", "main") & tag_eq(df, "group", "kafka.server")
    return df.filter(keep).select("event_id", "name", tag(df, "service").alias("service"))


@query("f05_tag_re", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT event_id, topic, regexp_full_match(topic, 't[0-4]') AS low FROM m
    WHERE regexp_full_match(topic, '.+')""")
def filter_tag_re(spark, sf_dir):
    df = measurements(spark, sf_dir, "event_id")
    return df.filter(tag_re(df, "topic", ".+")).select(
        "event_id", tag(df, "topic").alias("topic"), tag_re(df, "topic", "t[0-4]").alias("low"))


@query("f06_measurement_is", f"""
    WITH {MEASUREMENTS_SQL} SELECT event_id, value FROM m WHERE name = 'BytesInPerSec'""")
def filter_measurement(spark, sf_dir):
    df = measurements(spark, sf_dir, "event_id").filter(measurement_is("BytesInPerSec"))
    return wide_fields(df, ["Value"]).select("event_id", F.col("Value").alias("value"))


@query("f07_time_range", f"""
    WITH {MEASUREMENTS_SQL} SELECT event_id, ts FROM m
    WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-25'""")
def filter_time_range(spark, sf_dir):
    df = measurements(spark, sf_dir, "event_id")
    return df.filter(time_range(df, "2024-01-05 06:00:00", "2024-01-25")).select("event_id", "ts")


@query("p08_tag", f"""
    WITH {MEASUREMENTS_SQL} SELECT coalesce(topic, '') AS topic, service, count(*) AS n FROM m GROUP BY ALL""")
def group_by_tag(spark, sf_dir):
    df = measurements(spark, sf_dir)
    return df.groupBy(group_tag(df, "topic").alias("topic"),
                      group_tag(df, "service").alias("service")).agg(F.count("*").alias("n"))


@query("p09_negate", f"""
    WITH {MEASUREMENTS_SQL} SELECT name, round(-sum(value), 4) AS value FROM m GROUP BY name""")
def negated_sum(spark, sf_dir):
    rows = wide_fields(measurements(spark, sf_dir), ["Value"])
    return rows.groupBy("name").agg(F.round(negate(F.sum("Value")), 4).alias("value"))


@query("p10_series_label", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT coalesce(topic, '') AS by_topic, service AS by_service, 'max' AS by_column,
      'Output' AS constant, max(value) AS value
    FROM m GROUP BY topic, service""")
def labels(spark, sf_dir):
    df = measurements(spark, sf_dir)
    rows = df.groupBy(group_tag(df, "topic").alias("topic"), group_tag(df, "service").alias("service")).agg(
        F.max(F.col("fields")["Value"]).alias("value"))
    tags = {k: F.col(k) for k in ("topic", "service")}
    return rows.select(
        series_label("$tag_topic", "max", tags).alias("by_topic"),
        series_label("$tag_service", "max", tags).alias("by_service"),
        series_label("$col", "max", tags).alias("by_column"),
        series_label("Output", "max", tags).alias("constant"), "value")


@query("p11_long_and_wide_fields", f"""
    WITH {MEASUREMENTS_SQL}, f AS (
      SELECT name, 'Value' AS field, value AS v FROM m UNION ALL SELECT name, 'OneMinuteRate', value / 60 FROM m
      UNION ALL SELECT name, '95thPercentile', value * 0.5 FROM m UNION ALL SELECT name, '98thPercentile', value FROM m
      UNION ALL SELECT name, '99thPercentile', value * 1.5 FROM m UNION ALL SELECT name, '999thPercentile', value * 2 FROM m)
    SELECT name, field, count(*) AS n, round(sum(v), 4) AS total, CAST(NULL AS DOUBLE) AS absent
    FROM f GROUP BY name, field""")
def long_and_wide(spark, sf_dir):
    rows = long_fields(wide_fields(
        measurements(spark, sf_dir).withColumn("_all", F.col("fields")), ["absent"])
        .withColumnRenamed("_all", "fields"))
    return rows.groupBy("name", "field").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max("absent").alias("absent"))


@query("p12_rename_aggregate", f"""
    WITH {MEASUREMENTS_SQL} SELECT time_bucket(INTERVAL 1 DAY, ts) AS bucket, max(value) AS "98thPercentile"
    FROM m GROUP BY ALL""")
def renamed(spark, sf_dir):
    rows = measurements(spark, sf_dir).select("ts", F.col("fields")["98thPercentile"].alias("v"))
    return buckets.bucket_agg(rows, 24 * HOUR, [], {"98thPercentile": ("max", "v")})
