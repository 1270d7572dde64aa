"""Consumer lag, latest rows, carried values and upserted points."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.roles import committed, end_offsets, events, measurements, table
from pulsegrid.operators.lag import consumer_lag, lag_measurements
from pulsegrid.operators.pack import long_fields
from pulsegrid.operators.upsert import carry_forward, latest, upsert_points

_LAG_SQL = """
    ends AS (SELECT l_suppkey AS topic, l_linenumber AS part,
        arg_max(l_orderkey, struct_pack(t := l_shipdate, o := l_orderkey)) AS end_offset
      FROM lineitem GROUP BY ALL),
    done AS (SELECT l_returnflag AS group_id, l_suppkey AS topic, l_linenumber AS part,
        max(l_shipdate) AS ts, arg_max(l_partkey, struct_pack(t := l_shipdate, o := l_partkey)) AS off
      FROM lineitem WHERE l_returnflag <> 'N' AND NOT (l_returnflag = 'A' AND l_linenumber = 7)
      GROUP BY ALL),
    lags AS (SELECT ts, group_id, CAST(topic AS VARCHAR) AS topic, part AS "partition", off AS "offset",
        end_offset, greatest(0, end_offset - off) AS lag
      FROM done JOIN ends USING (topic, part))"""


@query("j01_consumer_lag", f"WITH {_LAG_SQL} SELECT * FROM lags")
def lag(spark, sf_dir):
    return consumer_lag(end_offsets(spark, sf_dir), committed(spark, sf_dir))


@query("j01_lag_measurements", f"""
    WITH {_LAG_SQL}
    SELECT ts, 'ConsumerLag' AS name, 'Group' AS type, group_id AS "group", topic,
      CAST("partition" AS VARCHAR) AS "partition", CAST(lag AS DOUBLE) AS value FROM lags
    UNION ALL SELECT ts, 'ConsumerOffset', 'Group', group_id, topic, CAST("partition" AS VARCHAR),
      CAST("offset" AS DOUBLE) FROM lags""")
def lag_as_measurements(spark, sf_dir):
    df = lag_measurements(consumer_lag(end_offsets(spark, sf_dir), committed(spark, sf_dir)))
    return df.select("ts", "name", *[F.col("tags")[t].alias(t) for t in ("type", "group", "topic", "partition")],
                     F.col("fields")["Value"].alias("value"))


@query("u01_upsert_points", """
    WITH writes AS (
      SELECT make_timestamp(epoch_us(ts) // 60000000 * 60000000) AS ts, event_type AS name,
        'b' || (user_id % 3) AS service, event_id, 'Value' AS field, value FROM events
      UNION ALL
      SELECT make_timestamp(epoch_us(ts) // 60000000 * 60000000), event_type, 'b' || (user_id % 3),
        event_id, 'f' || (event_id % 2), value * 2 FROM events)
    SELECT ts, name, service, field, arg_max(value, event_id) AS value FROM writes GROUP BY ALL""")
def upserted(spark, sf_dir):
    minute = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 60) * 60)
    writes = events(spark, sf_dir).select(
        minute.alias("ts"), F.col("event_type").alias("name"),
        F.create_map(F.lit("service"), F.concat(F.lit("b"), (F.col("user_id") % 3).cast("string"))).alias("tags"),
        F.create_map(F.lit("Value"), F.col("value"), F.concat(F.lit("f"), (F.col("event_id") % 2).cast("string")),
                     F.col("value") * 2).alias("fields"), "event_id")
    points = upsert_points(writes, "event_id")
    return long_fields(points).select("ts", "name", F.col("tags")["service"].alias("service"), "field", "value")


@query("u02_latest", """
    SELECT l_suppkey, l_linenumber, max(l_shipdate) AS l_shipdate,
      arg_max(l_orderkey, struct_pack(t := l_shipdate, o := l_orderkey, q := l_quantity)) AS l_orderkey,
      arg_max(l_quantity, struct_pack(t := l_shipdate, o := l_orderkey, q := l_quantity)) AS l_quantity
    FROM lineitem GROUP BY l_suppkey, l_linenumber""")
def newest(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("l_shipdate"), "l_suppkey", "l_linenumber",
        "l_orderkey", "l_quantity")
    return latest(rows, ["l_suppkey", "l_linenumber"], ["l_shipdate"])


_CARRY_SQL = """
    WITH writes AS (SELECT user_id, ts, value,
        make_timestamp((epoch_us(ts) + 21599999999) // 21600000000 * 21600000000) AS tick FROM events),
    firsts AS (SELECT user_id, min(tick) AS first FROM writes GROUP BY ALL),
    grid AS (SELECT user_id, t AS tick FROM firsts,
      generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 18:00:00', INTERVAL 6 HOUR) g(t) WHERE t >= first),
    at_tick AS (SELECT user_id, tick, arg_max(value, struct_pack(t := ts, v := value)) AS value FROM writes GROUP BY ALL),
    held AS (SELECT g.user_id, g.tick, last_value(a.value IGNORE NULLS) OVER w AS value,
        last_value(CASE WHEN a.value IS NOT NULL THEN g.tick END IGNORE NULLS) OVER w AS set_at
      FROM grid g LEFT JOIN at_tick a USING (user_id, tick)
      WINDOW w AS (PARTITION BY g.user_id ORDER BY g.tick))"""


@query("u03_carry_forward", f"{_CARRY_SQL} SELECT user_id, tick, value FROM held")
def carried(spark, sf_dir):
    return carry_forward(events(spark, sf_dir).select("user_id", "ts", "value"), ["user_id"], "value",
                         "2024-01-31", 21600)


@query("u03_carry_forward_expiring", f"""
    {_CARRY_SQL} SELECT user_id, tick, value FROM held WHERE tick < set_at + INTERVAL 12 HOUR""")
def carried_expiring(spark, sf_dir):
    return carry_forward(events(spark, sf_dir).select("user_id", "ts", "value"), ["user_id"], "value",
                         "2024-01-31", 21600, expire=43200)


@query("v01_union_all", """
    SELECT event_type AS name, CASE WHEN value >= 50 THEN 'dc1' ELSE 'dc2' END AS dc, count(*) AS n
    FROM events GROUP BY ALL
    UNION ALL SELECT event_type, 'dc3', count(*) FROM events GROUP BY ALL""")
def union_all(spark, sf_dir):
    from pulsegrid.streaming.jobs import union_streams
    df = measurements(spark, sf_dir, "event_type").withColumn("name", F.col("event_type")).drop("event_type")
    high = F.col("fields")["Value"] >= 50
    df = union_streams({"dc1": df.filter(high), "dc2": df.filter(~high), "dc3": df})
    return df.groupBy("name", F.col("tags")["dc"].alias("dc")).agg(F.count("*").alias("n"))
