"""Beans, instrument snapshots, packed fields and instrument summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.roles import BEANS_SQL, END, SNAPSHOTS_SQL, beans, events, snapshots, table
from pulsegrid.operators import summary
from pulsegrid.operators.buckets import time_bucket
from pulsegrid.operators.pack import long_fields, pack_fields
from pulsegrid.sources.beans import mbean_to_measurements, pack_bean
from pulsegrid.sources.registry import registry_to_measurements

# a tick of five minutes and rates over 1, 5 and 15 hours: the usual ratio for sparse events
TICK = 300
RATES = {"OneMinuteRate": 60, "FiveMinuteRate": 300, "FifteenMinuteRate": 900}
DAY = 86400


@query("s05_mbean_to_measurements", f"""
    WITH {BEANS_SQL}
    SELECT TIMESTAMP '2024-01-01' AS ts, address, 'part-' || p_partkey AS name, p_brand AS "group",
      p_type AS type, CAST(NULL AS VARCHAR) AS id, 'az1' AS dc, attr AS field, v AS value FROM part_attrs
    UNION ALL
    SELECT TIMESTAMP '2024-01-01', address, attr, 'java.lang', 'Supplier', CAST(s_suppkey AS VARCHAR),
      'az1', 'Value', v FROM supplier_attrs""")
def bean_measurements(spark, sf_dir):
    df = mbean_to_measurements(beans(spark, sf_dir), {"dc": "az1", "type": "fixed"})
    return long_fields(df).select(
        "ts", "address", "name", *[F.col("tags")[t].alias(t) for t in ("group", "type", "id", "dc")],
        "field", "value")


@query("s06_registry_to_measurements", f"""
    WITH {SNAPSHOTS_SQL},
    kinds(kind, n) AS (VALUES ('client', 1), ('gauge', 1), ('counter', 1), ('meter', 5), ('timer', 10), ('histogram', 10))
    SELECT l_orderkey, l_linenumber, kind, l_partkey, n AS fields,
      CASE WHEN kind IN ('client', 'gauge') THEN l_extendedprice END AS value,
      CASE WHEN kind NOT IN ('client', 'gauge') THEN l_quantity END AS count,
      grp AS "group", CASE WHEN kind = 'client' THEN 'c' || l_suppkey END AS client,
      CASE WHEN kind <> 'client' THEN nullif(typ, '') END AS type,
      CASE WHEN kind <> 'client' AND l_linenumber = 4 THEN 'scope with a key but no value: ' || scope END AS error
    FROM snaps JOIN kinds USING (kind)
    WHERE NOT (kind IN ('client', 'gauge') AND l_linenumber = 7)""")
def registry_measurements(spark, sf_dir):
    # the line that an instrument stands for is carried along in its name
    named = snapshots(spark, sf_dir).withColumn("name", F.concat_ws("/", "name", "l_orderkey", "kind", F.coalesce(
        F.when(F.col("group") == "java.lang", "6"), F.when(F.col("type") == "", "5"),
        F.when(F.col("scope").isNull(), "1"), F.when(F.col("scope") == "", "2"),
        F.when(F.col("scope").startswith("a.b"), "4"),
        F.when(F.col("scope").contains(".partition."), "7"), F.lit("3"))))
    df = registry_to_measurements(named, {"type": "fixed"})
    df = df.withColumn("_n", F.split("name", "/")).withColumn("_all", F.explode(F.array(F.struct("tags", "fields"))))
    tags, fields = F.col("_all.tags"), F.col("_all.fields")
    kind = F.col("_n")[2]
    return df.select(
        F.col("_n")[1].cast("bigint").alias("l_orderkey"), F.col("_n")[3].cast("int").alias("l_linenumber"),
        kind.alias("kind"), F.substring(F.col("_n")[0], 6, 20).cast("bigint").alias("l_partkey"),
        F.size(fields).alias("fields"), fields["Value"].alias("value"), fields["Count"].alias("count"),
        tags["group"].alias("group"), tags["client-id"].alias("client"),
        F.nullif(tags["type"], F.lit("fixed")).alias("type"), "error")


@query("a01_pack_fields", """
    SELECT l_orderkey, l_returnflag AS flag,
      count(DISTINCT l_linenumber) AS fields,
      round(sum(v), 4) AS total
    FROM (SELECT l_orderkey, l_returnflag, l_linenumber,
            arg_max(l_extendedprice, struct_pack(s := l_shipdate, p := l_extendedprice)) AS v
          FROM lineitem GROUP BY ALL)
    GROUP BY ALL""")
def packed_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.create_map(F.lit("flag"), F.col("l_returnflag")).alias("tags"),
        F.concat(F.lit("f"), F.col("l_linenumber").cast("string")).alias("field"),
        F.col("l_extendedprice").alias("value"), "l_shipdate")
    packed = pack_fields(rows, ["l_orderkey"], order="l_shipdate")
    total = F.aggregate(F.map_values("fields"), F.lit(0.0), lambda a, x: a + x)
    return packed.select("l_orderkey", F.col("tags")["flag"].alias("flag"),
                         F.size("fields").cast("bigint").alias("fields"), F.round(total, 4).alias("total"))


@query("a02_pack_bean", f"""
    WITH {BEANS_SQL}
    SELECT address, 'part-' || p_partkey AS bean, count(*) AS fields, max(v) FILTER (attr = 'Price') AS price,
      max(v) FILTER (attr = 'Size') AS size FROM part_attrs GROUP BY ALL
    UNION ALL SELECT address, 'supplier-' || s_suppkey, count(*), NULL, NULL FROM supplier_attrs GROUP BY ALL""")
def packed_beans(spark, sf_dir):
    df = pack_bean(beans(spark, sf_dir))
    props, fields = F.col("key_props"), F.col("fields")
    bean = F.coalesce(props["name"], F.concat(F.lit("supplier-"), props["id"]))
    return df.select("address", bean.alias("bean"), F.size("fields").cast("bigint").alias("fields"),
                     fields["Price"].alias("price"), fields["Size"].alias("size"))


@query("a03_summarise_gauge", """
    SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS tick, arg_max(value, ts) AS "Value"
    FROM events GROUP BY ALL""")
def gauge(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("tick", time_bucket(3600))
    return summary.summarise_gauge(rows, ["event_type", "tick"])


@query("a04_summarise_counter", """
    SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS "Count" FROM lineitem GROUP BY ALL""")
def counter(spark, sf_dir):
    return summary.summarise_counter(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"],
                                     F.col("l_quantity"))


@query("a04_counter_history", """
    SELECT event_type, bucket, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY bucket) AS BIGINT) AS "Count"
    FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS bucket, count(*) AS n FROM events GROUP BY ALL)""")
def counter_history(spark, sf_dir):
    return summary.counter_history(events(spark, sf_dir), ["event_type"], 3600)


_TICKS = """
    ticks AS (SELECT event_type, epoch(ts)::BIGINT // 300 AS tick, count(*) AS n
      FROM (SELECT event_type, date_trunc('second', ts) AS ts FROM events) GROUP BY ALL),
    firsts AS (SELECT event_type, min(tick) AS first FROM ticks GROUP BY ALL)"""


def _rate_sql(minutes: int, last: str) -> str:
    keep = f"exp(-300.0 / (60 * {minutes}))"
    return (f"round(sum(CASE WHEN tick = first THEN 1 ELSE 1 - {keep} END * n / 300"
            f" * pow({keep}, {last} - tick)), 9)")


_RATES_SQL = ", ".join(f'{_rate_sql(m, "{last}")} AS "{name}"' for name, m in RATES.items())


@query("a05_summarise_meter", f"""
    WITH {_TICKS}, bounds AS (SELECT epoch(TIMESTAMP '2024-01-31')::BIGINT // 300 - 1 AS final)
    SELECT event_type, CAST(sum(n) AS DOUBLE) AS "Count",
      round(sum(n) / ((max(final) + 1 - max(first)) * 300), 9) AS "MeanRate",
      {_RATES_SQL.format(last='final')}
    FROM ticks JOIN firsts USING (event_type), bounds GROUP BY event_type""")
def meter(spark, sf_dir):
    df = summary.summarise_meter(events(spark, sf_dir), ["event_type"], END, tick_seconds=TICK, minutes=RATES)
    return df.select("event_type", "Count", *[F.round(c, 9).alias(c) for c in ("MeanRate", *RATES)])


_SPREAD_SQL = """max({v}) AS "Max", round(avg({v}), 6) AS "Mean", min({v}) AS "Min",
      round(coalesce(stddev_samp({v}), 0), 6) AS "StdDev", round(sum({v}), 3) AS "Sum" """
_SPREAD_PLACES = {"Mean": 6, "StdDev": 6, "Sum": 3}


def _rounded(df, places):
    return df.select(*[F.round(c, places[c]).alias(c) if c in places else F.col(f"`{c}`") for c in df.columns])


@query("a06_summarise_histogram", f"""
    SELECT l_returnflag, l_linestatus, CAST(count(*) AS DOUBLE) AS "Count",
      {_SPREAD_SQL.format(v='l_extendedprice')},
      round(quantile_cont(l_extendedprice, 0.95), 6) AS "95thPercentile",
      round(quantile_cont(l_extendedprice, 0.98), 6) AS "98thPercentile",
      round(quantile_cont(l_extendedprice, 0.99), 6) AS "99thPercentile",
      round(quantile_cont(l_extendedprice, 0.999), 6) AS "999thPercentile"
    FROM lineitem GROUP BY ALL""")
def histogram(spark, sf_dir):
    df = summary.summarise_histogram(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"],
                                     "l_extendedprice")
    return _rounded(df, {**_SPREAD_PLACES, **{p: 6 for p in summary.PERCENTILES}})


@query("a06_summarise_histogram_approximate", f"""
    SELECT l_returnflag, l_linestatus, CAST(count(*) AS DOUBLE) AS "Count",
      {_SPREAD_SQL.format(v='l_extendedprice')}, true AS "95thPercentile", true AS "98thPercentile",
      true AS "99thPercentile", true AS "999thPercentile"
    FROM lineitem GROUP BY ALL""")
def histogram_approximate(spark, sf_dir):
    """Of a percentile: whether its rank is within a thousandth of what was asked for."""
    keys = ["l_returnflag", "l_linestatus"]
    rows = table(spark, sf_dir, "lineitem").select(*keys, F.col("l_extendedprice").alias("v"))
    found = summary.summarise_histogram(rows, keys, "v", exact=False)
    slack = 1 + F.count("*") / 1000
    ranked = rows.join(found, keys).groupBy(*found.drop(*summary.PERCENTILES).columns).agg(*[
        ((F.count_if(F.col("v") < F.col(name)) <= q * F.count("*") + slack)
         & (F.count_if(F.col("v") <= F.col(name)) >= q * F.count("*") - slack)).alias(name)
        for name, q in summary.PERCENTILES.items()])
    return _rounded(ranked, _SPREAD_PLACES)


@query("a07_summarise_timer", f"""
    WITH {_TICKS}, bounds AS (SELECT epoch(TIMESTAMP '2024-01-31')::BIGINT // 300 - 1 AS final),
    meters AS (SELECT event_type, CAST(sum(n) AS DOUBLE) AS "Count",
        round(sum(n) / ((max(final) + 1 - max(first)) * 300), 9) AS "MeanRate",
        {_RATES_SQL.format(last='final')}
      FROM ticks JOIN firsts USING (event_type), bounds GROUP BY event_type),
    spread AS (SELECT event_type, {_SPREAD_SQL.format(v='value')} FROM events GROUP BY ALL)
    SELECT * FROM meters JOIN spread USING (event_type)""")
def timer(spark, sf_dir):
    df = summary.summarise_timer(events(spark, sf_dir), ["event_type"], END, tick_seconds=TICK, minutes=RATES)
    return _rounded(df, {**_SPREAD_PLACES, "MeanRate": 9, **{r: 9 for r in RATES}})


EWMA_SQL = f"""
    WITH {_TICKS},
    reports AS (SELECT event_type, first, r AS report FROM firsts,
      generate_series((SELECT min(first) // 72 FROM firsts), epoch(TIMESTAMP '2024-01-31')::BIGINT // 21600 - 1) g(r)
      WHERE r >= first // 72)
    SELECT event_type, make_timestamp((report + 1) * 21600000000) AS at,
      {_RATES_SQL.format(last='((report + 1) * 72 - 1)')}
    FROM reports JOIN ticks USING (event_type) WHERE tick < (report + 1) * 72
    GROUP BY event_type, report"""


@query("a08_ewma_rate", EWMA_SQL)
def ewma(spark, sf_dir):
    df = summary.ewma_rate(events(spark, sf_dir), ["event_type"], END, DAY // 4, tick_seconds=TICK, minutes=RATES)
    return _rounded(df, {r: 9 for r in RATES})
