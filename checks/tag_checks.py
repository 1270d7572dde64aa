"""Values, tags, scopes, object names, inventory, and the filters on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.roles import (
    BEANS_SQL, MEASUREMENTS_SQL, SNAPSHOTS_SQL, beans, brokers, events, json_text, measurements,
    snapshots, table)
from pulsegrid.functions import tags as T
from pulsegrid.functions import values as V
from pulsegrid.functions.samza import FIELD_TAGS, tag_samza_field
from pulsegrid.operators.enrich import broker_addresses, enrich_with_inventory
from pulsegrid.operators.lag import controller_only, end_offsets_from_metrics, exclude_prefix
from pulsegrid.operators.pack import drop_empty
from pulsegrid.schema import series_hash, series_key
from pulsegrid.sources.snapshot_json import json_shape_ok, parse_snapshot, snapshot_error


@query("p01_any_to_double", """
    SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_linenumber AS DOUBLE) AS from_int,
      CAST(l_orderkey AS DOUBLE) AS from_long, CAST(NULL AS DOUBLE) AS from_text,
      CASE WHEN l_discount > 0 THEN l_quantity / l_discount END AS from_double,
      CAST(NULL AS DOUBLE) AS from_decimal
    FROM lineitem""")
def any_to_double(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag",
        F.when(F.col("l_discount") > 0, F.col("l_quantity") / F.col("l_discount"))
        .otherwise(F.lit(float("inf"))).alias("ratio"),
        F.col("l_quantity").cast("decimal(10,2)").alias("price"))
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        V.any_to_double(rows, "l_linenumber").alias("from_int"),
        V.any_to_double(rows, "l_orderkey").alias("from_long"),
        V.any_to_double(rows, "l_returnflag").alias("from_text"),
        V.any_to_double(rows, "ratio").alias("from_double"),
        V.any_to_double(rows, "price").alias("from_decimal"))


@query("p02_with_fixed_tags", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT event_id, 'uk-az1' AS dc, service, coalesce(topic, 'none') AS topic FROM m""")
def with_fixed_tags(spark, sf_dir):
    df = measurements(spark, sf_dir, "event_id")
    df = T.with_fixed_tags(df, {"dc": "uk-az1", "service": "unknown", "topic": "none"})
    return df.select("event_id", *[F.col("tags")[t].alias(t) for t in ("dc", "service", "topic")])


@query("p03_overlay_map", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS flag, l_linestatus AS status,
      CASE WHEN l_linenumber > 3 THEN 'late' ELSE l_returnflag END AS shared
    FROM lineitem""")
def overlay_map(spark, sf_dir):
    base = F.create_map(F.lit("flag"), F.col("l_returnflag"), F.lit("shared"), F.col("l_returnflag"))
    over = F.when(F.col("l_linenumber") > 3, F.create_map(
        F.lit("status"), F.col("l_linestatus"), F.lit("shared"), F.lit("late"))).otherwise(
        F.create_map(F.lit("status"), F.col("l_linestatus")))
    rows = table(spark, sf_dir, "lineitem").withColumn("t", T.overlay_map(base, over))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey",
                       *[F.col("t")[k].alias(k) for k in ("flag", "status", "shared")])


_SCOPE_TAGS = ("group", "type", "scope", "topic", "partition", "a")


@query("p04_metric_name_tags", f"""
    WITH {SNAPSHOTS_SQL}
    SELECT l_orderkey, l_partkey, grp AS "group", nullif(typ, '') AS type,
      CASE WHEN l_linenumber = 6 THEN scope END AS scope,
      CASE WHEN l_linenumber IN (3, 5, 7) THEN CAST(l_suppkey AS VARCHAR) END AS topic,
      CASE WHEN l_linenumber IN (5, 7) THEN CAST(l_linenumber AS VARCHAR) END AS partition,
      CAST(NULL AS VARCHAR) AS a
    FROM snaps""")
def metric_name_tags(spark, sf_dir):
    rows = snapshots(spark, sf_dir).withColumn("t", T.metric_name_tags("group", "type", "scope"))
    return rows.select("l_orderkey", F.substring("name", 6, 20).cast("bigint").alias("l_partkey"),
                       *[F.col("t")[k].alias(k) for k in _SCOPE_TAGS])


@query("p05_decompose_scope", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2 END AS n,
      CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN 'twice' ELSE o_orderpriority END AS topic,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS partition,
      o_orderstatus = 'P' AS odd
    FROM orders""")
def decompose_scope(spark, sf_dir):
    text = F.concat(F.lit("topic."), F.col("o_orderpriority"), F.lit(".partition."),
                    F.col("o_custkey").cast("string"))
    scope = (F.when(F.col("o_orderstatus") == "P", F.concat(text, F.lit(".more")))
             .when(F.col("o_orderstatus") == "F", F.concat(text, F.lit(".topic.twice..")))
             .otherwise(text))
    rows = table(spark, sf_dir, "orders").withColumn("scope", scope)
    rows = rows.withColumn("t", T.decompose_scope("scope"))
    return rows.select("o_orderkey", F.size("t").alias("n"), F.col("t")["topic"].alias("topic"),
                       F.col("t")["partition"].alias("partition"),
                       T.scope_is_odd(F.lit("kafka.x"), "scope").alias("odd"))


@query("p06_object_name_parts", """
    SELECT c_custkey, 'kafka.consumer' AS domain, 'Group' AS type, c_mktsegment AS "group",
      'a,b=' || c_nationkey AS quoted, 4 AS n
    FROM customer""")
def object_name_parts(spark, sf_dir):
    name = F.concat(
        F.lit("kafka.consumer:type=Group,name="), "c_name", F.lit(",group="), "c_mktsegment",
        F.lit(',quoted="a,b='), F.col("c_nationkey").cast("string"), F.lit('"'))
    rows = table(spark, sf_dir, "customer").withColumn("p", T.object_name_parts(name))
    props = F.col("p.key_props")
    return rows.select("c_custkey", "p.domain", props["type"].alias("type"),
                       props["group"].alias("group"),
                       F.trim(props["quoted"], F.lit('"')).alias("quoted"), F.size(props).alias("n"))


@query("p07_series_key", f"""
    WITH {MEASUREMENTS_SQL}
    SELECT name, 'group=' || grp || ',name=' || dash || ',service=' || service
      || coalesce(',topic=' || topic, '') AS key, count(*) AS n, CAST(1 AS BIGINT) AS hashes
    FROM m GROUP BY ALL""")
def series_keys(spark, sf_dir):
    df = measurements(spark, sf_dir).select(series_key().alias("k"), series_hash().alias("h"))
    rows = df.groupBy("k").agg(F.count("*").alias("n"), F.count_distinct("h").alias("hashes"))
    pairs = F.transform("k.tags", lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.select("k.name", F.array_join(pairs, ",").alias("key"), "n", "hashes")


@query("p13_millis", """
    SELECT event_id, epoch_us(ts) // 1000 AS ms, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts
    FROM events""")
def millis(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", V.to_millis(F.col("ts")).alias("ms"))
    return rows.select("event_id", "ms", V.from_millis(F.col("ms")).alias("ts"))


@query("p14_service_tag", "SELECT n_nationkey, 'broker-' || n_nationkey AS service FROM nation")
def service_tag(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", T.service_tag("n_nationkey").alias("service"))


@query("f01_drop_empty", "SELECT event_id FROM events WHERE value >= 50")
def empty_dropped(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("fields", F.map_filter(
        F.create_map(F.lit("Value"), F.col("value")), lambda _k, v: v >= 50))
    return drop_empty(rows).select("event_id")


@query("f02_finite_only", """
    SELECT l_orderkey, l_partkey, l_quantity / l_discount AS ratio FROM lineitem WHERE l_discount <> 0""")
def finite_only(spark, sf_dir):
    ratio = F.when(F.col("l_discount") != 0, F.col("l_quantity") / F.col("l_discount")).when(
        F.col("l_linenumber") > 3, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", ratio.alias("ratio"))
    return V.finite_only(rows, "ratio")


@query("f03_scope_match", f"""
    WITH {BEANS_SQL}
    SELECT 'kafka.server:' || p_type || ',' || p_partkey AS bean, attr, true AS any_kafka,
      p_type = 'PROMO' AS is_promo, p_type = 'PROMO' AND starts_with(p_brand, 'Brand#1') AS is_promo_brand,
      false AS only_type FROM part_attrs
    UNION ALL
    SELECT 'java.lang:Supplier,' || s_suppkey, attr, false, false, false, false FROM supplier_attrs""")
def scope_match(spark, sf_dir):
    rows = beans(spark, sf_dir)
    text_or_nan = F.coalesce(V.any_to_double(rows, "value_double"), V.any_to_double(rows, "value_long"))
    rows = rows.filter(text_or_nan.isNotNull() & T.scope_match("*:*"))
    props = F.col("key_props")
    key = F.coalesce(props["id"], F.substring(props["name"], 6, 20))
    return rows.select(
        F.concat("domain", F.lit(":"), props["type"], F.lit(","), key).alias("bean"), "attr",
        T.scope_match("kafka.*:*").alias("any_kafka"),
        T.scope_match("kafka.server:type=PROMO,*").alias("is_promo"),
        T.scope_match("kafka.?erver:type=PROMO,group=Brand#1*,*").alias("is_promo_brand"),
        T.scope_match("kafka.server:type=PROMO").alias("only_type"))


@query("f08_exclude_prefix", """
    SELECT o_orderkey, o_orderpriority FROM orders WHERE NOT starts_with(o_orderpriority, '4-NOT')""")
def prefix_excluded(spark, sf_dir):
    rows = exclude_prefix(table(spark, sf_dir, "orders"), "o_orderpriority", "4-NOT")
    return rows.select("o_orderkey", "o_orderpriority")


@query("f09_metric_is", """
    SELECT CAST(l_shipdate AS TIMESTAMP) AS ts, CAST(l_suppkey AS VARCHAR) AS topic,
      l_linenumber AS partition, l_orderkey AS end_offset
    FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_linenumber <> 7""")
def metric_selected(spark, sf_dir):
    text = lambda c: F.col(c).cast("string")
    metrics = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.when(F.col("l_returnflag") == "A", "kafka.log").otherwise("kafka.server").alias("group"),
        F.when(F.col("l_linestatus") == "F", "LogEndOffset").otherwise("LogStartOffset").alias("name"),
        F.concat(F.lit("topic."), text("l_suppkey"), F.when(F.col("l_linenumber") == 7, ".size.")
                 .otherwise(".partition."), text("l_linenumber")).alias("scope"),
        F.col("l_orderkey").cast("double").alias("value"))
    return end_offsets_from_metrics(metrics)


@query("f10_json_shape_ok", """
    SELECT event_id, event_type <> 'error' AND event_type <> 'click' AS ok,
      CASE WHEN event_type = 'click' THEN 'unrecognized JSON metric format' END AS error
    FROM events""")
def json_shape(spark, sf_dir):
    text = F.when(F.col("event_type") == "click", F.col("props")).otherwise(json_text())
    rows = parse_snapshot(events(spark, sf_dir).withColumn("value", text), "value")
    return rows.select("event_id", F.coalesce(json_shape_ok(), F.lit(False)).alias("ok"),
                       snapshot_error().alias("error"))


@query("f11_controller_only", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_suppkey % 3 = l_partkey % 3""")
def controllers_only(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_suppkey") % 3).alias("reporter_id"),
        (F.col("l_partkey") % 3).alias("controller_id"))
    return controller_only(rows).drop("reporter_id", "controller_id")


_FIELD = """[
  'buffered-count-SystemStreamPartition [sys, topic, 5]', 'sys-topic-10-messages-behind',
  'sys-some-host-9092-bytes-read', 'taskname-partition 4-sends', 'partition 4-restore-time',
  'commit-calls', 'window_ns'][event_id % 7 + 1]"""


@query("d05_tag_samza_field", f"""
    WITH e AS (SELECT event_id, event_type = 'view' AS other, event_id % 7 AS k, {_FIELD} AS name FROM events)
    SELECT event_id,
      CASE WHEN other THEN name ELSE ['buffered-count', 'messages-behind', 'bytes-read', 'sends',
        'restore-time', 'calls', 'window_ns'][k + 1] END AS field,
      CASE WHEN NOT other THEN ['sys', 'sys', 'sys', NULL, NULL, 'commit', NULL][k + 1] END AS system,
      CASE WHEN NOT other AND k < 2 THEN 'topic' END AS topic,
      CASE WHEN NOT other THEN ['5', '10', NULL, '4', '4', NULL, NULL][k + 1] END AS partition,
      CASE WHEN NOT other AND k = 2 THEN 'some-host-9092' END AS broker,
      CASE WHEN NOT other AND k = 3 THEN 'taskname' END AS task
    FROM e""")
def samza_fields(spark, sf_dir):
    names = F.get_json_object(json_text(), "$.metrics")
    group = F.when(F.col("event_type") == "view", "org.apache.other").otherwise("org.apache.samza.m")
    field = F.map_keys(F.map_values(F.from_json(names, "map<string,map<string,string>>"))[0])[0]
    rows = events(spark, sf_dir).select("event_id", tag_samza_field(group, field).alias("s"))
    return rows.select("event_id", "s.field", *[f"s.tags.{t}" for t in FIELD_TAGS])


@query("j02_enrich_with_inventory", """
    SELECT c_custkey, 'customer' AS kind,
      CASE WHEN c_nationkey < 20 THEN lower(n_name) END AS host,
      CASE WHEN c_mktsegment = 'BUILDING' THEN 'own' WHEN c_nationkey < 20 THEN 'broker-' || c_nationkey END AS service,
      CASE WHEN c_nationkey < 20 THEN 'main' END AS name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def inventory(spark, sf_dir):
    known = F.col("c_nationkey") < 20
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.lower("n_name").alias("_host"))
    rows = table(spark, sf_dir, "customer").join(nations, "c_nationkey").select(
        "c_custkey",
        F.concat("_host", F.lit(":"), F.when(known, F.lit(9000) + F.col("c_nationkey")).otherwise(1)
                 .cast("string")).alias("address"),
        T.overlay_map(T.literal_map({"kind": "customer"}), T.present_tags(
            service=F.when(F.col("c_mktsegment") == "BUILDING", "own"))).alias("tags"))
    rich = enrich_with_inventory(rows, brokers(spark, sf_dir), "main", ["c_custkey"])
    return rich.select("c_custkey", *[F.col("tags")[t].alias(t) for t in ("kind", "host", "service", "name")])


@query("j02_broker_addresses", """
    SELECT CAST(n_nationkey AS VARCHAR) AS id, n_nationkey + 1 AS section,
      lower(n_name) || ':' || (9000 + n_nationkey) AS address, 'broker-' || n_nationkey AS service
    FROM nation""")
def addresses(spark, sf_dir):
    return broker_addresses(brokers(spark, sf_dir)).select("id", "section", "address", "service")
