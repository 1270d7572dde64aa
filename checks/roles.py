"""How the given tables play the inputs of the package. Every role uses all rows of its table.

Each role has a Spark form (a function) and an SQL form (a constant with common table
expressions), written separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START, END = "2024-01-01", "2024-01-31"
HOUR = 3600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_files(df, part, path: str, parts: int):
    """A stream of ``df`` in as many batches: rows with the number ``part`` are in the file of that number."""
    for k in range(parts):
        df.filter(part == k).coalesce(1).write.mode("append").parquet(path)
    spark = df.sparkSession
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# event type -> measurement and group for even, then for odd event ids
METRICS = {
    "view": (("BytesInPerSec", "kafka.server"), ("MessagesInPerSec", "kafka.server")),
    "click": (("BytesOutPerSec", "kafka.server"), ("FailedFetchRequestsPerSec", "kafka.server")),
    "purchase": (("RequestsPerSec", "kafka.network"), ("PartitionCount", "kafka.server")),
    "signup": (("LogFlushRateAndTimeMs", "kafka.log"), ("UnderReplicatedPartitions", "kafka.server")),
    "error": (("NumDelayedOperations", "kafka.server"), ("ActiveControllerCount", "kafka.controller")),
}


def _metric(part: int) -> Column:
    even = F.col("event_id") % 2 == 0
    result = F.when(F.lit(False), F.lit(""))
    for event_type, pair in METRICS.items():
        is_type = F.col("event_type") == event_type
        result = result.when(is_type & even, pair[0][part]).when(is_type, pair[1][part])
    return result


def measurements(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Each event as one measurement of a broker; rates in and out also have a topic."""
    has_topic = F.col("event_type").isin("view", "click")
    tags = F.map_filter(F.create_map(
        F.lit("name"), F.lit("main"),
        F.lit("group"), _metric(1),
        F.lit("service"), F.concat(F.lit("broker-"), (F.col("user_id") % 3).cast("string")),
        F.lit("topic"), F.when(has_topic, F.concat(F.lit("t"), (F.col("user_id") % 10).cast("string"))),
    ), lambda _k, v: v.isNotNull())
    value = F.col("value")
    fields = F.create_map(*[x for name, v in {
        "Value": value, "OneMinuteRate": value / 60, "95thPercentile": value * 0.5,
        "98thPercentile": value, "99thPercentile": value * 1.5, "999thPercentile": value * 2,
    }.items() for x in (F.lit(name), v)])
    return events(spark, sf_dir).select(
        F.timestamp_millis(F.unix_millis("ts")).alias("ts"), _metric(0).alias("name"),
        tags.alias("tags"), fields.alias("fields"), *keep)


def panel_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same measurements with hot tags as columns, as stored points have them."""
    has_topic = F.col("event_type").isin("view", "click")
    return measurements(spark, sf_dir, "event_id", "user_id", "event_type", "value").select(
        "ts", "name", "tags", "fields", "event_id",
        F.when(has_topic, F.concat(F.lit("t"), (F.col("user_id") % 10).cast("string"))).alias("tag_topic"),
        F.concat(F.lit("broker-"), (F.col("user_id") % 3).cast("string")).alias("tag_service"),
        _metric(1).alias("tag_group"), F.lit("main").alias("tag_name"))


MEASUREMENTS_SQL = """
m AS (
  SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts, value, 'main' AS dash,
    CASE event_type
      WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'BytesInPerSec' ELSE 'MessagesInPerSec' END
      WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'BytesOutPerSec' ELSE 'FailedFetchRequestsPerSec' END
      WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'RequestsPerSec' ELSE 'PartitionCount' END
      WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'LogFlushRateAndTimeMs' ELSE 'UnderReplicatedPartitions' END
      WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'NumDelayedOperations' ELSE 'ActiveControllerCount' END
    END AS name,
    CASE
      WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'kafka.network'
      WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'kafka.log'
      WHEN event_type = 'error' AND event_id % 2 = 1 THEN 'kafka.controller'
      ELSE 'kafka.server'
    END AS grp,
    'broker-' || (user_id % 3) AS service,
    CASE WHEN event_type IN ('view', 'click') THEN 't' || (user_id % 10) END AS topic
  FROM events
)"""


def beans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of beans: parts are named beans, suppliers are beans without a name.

    The key property ``group`` of a part replaces the domain as the tag ``group``.
    """
    def attribute(name: str, kind: str, double=None, long=None, text=None) -> Column:
        return F.struct(
            F.lit(name).alias("attr"), F.lit(kind).alias("value_type"),
            (F.lit(None) if double is None else double).cast("double").alias("value_double"),
            (F.lit(None) if long is None else long).cast("bigint").alias("value_long"),
            (F.lit(None) if text is None else text).cast("string").alias("value_text"))

    scan_ts = F.lit(START).cast("timestamp")
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("host-"), (F.col("p_partkey") % 5).cast("string"), F.lit(":9010")).alias("address"),
        F.concat(F.lit("kafka.server:type="), F.col("p_type"), F.lit(",name=part-"),
                 F.col("p_partkey").cast("string"), F.lit(",group="), F.col("p_brand")).alias("object_name"),
        F.array(attribute("Price", "double", double=F.col("p_retailprice")),
                attribute("Size", "int", long=F.col("p_size")),
                attribute("Label", "string", text=F.col("p_name")),
                attribute("Ratio", "double", double=F.when(
                    F.col("p_size") > 25, F.lit(float("nan"))).otherwise(F.col("p_size") / 2.0))).alias("attrs"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("host-"), (F.col("s_suppkey") % 5).cast("string"), F.lit(":9010")).alias("address"),
        F.concat(F.lit("java.lang:type=Supplier,id="), F.col("s_suppkey").cast("string")).alias("object_name"),
        F.array(attribute("Balance", "double", double=F.col("s_acctbal")),
                attribute("Nation", "int", long=F.col("s_nationkey")),
                attribute("Title", "string", text=F.col("s_name"))).alias("attrs"))
    from pulsegrid.functions.tags import object_name_parts
    both = parts.unionByName(suppliers).withColumn("_name", object_name_parts("object_name"))
    return both.select(scan_ts.alias("scan_ts"), "address", "_name.domain", "_name.key_props",
                       F.explode("attrs").alias("_a")).select("scan_ts", "address", "domain", "key_props", "_a.*")


BEANS_SQL = """
part_attrs AS (
  SELECT p_partkey, 'host-' || (p_partkey % 5) || ':9010' AS address, p_type, p_brand, attr, v FROM (
    SELECT p_partkey, p_type, p_brand, 'Price' AS attr, p_retailprice AS v FROM part
    UNION ALL SELECT p_partkey, p_type, p_brand, 'Size', p_size FROM part
    UNION ALL SELECT p_partkey, p_type, p_brand, 'Ratio', p_size / 2.0 FROM part WHERE p_size <= 25)
),
supplier_attrs AS (
  SELECT s_suppkey, 'host-' || (s_suppkey % 5) || ':9010' AS address, attr, v FROM (
    SELECT s_suppkey, 'Balance' AS attr, s_acctbal AS v FROM supplier
    UNION ALL SELECT s_suppkey, 'Nation', s_nationkey FROM supplier)
)"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument snapshots: each line item is one instrument; its kind follows its flags."""
    flag = F.concat("l_returnflag", "l_linestatus")
    kind = (F.when(flag == "AF", "gauge").when(flag == "AO", "counter").when(flag == "NF", "meter")
            .when(flag == "NO", "histogram").when(flag == "RF", "timer").otherwise("client"))
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    values = F.create_map(*[x for name, v in {
        "Value": F.when(F.col("l_linenumber") == 7, F.lit(float("inf"))).otherwise(price),
        "Count": quantity, "MeanRate": price / 10, "OneMinuteRate": price / 20,
        "FiveMinuteRate": price / 40, "FifteenMinuteRate": price / 80, "Max": price,
        "Mean": price / 2, "Min": quantity, "StdDev": quantity / 2, "Sum": price * 2,
        "95thPercentile": price, "98thPercentile": price, "99thPercentile": price,
        "999thPercentile": price}.items() for x in (F.lit(name), v)])
    text = lambda c: F.col(c).cast("string")
    scope = (F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string"))
             .when(F.col("l_linenumber") == 2, F.lit(""))
             .when(F.col("l_linenumber") == 3, F.concat(F.lit("topic."), text("l_suppkey")))
             .when(F.col("l_linenumber") == 4, F.concat(F.lit("a.b."), text("l_suppkey")))
             .otherwise(F.concat(F.lit("topic."), text("l_suppkey"), F.lit(".partition."),
                                 text("l_linenumber"))))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("tick"), kind.alias("kind"),
        F.when(F.col("l_linenumber") == 6, "java.lang").otherwise("kafka.server").alias("group"),
        F.when(F.col("l_linenumber") == 5, "").otherwise("Item").alias("type"),
        F.concat(F.lit("item-"), text("l_partkey")).alias("name"), scope.alias("scope"),
        F.create_map(F.lit("client-id"), F.concat(F.lit("c"), text("l_suppkey"))).alias("client_tags"),
        values.alias("values"), "l_orderkey")


SNAPSHOTS_SQL = """
snaps AS (
  SELECT *, CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'gauge' WHEN 'AO' THEN 'counter'
      WHEN 'NF' THEN 'meter' WHEN 'NO' THEN 'histogram' WHEN 'RF' THEN 'timer' ELSE 'client' END AS kind,
    CASE WHEN l_linenumber = 6 THEN 'java.lang' ELSE 'kafka.server' END AS grp,
    CASE WHEN l_linenumber = 5 THEN '' ELSE 'Item' END AS typ,
    CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'topic.' || l_suppkey
      WHEN 4 THEN 'a.b.' || l_suppkey
      ELSE 'topic.' || l_suppkey || '.partition.' || l_linenumber END AS scope
  FROM lineitem
)"""


def end_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of logs over time: topic is the supplier, partition the line number."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_suppkey").cast("string").alias("topic"), F.col("l_linenumber").alias("partition"),
        F.col("l_orderkey").alias("end_offset"))


def committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed offsets: the group is the return flag; N plays a console consumer, and
    offsets of line number 7 of group A are missing."""
    group = F.when(F.col("l_returnflag") == "N", "console-consumer-7").otherwise(F.col("l_returnflag"))
    missing = (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"), group.alias("group_id"),
        F.col("l_suppkey").cast("string").alias("topic"), F.col("l_linenumber").alias("partition"),
        F.when(~missing, F.col("l_partkey")).alias("offset"))


def brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), F.lower("n_name").alias("host"),
        F.lit(9092).alias("port"), (F.lit(9000) + F.col("n_nationkey")).alias("jmx_port"))


def json_text(group: str = "org.apache.samza.m") -> Column:
    """A snapshot document per event. The field names meet all six patterns and none."""
    user = F.col("user_id").cast("string")
    name = F.concat(F.lit('"'), F.element_at(F.array(*[F.lit(x) for x in (
        "buffered-count-SystemStreamPartition [sys, topic, 5]", "sys-topic-10-messages-behind",
        "sys-some-host-9092-bytes-read", "taskname-partition 4-sends", "partition 4-restore-time",
        "commit-calls", "window_ns")]), (F.col("event_id") % 7 + 1).cast("int")), F.lit('"'))
    return F.concat(
        F.lit('{"header":{"time":'), F.unix_millis("ts").cast("string"),
        F.lit(',"reset-time":1,"version":"'),
        F.when(F.col("event_type") == "error", "0.0.2").otherwise("0.0.1"),
        F.lit('","samza-version":"1.0","job":"j'), user, F.lit('","count":3},"metrics":{"'),
        F.lit(group), F.lit('":{'), name, F.lit(":"), F.col("value").cast("string"),
        F.lit(',"k":'), F.get_json_object("props", "$.k"),
        F.lit(',"text":"5","flag":true,"none":null,"inner":{"x":1},"huge":'
              '123456789012345678901234567890}}}'))
