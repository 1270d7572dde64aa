"""Consumer lag: committed offsets against the ends of the logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.tags import decompose_scope, scope_is_odd
from pulsegrid.operators.skew import salted_join
from pulsegrid.operators.upsert import latest

# Names of the two measurements, and of groups that are left out.
OFFSET_NAME = "ConsumerOffset"
LAG_NAME = "ConsumerLag"
CONSOLE_PREFIX = "console-consumer"
END_OFFSET_GROUP = "kafka.log"
END_OFFSET_NAME = "LogEndOffset"


def metric_is(group: str, name: str) -> Column:
    return (F.col("group") == group) & (F.col("name") == name)


def end_offsets_from_metrics(metrics: DataFrame, value: str = "value") -> DataFrame:
    """Ends of logs out of captured registry metrics (ts, group, name, scope, value)."""
    scope = decompose_scope("scope")
    ends = metrics.filter(metric_is(END_OFFSET_GROUP, END_OFFSET_NAME)
                          & ~scope_is_odd("group", "scope"))
    ends = ends.select("ts", scope["topic"].alias("topic"),
                       scope["partition"].try_cast("int").alias("partition"),
                       F.col(value).cast("bigint").alias("end_offset"))
    return ends.filter(F.col("topic").isNotNull() & F.col("partition").isNotNull())


def exclude_prefix(df: DataFrame, column: str, prefix: str = CONSOLE_PREFIX) -> DataFrame:
    return df.filter(~F.col(column).startswith(prefix))


def controller_only(df: DataFrame, reporter: str = "reporter_id",
                    controller: str = "controller_id") -> DataFrame:
    """Snapshots taken by the broker that was controller, so that each lag counts once."""
    return df.filter(F.col(reporter) == F.col(controller))


def consumer_lag(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """Newest committed offset and lag of every group and partition whose log end is known.

    ``end_offsets``: ts, topic, partition, end_offset. ``committed``: ts, group_id, topic,
    partition, offset. Console consumers and missing offsets are left out, and so are missing ends: the newest
    known end counts. A consumer ahead of it has lag 0.
    """
    ends = latest(end_offsets.filter(F.col("end_offset").isNotNull()).select("ts", "topic", "partition", "end_offset"),
                  ["topic", "partition"], ["ts"]).drop("ts")
    groups = exclude_prefix(committed.filter(F.col("offset").isNotNull()), "group_id")
    groups = latest(groups.select("ts", "group_id", "topic", "partition", "offset"),
                    ["group_id", "topic", "partition"], ["ts"])
    joined = salted_join(groups, ends, ["topic", "partition"], ["group_id"])
    lag = F.greatest(F.lit(0).cast("bigint"), F.col("end_offset") - F.col("offset"))
    return joined.select("ts", "group_id", "topic", "partition", "offset", "end_offset",
                         lag.alias("lag"))


def lag_measurements(lags: DataFrame) -> DataFrame:
    """Each row of ``consumer_lag`` as its two measurements."""
    def one(name: str, value: str) -> Column:
        return F.struct(F.lit(name).alias("name"), F.col(value).cast("double").alias("value"))
    rows = lags.withColumn("_m", F.explode(F.array(one(OFFSET_NAME, "offset"), one(LAG_NAME, "lag"))))
    tags = F.create_map(
        F.lit("type"), F.lit("Group"), F.lit("group"), F.col("group_id"),
        F.lit("topic"), F.col("topic"), F.lit("partition"), F.col("partition").cast("string"))
    return rows.select("ts", F.col("_m.name").alias("name"), tags.alias("tags"),
                       F.create_map(F.lit("Value"), F.col("_m.value")).alias("fields"))
