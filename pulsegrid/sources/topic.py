"""The topic of measurements, as a Kafka topic or as files of the same row layout."""

from __future__ import annotations

import uuid
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.schema import TOPIC_RECORD, series_hash
from pulsegrid.session import shared_dir
from pulsegrid.sources.envelope import to_topic_records
from pulsegrid.sources.ledger import Folder, append, entry, numbers

# Default names, and consumer settings that Spark spells differently or owns.
DEFAULT_TOPIC = "metrics"
PREFIX, PRODUCER = "consumer.", "producer."
RENAMED = {"auto.offset.reset": "startingOffsets"}
NOT_PASSED = ("topic", "numThreads", "group.id", "enable.auto.commit", "auto.commit.interval.ms")


def consumer_options(conf: dict[str, str]) -> dict[str, str]:
    """``consumer.*`` settings as options of Spark's Kafka source.

    Offsets are kept in the stream's checkpoint, so settings on committing them are left out;
    so are those of the old ZooKeeper consumer, which no broker reads.
    """
    options = {"subscribe": conf.get(f"{PREFIX}topic", DEFAULT_TOPIC)}
    for key, value in conf.items():
        name = key.removeprefix(PREFIX)
        if not key.startswith(PREFIX) or name in NOT_PASSED or name.startswith("zookeeper."):
            continue
        options[RENAMED.get(name, f"kafka.{name}")] = value
    if "startingOffsets" in options and options["startingOffsets"] not in ("earliest", "latest"):
        raise ValueError("consumer.auto.offset.reset must be earliest or latest")
    return options


def read_topic(spark: SparkSession, conf: dict[str, str], format: str = "kafka",
               path: str | None = None) -> DataFrame:
    """A stream of topic records. Only given settings with ``consumer.topic`` is there a topic.

    ``format="parquet"`` reads files of the same layout from ``path`` instead of a broker.
    """
    if f"{PREFIX}topic" not in conf:
        raise ValueError("no consumer.topic is set")
    if format == "kafka":
        return spark.readStream.format("kafka").options(**consumer_options(conf)).load()
    # files may lie in the folder itself or in those of single writes
    return (spark.readStream.schema(TOPIC_RECORD).format(format).option("recursiveFileLookup", "true").load(path)
            .filter(F.col("topic") == conf[f"{PREFIX}topic"]))


def order_by_series(df: DataFrame) -> DataFrame:
    """Rows of a series next to each other and in time order.

    Ranges of (series, time) are dealt to the tasks, so a series too large for one of them
    goes on, still in order, in the next; so do many copies of one point.
    """
    keyed = df.withColumn("_series", series_hash()).withColumn("_copy", F.monotonically_increasing_id())
    return (keyed.repartitionByRange("_series", "ts", "_copy")
            .sortWithinPartitions("_series", "ts").drop("_series", "_copy"))


def producer_options(conf: dict[str, str]) -> dict[str, str]:
    """``producer.*`` settings as options of Spark's Kafka sink, over the defaults of the reporter."""
    options = {"kafka.bootstrap.servers": "localhost:9092", "kafka.compression.type": "gzip", "kafka.linger.ms": "1000"}
    for key, value in conf.items():
        if key.startswith(PRODUCER) and key != f"{PRODUCER}topic":
            options[f"kafka.{key.removeprefix(PRODUCER)}"] = value
    return options


def write_topic(df: DataFrame, topic: str = DEFAULT_TOPIC, format: str = "kafka", path: str | None = None,
                conf: dict[str, str] | None = None, checkpoint: str | None = None,
                trigger: dict | None = None) -> StreamingQuery | None:
    """Measurements to a topic, keyed by series, so that a broker keeps each in order; gzip.

    Each series is written by one task in time order, as a broker keeps the order in which a producer
    sends. A stream is written batch by batch, given a ``checkpoint``. Files get the columns that a
    broker would add: a partition number (the series hash, cut to 16) and an offset from a range that the write has
    reserved in the topic's ledger, so offsets are unique whoever writes, and above those of writes before.
    A batch of a stream has a folder of its own; when it is tried again after it was written, nothing happens.
    """
    conf = conf or {}
    known, job = Event(), {}

    def send(batch: DataFrame) -> None:
        series = batch.withColumn("_series", series_hash())
        ordered = series.repartition("_series").sortWithinPartitions("_series", "ts").drop("_series")
        (to_topic_records(ordered).withColumn("topic", F.lit(topic)).write.format("kafka")
         .options(**producer_options(conf)).save())

    def put(batch: DataFrame, number: int = 0) -> None:
        if format == "kafka":
            send(batch)
            return
        if batch.isStreaming or checkpoint is not None:
            known.wait()
        write_files(batch, topic, format, path, f"{job.get('id') or uuid.uuid4()}-{number}")

    if not df.isStreaming:
        checkpoint = None
        put(df)
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint")
    query = (df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
    job["id"] = str(query.id)
    known.set()
    return query


OFFSETS = "_offsets"  # folder of the ledger: readers pass over names with an underscore
KEPT = 100  # entries of the ledger that are kept


def write_files(batch: DataFrame, topic: str, format: str, path: str, write: str) -> None:
    """Add a batch to the files of a topic, as the write of a given name; a write that is there already stays.

    The rows are put in order in a checkpoint first, where they are counted: a task's rows have the offsets of
    one stretch of the range. So nothing of the topic itself is read.
    """
    spark = batch.sparkSession
    if Folder(spark, path).exists(f"write={write}/_SUCCESS"):
        return
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    records = to_topic_records(order_by_series(batch), keep=["ts"]).checkpoint()
    part = F.spark_partition_id()
    sizes = records.groupBy(part.alias("part")).count().agg(F.max("part"), F.max("count")).first()
    parts, stride = (sizes[0] or 0) + 1, sizes[1] or 0
    first = reserve(spark, path, parts * stride)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2 ** 33 - 1))  # within the task
    (records.select("key", "value", F.lit(topic).alias("topic"), F.pmod(F.hash("key"), F.lit(16)).alias("partition"),
                    (F.lit(first) + part.cast("bigint") * stride + place).alias("offset"), F.col("ts").alias("timestamp"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "gzip")
     .format(format).save(f"{path}/write={write}"))


def reserve(spark: SparkSession, path: str, count: int) -> int:
    """The first of ``count`` offsets that no other write gets."""
    ledger = Folder(spark, f"{path}/{OFFSETS}")

    def make(number: int) -> dict:
        first = entry(ledger, number - 1)["next"] if number > 1 else 0
        return {"first": first, "next": first + count, "number": number}

    mine = append(ledger, make)
    for old in numbers(ledger):
        if old <= mine["number"] - KEPT:
            ledger.delete(f"{old:012d}.json")
    return mine["first"]
