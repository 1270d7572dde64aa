"""Streaming jobs: from a topic to stored points, and panels that go on."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from threading import Event

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.functions.tags import group_tag, with_fixed_tags
from pulsegrid.functions.values import interval_seconds
from pulsegrid.operators.buckets import aggregate
from pulsegrid.operators.skew import SALTS
from pulsegrid.operators.sketches import PARTS, sketch_of
from pulsegrid.plans.panels import PANELS, Range, panel_filter, shown_series
from pulsegrid.schema import series_key, tag_entries
from pulsegrid.sources.envelope import decode_envelope, split_rejects
from pulsegrid.sources.points import DEFAULT_DATABASE, DEFAULT_RETENTION, write_points

DEFAULT_INTERVAL = 10
SEEN = 200_000  # deliveries whose copies a task drops by itself


def tick_trigger(interval: int | str | None = DEFAULT_INTERVAL) -> dict:
    """Trigger settings: every interval, or, with None, once over all that is there."""
    if interval is None:
        return {"availableNow": True}
    return {"processingTime": f"{interval_seconds(interval)} seconds"}


def union_streams(sources: dict[str, DataFrame], tag: str = "dc", delays: dict[str, str] | None = None) -> DataFrame:
    """Several streams or tables of measurements as one, each tagged with where it is from.

    ``delays`` gives each stream a watermark of its own. What follows waits for the slowest of them (the least
    watermark, Spark's rule unless ``spark.sql.streaming.multipleWatermarkPolicy`` says otherwise), so a source that is days
    behind the others loses nothing; a watermark on the union would go with the fastest.
    """
    if delays:
        if set(delays) != set(sources):
            raise ValueError("each source needs a delay")
        policy = next(iter(sources.values())).sparkSession.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min")
        if policy != "min":
            raise ValueError("the watermark must be the least of the sources'")
    tagged = [with_fixed_tags(df.withWatermark("ts", delays[name]) if delays else df, {tag: name})
              for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def load_topic_to_points(records: DataFrame, path: str, checkpoint: str,
                         interval: int | str | None = DEFAULT_INTERVAL,
                         database: str = DEFAULT_DATABASE,
                         retention: str = DEFAULT_RETENTION) -> StreamingQuery:
    """Topic records to stored points; records that cannot be decoded go to ``<path>/rejects``.

    One job serves all partitions of the topic; several jobs may feed one store. A job writes
    under the id that its checkpoint keeps, and each batch replaces its own folder, so a batch that
    is tried again leaves no copies and jobs leave each other's alone. Records delivered twice
    are resolved when points are read.
    """
    known, job = Event(), {}

    def store(batch: DataFrame, batch_id: int) -> None:
        known.wait()
        # by size, not by file: a task's share of what is decoded, and kept, does not grow with the batch
        dealt = batch.hint("rebalance", "offset")
        decoded = decode_envelope(dealt.withColumn("payload", F.col("value")))
        decoded = decoded.withColumn("payload", F.when(F.col("error").isNotNull(), F.col("payload"))).persist()
        try:
            good, bad = split_rejects(decoded)
            write_points(good, path, batch_id, "offset", database, retention, job["id"])
            (bad.write.mode("overwrite").option("partitionOverwriteMode", "static")
             .parquet(f"{path}/rejects/writer={job['id']}/batch={batch_id}"))
        finally:
            decoded.unpersist()

    query = (records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(**tick_trigger(interval)).start())
    job["id"] = str(query.id)
    known.set()
    return query


def drop_redelivered(df: DataFrame, delay: str = "10 minutes",
                     spread: list[str] | None = None, salts: int = SALTS) -> DataFrame:
    """Each delivery of a point once, of all its copies within ``delay``: the same series, time and
    fields. Deliveries of one point with other fields all stay; merging them is what upsert does.

    Copies are dropped before the shuffle. In a stream a task drops those of the last ``SEEN`` deliveries it has read, and a
    state of one short row for each delivery that was kept drops the rest. Where one point may come very often from very
    many tasks, ``spread`` names columns that differ between its deliveries (partition and offset): these deal the copies
    to several tasks first, which drop theirs, before the last is chosen.
    """
    if not df.isStreaming:
        copy = ["_series", "ts", "_fields"]
        keyed = df.withColumn("_series", series_key()).withColumn("_fields", tag_entries("fields"))
        return keyed.dropDuplicates(copy).drop("_series", "_fields")
    keyed = df.withWatermark("ts", delay).withColumns(delivery_code())
    copy = ["_copy1", "_copy2"]
    if spread:
        keyed = keyed.repartition(*copy, F.pmod(F.xxhash64(*spread), F.lit(salts)))
    return keyed.filter(_first_seen(*copy)).dropDuplicatesWithinWatermark(copy).drop(*copy)


def delivery_code() -> dict[str, Column]:
    """What a delivery says (name, tags, time and fields) as 128 bits, in two numbers.

    Hashes pass over nulls and the sign of a zero, so these count by their places. By chance, one pair among 10^12 deliveries would agree with
    a probability of about 10^-15.
    """
    def mark(v: Column) -> Column:
        return F.when(v.isNull(), 0).when(v == 0, F.when(v.cast("string") == "-0.0", 1).otherwise(2)).otherwise(3)

    said = [F.col("name").isNull(), F.col("name"), F.size("tags"), F.size("fields"), F.unix_micros("ts"),
            F.transform(tag_entries("tags"), lambda e: e["value"].isNull()),
            F.transform(tag_entries("fields"), lambda e: mark(e["value"])), tag_entries("tags"), tag_entries("fields")]
    return {f"_copy{k}": F.xxhash64(F.lit(k), *said) for k in (1, 2)}


@F.arrow_udf(T.BooleanType())
def _first(one: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    seen: set[tuple[int, int]] = set()
    for parts in one:
        new = []
        for copy in zip(*(part.to_pylist() for part in parts), strict=True):
            new.append(copy not in seen)
            seen.add(copy)
        if len(seen) >= SEEN:
            seen.clear()
        yield pa.array(new, pa.bool_())


# it depends on the rows before, so that it is to run once, where it stands
_first_seen = _first.asNondeterministic()


def stream_panel(df: DataFrame, keep: Column, keys: dict[str, Column], width: int | str,
                 aggregates: dict[str, tuple[str, str]], delay: str | None = "30 minutes") -> DataFrame:
    """Bucketed aggregates (as ``bucket_agg``) over a stream of measurements.

    ``aggregates``: column name to (how, field). A bucket is given out once ``delay`` has
    passed; what comes later than that is not counted, unlike in a panel over stored points. Without ``delay``
    the stream has watermarks already.
    A median is taken from a bounded sketch here, as the state of an exact one would grow with
    the stream.
    """
    fields = sorted({f for _how, f in aggregates.values()})
    rows = df.filter(keep).select(
        "ts", *[F.coalesce(c, F.lit("")).alias(k) for k, c in keys.items()],
        *[F.col("fields")[f].alias(f"_{f}") for f in fields])
    columns = [
        (F.percentile_approx(f"_{f}", 0.5, 10000) if how == "median" else aggregate(how, f"_{f}", "ts"))
        .alias(name) for name, (how, f) in aggregates.items()]
    window = F.window("ts", f"{interval_seconds(width)} seconds")
    panels = (rows.withWatermark("ts", delay) if delay else rows).groupBy(window.alias("_w"), *keys).agg(*columns)
    return panels.select(F.col("_w.start").alias("bucket"), *keys, *aggregates)


def stream_panel_series(df: DataFrame, panel_id: str, asked: Range, width: int | None = None,
                        delay: str = "30 minutes") -> DataFrame:
    """A panel of the cluster dashboard by its id over a stream, as ``panel_series`` shows it.

    Buckets without any measurement are not made up, and medians come from bounded sketches.
    """
    panel = PANELS[panel_id]
    table = stream_panel(df, panel_filter(df, panel, asked), {k: group_tag(df, k) for k in panel.by},
                         width or asked.width(panel), {t.column: (t.how, t.field) for t in panel.targets}, delay)
    for t in panel.targets:
        if t.negative:
            table = table.withColumn(t.column, -F.col(t.column))
    return shown_series(table, panel)


def stream_sketches(df: DataFrame, panel_id: str, asked: Range, width: int | str, delay: str = "30 minutes") -> DataFrame:
    """Sketches of a panel's field in closed buckets of a stream, to be stored and read by ``evaluate_sketches``.

    ``width`` is that of the narrowest panel to be drawn; wider ones merge what is stored.
    """
    panel = PANELS[panel_id]
    rows = df.filter(panel_filter(df, panel, asked)).select(
        "ts", *[group_tag(df, k).alias(k) for k in panel.by], F.col("fields")[panel.targets[0].field].alias("_v"))
    window = F.window("ts", f"{interval_seconds(width)} seconds")
    closed = (rows.filter(F.col("_v").isNotNull()).withWatermark("ts", delay)
              .groupBy(window.alias("_w"), *panel.by).agg(*sketch_of("_v")))
    return closed.select(F.col("_w.start").alias("bucket"), *panel.by, *PARTS)


def keep_panel_numbers(df: DataFrame, panel_id: str, asked: Range, path: str, checkpoint: str, width: int | None = None,
                       delay: str = "30 minutes", interval: int | str | None = DEFAULT_INTERVAL) -> StreamingQuery:
    """Keep the number of each series of a panel (``panel_number``) over a stream, for ``read_panel_numbers``.

    Two aggregations follow each other: buckets, which the stream gives out once each when they are closed; then sums, counts
    and the last value of the buckets of a batch, which are stored and add up. A batch that is tried again
    replaces its folder.
    """
    panel = PANELS[panel_id]
    if panel.reduce is None:
        raise ValueError(f"{panel.title} shows series, not numbers")
    target = panel.targets[0]
    closed = stream_panel(df, panel_filter(df, panel, asked), {k: group_tag(df, k) for k in panel.by},
                          width or asked.width(panel), {"value": (target.how, target.field)}, delay)

    def store(batch: DataFrame, batch_id: int) -> None:
        known = batch.filter(F.col("value").isNotNull())
        (known.groupBy(*panel.by).agg(F.sum("value").alias("total"), F.count("*").alias("buckets"),
                                      F.max(F.struct("bucket", "value")).alias("newest"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch_id}"))

    return (closed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**tick_trigger(interval)).start())


def read_panel_numbers(spark: SparkSession, path: str, panel_id: str) -> DataFrame:
    """The number of each series over all buckets that have been closed: keys, value."""
    panel = PANELS[panel_id]
    schema = ", ".join([*(f"{k} string" for k in panel.by),
                        "total double, buckets bigint, newest struct<bucket:timestamp,value:double>"])
    parts = spark.read.schema(schema).parquet(path)
    number = F.max("newest")["value"] if panel.reduce == "current" else F.sum("total") / F.sum("buckets")
    return parts.groupBy(*panel.by).agg(number.alias("value"), F.count("*").alias("_parts")).filter(
        F.col("_parts") > 0).drop("_parts")


def store_stream(df: DataFrame, path: str, checkpoint: str,
                 interval: int | str | None = DEFAULT_INTERVAL) -> StreamingQuery:
    """Append finished rows of a stream to Parquet."""
    return (df.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**tick_trigger(interval)).start())
