"""Stored points: Parquet by UTC day and bucket, in commits, resolved to one row per point when read.

A write puts its files into a folder of its own and then commits it: an entry of the store's log (``ledger``) names
the folders by day that it adds and those it takes away. Readers see whole commits only. A write is known by its
writer and its batch. Several jobs may write to one store, each under a writer id of its own; writing a batch
again replaces the same batch of the same writer.

Writes rank by when they began, then by writer, batch and the order within the batch. When a write begins is a clock
reading, but always later than any the log knows, so within a store a slow clock misorders nothing; between stores (when one
is compacted into another) the clocks count. A batch that is written again keeps its rank, and so does each field through
compaction.

All writes of a point lie in one bucket (by series and hour), so points are resolved where they are read, without a shuffle,
and a series with most of the rows is spread over the buckets. To plan so, Spark has to know the files as an external
table; one is declared in the session's catalog for each version of a store that is read, over its live folders.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.values import truncate_millis, utc_day
from pulsegrid.operators.pack import long_fields, pack_fields
from pulsegrid.schema import tag_entries
from pulsegrid.sources.ledger import DIGITS, Folder, append, entry, numbers

# Tags that panels filter or group by. They get columns of their own, which
# Parquet can skip on.
HOT_TAGS = ("topic", "service", "group", "name")
DEFAULT_DATABASE = "metrics"
DEFAULT_RETENTION = "default"

BUCKETS = 8      # of a store that is new, at least
CELLS = 500_000  # values (and one a row) for each bucket of a new store, and for each task of a write
GROWN = 4        # times that much in a bucket, readers no longer take a bucket for a task
STREAMED = 200   # tasks, at most, to which a shuffle sends rows without holding them (Spark's default)
SLOT = 3600      # seconds of a series that lie in one bucket
SNAPSHOT = 50    # every so many entries one has the whole state
RANK = ("made", "writer", "batch", "seq")

STORED_SCHEMA = (
    "ts timestamp, name string, tags map<string,string>, fields map<string,double>, "
    + ", ".join(f"tag_{t} string" for t in HOT_TAGS) + ", seq bigint, made bigint, writer string, batch bigint, slot bigint")
POINT_SCHEMA = STORED_SCHEMA + ", commit string, d date"


class Conflict(Exception):
    """What was compacted has been replaced meanwhile."""


@dataclass
class State:
    """What the log says: live folders (commit, day) with their writer, batch and rank; the last batch of each named
    writer with its rank, which it keeps when it is written again, also after it was compacted; how much is in a commit."""

    live: dict[tuple[str, str], tuple[str, int, int]]
    last: int
    buckets: int | None
    writers: dict[str, tuple[int, int]]
    cells: dict[str, int]  # of each live commit

    def held(self) -> int:
        return sum(self.cells.get(c, 0) for c in {c for c, _ in self.live})

    def dumped(self) -> list[list]:
        return [[*key, *value] for key, value in sorted(self.live.items())]


def promote_tags(df: DataFrame) -> DataFrame:
    """Add a column ``tag_<key>`` for every hot tag."""
    return df.select("*", *[F.col("tags")[t].alias(f"tag_{t}") for t in HOT_TAGS])


def points_path(path: str, database: str = DEFAULT_DATABASE,
                retention: str = DEFAULT_RETENTION) -> str:
    return f"{path}/{database}/{retention}"


def log_state(log: Folder, below: int | None = None) -> State:
    """The state after all entries, or those below a number."""
    known = [n for n in numbers(log) if below is None or n < below]
    whole = [n for n in known if n % SNAPSHOT == 0]
    state = State({}, 0, None, {}, {})
    for number in known:
        if whole and number < whole[-1]:
            continue
        found = entry(log, number)
        state.last, state.buckets = found["last"], found["buckets"]
        if "live" in found:
            state.live = {(c, d): (w, b, m) for c, d, w, b, m in found["live"]}
            state.writers = {w: (b, m) for w, b, m in found["writers"]}
            state.cells = found.get("cells", {})
            continue
        state.cells.update(found.get("cells", {}))
        if found.get("named"):
            state.writers[found["begin"][0]] = (found["begin"][1], found["made"])
        for key in found.get("remove", ()):
            state.live.pop(tuple(key), None)
        for c, d, w, b, m in found.get("add", ()):
            state.live[c, d] = (w, b, m)
    return state


def _log(log: Folder, change) -> dict:
    """Add an entry: ``change`` makes it from the state so far."""
    def make(number: int) -> dict:
        state = log_state(log, number)
        made = change(state)
        if number % SNAPSHOT == 0:
            for key in made.get("remove", ()):
                state.live.pop(tuple(key), None)
            for c, d, w, b, m in made.get("add", ()):
                state.live[c, d] = (w, b, m)
            if made.get("named"):
                state.writers[made["begin"][0]] = (made["begin"][1], made["made"])
            made = made | {"live": state.dumped(), "writers": [[w, *x] for w, x in sorted(state.writers.items())],
                           "cells": {c: n for c, n in (state.cells | made.get("cells", {})).items() if c in {c for c, _ in state.live}}}
        return made
    return append(log, make)


def _cells(df: DataFrame) -> int:
    """How much there is to write: a value counts for one, and so does a row."""
    return df.agg(F.sum(F.greatest(F.size("fields"), F.lit(0)) + 1)).first()[0] or 0


def _tasks(buckets: int, cells: int) -> int:
    """A task has one bucket, or part of one where there is much to write: a number of tasks that is a multiple of that of
    buckets cuts each bucket by itself."""
    return buckets * max(1, -(-cells // (buckets * CELLS)))


def _dealt(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows by slot, from senders of any size. To many tasks a sender holds in memory all that it sends, so rows go to fewer
    first; each of these then holds its part of them, whatever the input's files are like."""
    if tasks > STREAMED:
        # by a column of its own: Spark drops a repartition that stands directly below another
        rows = rows.withColumn("_to", F.col("slot")).repartition(STREAMED, "_to").drop("_to")
    return rows.repartition(tasks, "slot")


def _store(rows: DataFrame, base: str, buckets: int) -> tuple[str, list[str]]:
    """Write stored rows, dealt by bucket, to a new folder, by day and bucket; its commit id and days."""
    spark, commit = rows.sparkSession, uuid.uuid4().hex
    name = f"pulsegrid_write_{commit}"
    # a task has one bucket at most, so a day of a commit has a file for each task at most; Parquet skips by name
    (rows.write.format("parquet").partitionBy("d").bucketBy(buckets, "slot")
     .sortBy("name", "ts").option("path", f"{base}/data/commit={commit}").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay
    days = [n[2:] for n in Folder(spark, f"{base}/data").names(f"commit={commit}") if n.startswith("d=")]
    return commit, days


def write_points(df: DataFrame, path: str, batch: int, order: str | None = None,
                 database: str = DEFAULT_DATABASE, retention: str = DEFAULT_RETENTION,
                 writer: str | None = None, buckets: int | None = None) -> None:
    """Commit one batch of measurements.

    ``writer`` names who writes, and writing the same batch of the same writer again replaces it, so a retried batch
    leaves no copies. Without a writer the write is one of its own and replaces nothing. ``order`` ranks the
    writes within the batch. ``buckets`` counts for a new store only; without it, a new store has as many as its
    first write needs, so that a reader's task has its share however much there is. What is written is counted first,
    so ``df`` is read twice unless it is persisted.
    """
    spark, base = df.sparkSession, points_path(path, database, retention)
    log, named, writer = Folder(spark, f"{base}/_log"), writer is not None, writer or uuid.uuid4().hex

    def begin(state: State) -> dict:
        mine = [m for w, b, m in state.live.values() if (w, b) == (writer, batch)]
        mine += [m for b, m in [state.writers.get(writer, (None, 0))] if b == batch]
        made = mine[0] if mine else max(time.time_ns() // 1000, state.last + 1)
        return {"begin": [writer, batch], "named": named, "made": made, "last": max(made, state.last),
                "buckets": state.buckets or buckets}

    cells = _cells(df)
    buckets = buckets or max(BUCKETS, -(-cells // CELLS))
    begun = _log(log, begin)
    hour = F.floor(F.unix_seconds("ts") / SLOT)
    rows = (df.withColumn("ts", truncate_millis(F.col("ts"))).withColumn("seq", F.lit(0) if order is None else F.col(order))
            .select("ts", "name", "tags", "fields", F.col("seq").cast("bigint"),
                    F.xxhash64("name", tag_entries("tags"), hour).alias("slot")))
    # what follows from the row or is the same in all of them is added behind the shuffle
    rows = promote_tags(_dealt(rows, _tasks(begun["buckets"], cells))).select(
        "*", F.lit(begun["made"]).cast("bigint").alias("made"), F.lit(writer).alias("writer"),
        F.lit(batch).cast("bigint").alias("batch"), utc_day(F.col("ts")).alias("d"))
    commit, days = _store(rows, base, begun["buckets"])

    def end(state: State) -> dict:
        return {"add": [[commit, day, writer, batch, begun["made"]] for day in days],
                "remove": [key for key, (w, b, _) in state.live.items() if (w, b) == (writer, batch)],
                "last": state.last, "buckets": state.buckets, "cells": {commit: cells}}

    _log(log, end)


def stored_points(spark: SparkSession, path: str, database: str = DEFAULT_DATABASE,
                  retention: str = DEFAULT_RETENTION) -> DataFrame:
    """All live writes as they were stored, with ``writer``, ``batch``, ``made``, ``seq`` and the day ``d``."""
    base = points_path(path, database, retention)
    return _live(spark, base, log_state(Folder(spark, f"{base}/_log")))


def _live(spark: SparkSession, base: str, state: State, days: set[str] | None = None) -> DataFrame:
    """The stored rows of the live folders (of some days), by bucket; where these hold too much, dealt to more tasks."""
    keys = sorted(k for k in state.live if days is None or k[1] in days)
    if not keys:
        return spark.createDataFrame([], POINT_SCHEMA)
    grown = state.held() > GROWN * CELLS * state.buckets
    name = "pulsegrid_points_" + md5(repr((base, keys, grown)).encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        columns = ", ".join(c.strip() for c in POINT_SCHEMA.split(", "))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (commit, d) "
                  + ("" if grown else f"CLUSTERED BY (slot) INTO {state.buckets} BUCKETS ") + f"LOCATION '{base}/data'")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS "
                  + " ".join(f"PARTITION (commit='{c}', d='{d}')" for c, d in keys))
    return _dealt(spark.table(name), -(-state.held() // CELLS)) if grown else spark.table(name)


def resolved(stored: DataFrame) -> DataFrame:
    """One row per point of stored rows; ``slot`` is part of what a point is, so that no row leaves its bucket."""
    rows = long_fields(stored.select("slot", "ts", "name", "tags", "fields", F.struct(*RANK).alias("_rank")))
    return pack_fields(rows, ["slot", "ts", "name"], order="_rank").select("ts", "name", "tags", "fields")


def read_points(spark: SparkSession, path: str, database: str = DEFAULT_DATABASE,
                retention: str = DEFAULT_RETENTION, where=None, fields: list[str] | None = None) -> DataFrame:
    """One row per point, the last write of each field kept.

    ``where`` maps the stored rows to a condition on day, name or tags. It is applied before
    points are resolved: all writes of a point agree in these, so nothing else changes. With
    ``fields`` only these are resolved, and points that have none of them give no row.
    """
    stored = stored_points(spark, path, database, retention)
    if where is not None:
        stored = stored.filter(where(stored))
    if fields is not None:
        stored = stored.withColumn("fields", F.map_filter("fields", lambda k, _v: k.isin(fields)))
    return promote_tags(resolved(stored)).withColumn("d", utc_day(F.col("ts")))


def winners(stored: DataFrame) -> DataFrame:
    """Stored rows without what later writes have overwritten: a row for each point and write that still counts."""
    rows = long_fields(stored.select("slot", "ts", "name", "tags", "fields", *RANK))
    point = ["slot", "ts", "name", "_tags"]
    single = rows.withColumn("_tags", tag_entries("tags")).groupBy(*point, F.col("field").alias("_field")).agg(
        F.max(F.struct(F.struct(*RANK).alias("rank"), "value")).alias("_newest"))
    packed = single.groupBy(*point, F.col("_newest.rank").alias("rank")).agg(
        F.map_from_entries(F.collect_list(F.struct("_field", "_newest.value"))).alias("fields"))
    tags = F.map_from_entries("_tags").alias("tags")
    return promote_tags(packed.select("ts", "name", tags, "fields", "rank.*", "slot")).select(
        *[c.split()[0] for c in STORED_SCHEMA.split(", ")], utc_day(F.col("ts")).alias("d"))


def compact_points(spark: SparkSession, path: str, target: str | None = None, database: str = DEFAULT_DATABASE,
                   retention: str = DEFAULT_RETENTION, before: str | None = None) -> None:
    """Leave one folder of each closed day: those before the UTC day ``before`` (today) that several commits wrote to.

    One commit swaps them all; each field keeps the rank of its write, so later and earlier writes meet it as they would
    have met the original. Writes that are committed meanwhile stay. Given a ``target``, the winners of all days are
    written to that store instead, with their ranks, and nothing of this one changes.
    """
    base = points_path(path, database, retention)
    if target is not None:
        state = log_state(Folder(spark, f"{base}/_log"))
        _copy(spark, base, state, points_path(target, database, retention))
        return
    while not _compacted(spark, base, before or time.strftime("%Y-%m-%d", time.gmtime())):
        pass  # what it read has been replaced meanwhile


def _compacted(spark: SparkSession, base: str, before: str) -> bool:
    log = Folder(spark, f"{base}/_log")
    state = log_state(log)
    counts: dict[str, int] = {}
    for _, day in state.live:
        counts[day] = counts.get(day, 0) + 1
    days = {day for day, n in counts.items() if n > 1 and day < before}
    if not days:
        return True
    inputs = sorted(k for k in state.live if k[1] in days)
    cells = sum(state.cells.get(c, 0) for c in {c for c, _ in inputs})  # at most
    left = winners(_live(spark, base, state, days))
    commit, written = _store(left.repartition(_tasks(state.buckets, cells), "slot"), base, state.buckets)

    def swap(now: State) -> dict:
        if any(k not in now.live for k in inputs):
            raise Conflict
        return {"add": [[commit, day, f"compaction-{commit}", 0, 0] for day in written], "remove": inputs,
                "last": now.last, "buckets": now.buckets, "cells": {commit: cells}}

    try:
        _log(log, swap)
    except Conflict:
        return False
    return True


def _copy(spark: SparkSession, base: str, state: State, target: str) -> None:
    log = Folder(spark, f"{target}/_log")
    begun = _log(log, lambda s: {"last": max(s.last, state.last), "buckets": s.buckets or state.buckets or BUCKETS})
    cells = state.held()  # at most
    left = winners(_live(spark, base, state))
    commit, days = _store(left.repartition(_tasks(begun["buckets"], cells), "slot"), target, begun["buckets"])
    _log(log, lambda s: {"add": [[commit, day, f"compaction-{commit}", 0, 0] for day in days], "last": s.last,
                         "buckets": s.buckets, "cells": {commit: cells}})


def drop_replaced(spark: SparkSession, path: str, database: str = DEFAULT_DATABASE, retention: str = DEFAULT_RETENTION,
                  age: int = 7 * 86400) -> list[str]:
    """Delete folders that no commit holds any more and that are ``age`` seconds old: nobody reads these by then.

    Returns their names. Folders of writes that have not ended are younger than that.
    """
    base = points_path(path, database, retention)
    data, state = Folder(spark, f"{base}/data"), log_state(Folder(spark, f"{base}/_log"))
    gone = []
    for commit in data.names():
        for day in data.names(commit):
            name = f"{commit}/{day}"
            dead = day.startswith("d=") and (commit.removeprefix("commit="), day[2:]) not in state.live
            if dead and time.time() * 1000 - data.modified(name) >= age * 1000:
                data.delete(name)
                gone.append(name)
    return gone


def write_archive(df: DataFrame, path: str, timezone: str = "Etc/GMT+1", mode: str = "append") -> None:
    """Parquet by day of a time zone (``Etc/GMT+1`` is one hour behind UTC)."""
    (archive_day(df, timezone).hint("rebalance", "d").sortWithinPartitions("d", "name", "ts")
     .write.mode(mode).partitionBy("d").parquet(path))


def archive_day(df: DataFrame, timezone: str = "Etc/GMT+1") -> DataFrame:
    return df.withColumn("d", F.date_format(F.from_utc_timestamp("ts", timezone), "yyyy-MM-dd"))
