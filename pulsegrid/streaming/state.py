"""Values that a stream keeps for each key: the latest one, and what is reported at every tick.

Ticks are whole multiples of a width, counted from 1970. Of several updates the one with the greatest (time, value)
counts, whatever order they arrive in. Tasks leave the newest update of each key and tick before rows are shuffled, so
a key that is updated very often costs its state's task a few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsegrid.functions.values import floor_div, interval_seconds
from pulsegrid.operators.upsert import latest
from pulsegrid.streaming.jobs import DEFAULT_INTERVAL, tick_trigger

GROUPS = 1024  # of keys whose values are carried forward
ROWS = 10_000  # handed out at a time, however many ticks a key has to catch up on


def keep_latest(df: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str],
                interval: int | str | None = DEFAULT_INTERVAL) -> StreamingQuery:
    """Keep the last row of each key (as ``latest``) over a stream, in a table of changes at ``path``.

    A batch adds the keys that it changed, and replaces its own folder when it is tried again. An older row that
    arrives later changes nothing. The state has one row for each key.
    """
    def store(changed: DataFrame, batch_id: int) -> None:
        (changed.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{path}/batch={batch_id}"))

    return (latest(df, keys, order).writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**tick_trigger(interval)).start())


def read_latest(spark: SparkSession, path: str, schema, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, out of the changes that ``keep_latest`` has stored; ``schema`` is that of the stream."""
    changes = spark.read.schema(schema).parquet(path).select([f.name for f in schema.fields])
    return latest(changes, keys, order)


def _updates(df: DataFrame, keys: list[str], value: str, ts: str, width: int) -> DataFrame:
    """(keys, ts, _tick, _us, _value): the newest update that a task has seen of each key and tick, batch by batch.

    An update shows from the first tick at or after it.
    """
    micros = width * 1_000_000
    rows = df.filter(F.col(ts).isNotNull()).select(
        *keys, F.col(ts).alias("_ts"), floor_div(F.unix_micros(ts) + (micros - 1), micros).alias("_tick"),
        F.unix_micros(ts).alias("_us"), F.col(value).alias("_value"))

    def newest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield (part.sort_values(["_us", "_value"], na_position="first")
                   .drop_duplicates([*keys, "_tick"], keep="last"))

    return rows.mapInPandas(newest, rows.schema)


def _number(x):
    """A value out of pandas, null as None."""
    return None if x is None or x is pd.NaT or (isinstance(x, float) and x != x) else getattr(x, "item", lambda: x)()


def _rank(update: tuple) -> tuple:
    """Updates by time, then by value, null first."""
    us, value = update
    return us, value is not None, 0 if value is None else value


def _texts(df: DataFrame, keys: list[str]) -> Column:
    """The keys of a row as one text, from which ``_from_texts`` gets them back."""
    def text(field: T.StructField) -> Column:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.TimestampType):
            column = F.unix_micros(column)
        elif isinstance(kind, T.BinaryType):
            column = F.hex(column)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            column = column + F.lit(0).cast(kind)  # one zero
        elif not isinstance(kind, T.AtomicType):
            return F.to_json(F.struct(column.alias("k")))
        return column.cast("string")

    return F.to_json(F.array(*[text(f) for f in df.select(*keys).schema]))


def _from_texts(df: DataFrame, keys: list[str], texts: Column) -> list[Column]:
    def value(at: int, field: T.StructField) -> Column:
        column, kind = F.from_json(texts, "array<string>")[at], field.dataType
        if isinstance(kind, T.TimestampType):
            column = F.timestamp_micros(column.cast("bigint"))
        elif isinstance(kind, T.BinaryType):
            column = F.unhex(column)
        elif not isinstance(kind, T.AtomicType):
            column = F.from_json(column, T.StructType([T.StructField("k", kind)]))["k"]
        return column.cast(kind).alias(field.name)

    return [value(at, field) for at, field in enumerate(df.select(*keys).schema)]


def carry_forward_stream(updates: DataFrame, keys: list[str], value: str, width: int | str, ts: str = "ts",
                         delay: str = "1 hour", expire: int | None = None, groups: int = GROUPS) -> DataFrame:
    """``carry_forward`` over a stream: the value of each key at every tick that the watermark has passed.

    A timer goes off at the next tick, so a key without input goes on being reported: until it is updated, or
    for ``expire`` seconds if given. Rows are (keys, tick, value), each once. The state of a key is its value and
    the newest update of each tick within ``delay``; updates later than that are not seen.

    Every key is reported at every tick, so keys are kept and worked on in ``groups`` by their hash, not one by one: as
    many groups as leave each some thousands of keys. Their number stays as long as the checkpoint does.
    """
    width = interval_seconds(width)
    kind = updates.schema[value].dataType.simpleString()
    texts = updates.withWatermark(ts, delay).withColumn("_key", _texts(updates, keys))
    rows = _updates(texts, ["_key"], value, ts, width).withColumn("_group", F.pmod(F.xxhash64("_key"), F.lit(groups)))
    step = width * 1000
    stays = None if expire is None else -(-expire // width)
    named = ["_key", "_tick", "_us", "_value"]

    def plain(values) -> list:
        return [_number(v) for v in values]

    def report(_group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, at, since, held, *waiting = state.get if state.exists else ([], [], [], [], [], [], [], [])
        old = dict(zip(names, zip(map(int, at), map(int, since), plain(held), strict=True), strict=True))
        frames = [part[named] for part in parts if len(part)]
        if len(waiting[0]):
            frames.insert(0, pd.DataFrame(dict(zip(named, map(list, waiting), strict=True))))
        last = -(-state.getCurrentWatermarkMs() // step) - 1  # the last tick that no update can reach any more
        due, later = {}, pd.DataFrame(columns=named)
        if frames:
            seen = pd.concat(frames, ignore_index=True)
            seen = seen.sort_values(["_key", "_tick", "_us", "_value"], na_position="first").drop_duplicates(
                ["_key", "_tick"], keep="last")
            later, closed = seen[seen["_tick"] > last], seen[seen["_tick"] <= last]
            for name, tick, v in zip(closed["_key"], closed["_tick"], plain(closed["_value"]), strict=True):
                due.setdefault(name, []).append((int(tick), v))
        # stretches of ticks that show one value: whose, from, to (exclusive), the value
        shown, kept, still = [], {}, set(later["_key"])
        for name in [*old, *(n for n in due if n not in old)]:
            reached, begun, v = old.get(name, (None, None, None))
            steps = [] if begun is None else [(begun, v)]
            news = due.get(name, [])
            for k, (tick, v) in enumerate([*steps, *news]):
                first = reached + 1 if steps and k == 0 else tick if reached is None else max(tick, reached + 1)
                after = k + 1 - len(steps)
                stop = news[after][0] if after < len(news) else last + 1
                stop = stop if stays is None else min(stop, tick + stays)
                if stop > first:
                    shown.append((name, first, stop, v))
                reached = max(first, stop) - 1
                begun = tick
            if stays is None or last < begun + stays - 1 or name in still:
                kept[name] = reached, begun, v
        sizes = np.array([stop - first for _, first, stop, _ in shown], np.int64)
        ends = np.cumsum(sizes)
        for low in range(0, int(ends[-1]) if len(ends) else 0, ROWS):
            place = np.arange(low, min(low + ROWS, ends[-1]))
            which = np.searchsorted(ends, place, side="right")
            ticks = np.array([first for _, first, _, _ in shown])[which] + place - (ends - sizes)[which]
            yield pd.DataFrame({"_key": [shown[i][0] for i in which], "tick": pd.to_datetime(ticks * width, unit="s"),
                                "_value": [shown[i][3] for i in which]})
        if not kept and not len(later):
            if state.exists:
                state.remove()
            return
        state.update((list(kept), [x[0] for x in kept.values()], [x[1] for x in kept.values()], [x[2] for x in kept.values()],
                      later["_key"].tolist(), plain(later["_tick"]), plain(later["_us"]), plain(later["_value"])))
        following = min([x[0] + 1 for x in kept.values()]
                        + [int(t) for n, t in zip(later["_key"], later["_tick"], strict=True) if n not in kept])
        state.setTimeoutTimestamp(max(following * step + 1, state.getCurrentWatermarkMs() + 1))

    told = rows.groupBy("_group").applyInPandasWithState(
        report, f"_key string, tick timestamp, _value {kind}",
        f"names array<string>, at array<bigint>, since array<bigint>, held array<{kind}>, keys array<string>, "
        f"ticks array<bigint>, times array<bigint>, waiting array<{kind}>", "append", GroupStateTimeout.EventTimeTimeout)
    return told.select(*_from_texts(updates, keys, F.col("_key")), "tick", F.col("_value").alias(value))


def report_at_ticks(updates: DataFrame, keys: list[str], value: str, width: int | str, ts: str = "ts") -> DataFrame:
    """The latest value of each key at every tick of the clock, from its first update on: (keys, tick, value, set_at).

    A timer of each key goes off at the next tick, with or without input, as a scan at a fixed rate does. When batches
    come late, the ticks that passed meanwhile are made up for. To be run with ``tick_trigger(width)`` or shorter.
    """
    width = interval_seconds(width)
    kind = updates.schema[value].dataType.simpleString()
    step = width * 1000
    named = [*keys, "tick", value, "set_at"]

    def report(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, held_us, held = state.get if state.exists else (None, None, None)
        now = state.getCurrentProcessingTimeMs()
        tick = now // step
        best = None if at is None else (held_us, held)
        for part in parts:
            for us, v in zip(part["_us"], part["_value"], strict=True):
                update = int(us), _number(v)
                if best is None or _rank(update) > _rank(best):
                    best = update
        first = tick if at is None else at + 1
        out = []
        for t in range(first, tick + 1):
            # ticks that were missed showed what was known before this batch
            us, v = best if t == tick or at is None else (held_us, held)
            out.append((*key, pd.Timestamp(t * width, unit="s"), v, pd.Timestamp(us, unit="us")))
            if len(out) == ROWS:
                yield pd.DataFrame(out, columns=named)
                out = []
        if out:
            yield pd.DataFrame(out, columns=named)
        state.update((max(tick, first - 1), *best))
        state.setTimeoutDuration(step - now % step)

    rows = _updates(updates, keys, value, ts, width)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in updates.select(*keys).schema)
    return rows.groupBy(*keys).applyInPandasWithState(
        report, f"{fields}, tick timestamp, `{value}` {kind}, set_at timestamp", f"at bigint, held_us bigint, held {kind}",
        "append", GroupStateTimeout.ProcessingTimeTimeout)
