"""Streams that give one row per series and interval, silent intervals too.

Intervals are whole multiples of a width, counted from 1970. An interval is closed when the watermark has passed its end; what
comes for it later is not counted. Tasks compose the rows that they see of a series and interval to one part
before anything is shuffled, and parts compose in any order, so the state of a series is what it carries and one part for each open
interval, however many rows it has. A timer of each series goes off at the end of its next interval.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from pulsegrid.functions.tags import group_tag
from pulsegrid.functions.values import finite, floor_div, interval_seconds
from pulsegrid.operators.summary import RATE_MINUTES, TICK_SECONDS, decay
from pulsegrid.plans.panels import PANELS, Range, panel_filter, shown_series

ROWS = 10_000  # handed out at a time, however many intervals a series has to catch up on

Part = list[float]


def _parts(rows: DataFrame, keys: list[str], width: int, compose: Callable[[pd.DataFrame, list[str]], pd.DataFrame]) -> DataFrame:
    """(keys, _ts, _at, _part): what a task has seen of each series and interval, batch by batch.

    ``_ts`` is the last moment of the interval and has the watermark, so the parts of closed intervals are dropped and all others
    are kept. ``compose`` gets rows with ``_at`` and the columns to group by, and gives ``_at``, these and ``_part``.
    """
    micros = width * 1_000_000
    by = [*keys, "_at"]
    placed = rows.withColumn("_at", floor_div(F.unix_micros("_ts"), micros))
    shape = placed.select(*keys, "_ts", "_at", F.array(F.lit(0.0)).alias("_part")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = compose(batch, by)
                found["_ts"] = pd.to_datetime((found["_at"] + 1) * micros - 1, unit="us", utc=True)
                yield found[shape.names]

    return placed.mapInPandas(run, shape)


def _every_interval(parts: DataFrame, keys: list[str], width: int, merge: Callable[[Part, Part], Part],
                    step: Callable[[Part | None, Part | None], tuple[Part, tuple]], made: str,
                    first: int | None = None, last: int | None = None) -> DataFrame:
    """(keys, _at, made): a row for every closed interval of each series, from ``first`` (else its first one) to ``last``.

    ``step`` gets what the series carries (None at first) and the interval's part (None if silent), and gives what is carried
    on and the row's values.
    """
    named = [*keys, "_at", *StructType.fromDDL(made).names]
    width_ms = width * 1000

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, carry, waiting = None, None, {}
        if state.exists:
            done, held, places, open_parts = state.get
            carry = None if held is None else [float(x) for x in held]
            waiting = {int(at): [float(x) for x in part] for at, part in zip(places, open_parts, strict=True)}
        for batch in batches:
            for at, part in zip(batch["_at"], batch["_part"], strict=True):
                at, part = int(at), [float(x) for x in part]
                if done is None or at > done:
                    waiting[at] = merge(waiting[at], part) if at in waiting else part
        if done is None and first is not None:
            done = first - 1
        closed = state.getCurrentWatermarkMs() // width_ms - 1
        stop = closed if last is None else min(closed, last)
        out = []
        if done is None and waiting and min(waiting) <= stop:
            done = min(waiting) - 1
        if done is not None:
            for at in range(done + 1, stop + 1):
                carry, values = step(carry, waiting.pop(at, None))
                out.append((*key, at, *values))
                if len(out) == ROWS:
                    yield pd.DataFrame(out, columns=named)
                    out = []
            done = max(done, stop)
        if out:
            yield pd.DataFrame(out, columns=named)
        if last is not None and done is not None and done >= last:
            state.remove()
            return
        order = sorted(waiting)
        state.update((done, carry, order, [waiting[at] for at in order]))
        following = done + 1 if done is not None else order[0]
        state.setTimeoutTimestamp(max((following + 1) * width_ms, state.getCurrentWatermarkMs() + 1))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.select(*keys).schema)
    fields = f"{fields}, " if keys else ""
    return parts.groupBy(*keys).applyInPandasWithState(
        run, f"{fields}_at bigint, {made}", "done bigint, carry array<double>, places array<bigint>, parts array<array<double>>",
        "append", GroupStateTimeout.EventTimeTimeout)


def ewma_rate_stream(df: DataFrame, keys: list[str], report_seconds: int, ts: str = "ts", delay: str = "1 hour",
                     tick_seconds: int = TICK_SECONDS, minutes: dict[str, float] = RATE_MINUTES) -> DataFrame:
    """``ewma_rate`` over a stream: the moving rates of each key at the end of every closed report interval.

    Over an interval a rate becomes A * rate + b. A is the same for all; b is a sum over the interval's observations, so
    parts of an interval add up. Only the tick in which a key starts weighs more, so a part has that one too: (first tick,
    its observations, b of each rate). Observations without a time are left out.
    """
    per_report = report_seconds // tick_seconds
    if per_report * tick_seconds != report_seconds:
        raise ValueError("a report interval must be a whole number of ticks")
    keep = np.array([decay(m, tick_seconds) for m in minutes.values()])
    fade = keep ** per_report

    def compose(batch: pd.DataFrame, by: list[str]) -> pd.DataFrame:
        counts = batch.groupby([*by, "_tick"], dropna=False, sort=True).size().rename("_n").reset_index()
        left = per_report - 1 - (counts["_tick"] - counts["_at"] * per_report)
        for k, a in enumerate(keep):
            counts[f"_b{k}"] = (1 - a) / tick_seconds * counts["_n"] * a ** left
        sums = {f"_b{k}": "sum" for k in range(len(keep))}
        # sorted by tick: the first row of a group is its first tick
        found = counts.groupby(by, dropna=False, sort=False).agg({"_tick": "first", "_n": "first", **sums}).reset_index()
        found["_part"] = found[["_tick", "_n", *sums]].astype("float64").to_numpy().tolist()
        return found

    def merge(a: Part, b: Part) -> Part:
        first = min(a[0], b[0])
        return [first, sum(p[1] for p in (a, b) if p[0] == first), *(x + y for x, y in zip(a[2:], b[2:], strict=True))]

    def step(carry: Part | None, part: Part | None) -> tuple[Part, tuple]:
        if carry is None:  # the first interval is never silent
            left = per_report - 1 - int(part[0]) % per_report
            rates = np.array(part[2:]) + keep * part[1] / tick_seconds * keep ** left
        else:
            rates = np.array(carry) * fade + (0.0 if part is None else np.array(part[2:]))
        return rates.tolist(), tuple(rates.tolist())

    rows = df.filter(F.col(ts).isNotNull()).withWatermark(ts, delay).select(
        *keys, F.col(ts).alias("_ts"), floor_div(F.unix_micros(ts), tick_seconds * 1_000_000).alias("_tick"))
    made = ", ".join(f"`{n}` double" for n in minutes)
    found = _every_interval(_parts(rows, keys, report_seconds, compose), keys, report_seconds, merge, step, made)
    return found.select(*keys, F.timestamp_seconds((F.col("_at") + 1) * report_seconds).alias("at"), *minutes)


def _compose_fields(fields: list[str]) -> Callable[[pd.DataFrame, list[str]], pd.DataFrame]:
    """Parts of six numbers for each field: how many, sum, least, greatest, time of the last one, its value."""
    def compose(batch: pd.DataFrame, by: list[str]) -> pd.DataFrame:
        every = batch[by].drop_duplicates()
        for f in fields:
            known = batch[batch[f].notna()].sort_values(["_us", f])
            groups = known.groupby(by, dropna=False, sort=False)
            found = groups.agg(n=(f, "size"), s=(f, "sum"), low=(f, "min"), high=(f, "max"), us=("_us", "last"),
                               value=(f, "last")).add_prefix(f).reset_index()
            every = every.merge(found, on=by, how="left")
        numbers = [c for c in every.columns if c not in by]
        every["_part"] = every[numbers].astype("float64").fillna(0.0).to_numpy().tolist()
        return every
    return compose


def _merge_fields(a: Part, b: Part) -> Part:
    merged = []
    for k in range(0, len(a), 6):
        x, y = a[k:k + 6], b[k:k + 6]
        if not x[0] or not y[0]:
            merged += x if x[0] else y
        else:
            merged += [x[0] + y[0], x[1] + y[1], min(x[2], y[2]), max(x[3], y[3]), *max(x[4:], y[4:])]
    return merged


def _number(how: str, part: Part) -> float | None:
    n, total, low, high, _us, newest = part
    if not n:
        return 0.0 if how == "count" else None
    return {"sum": total, "mean": total / n, "max": high, "min": low, "count": n, "last": newest}[how]


def filled_panel_stream(df: DataFrame, keep: Column, keys: dict[str, Column], width: int | str, start: str, end: str | None,
                        aggregates: dict[str, tuple[str, str]], delay: str = "30 minutes") -> DataFrame:
    """``stream_panel`` with a row for every closed bucket from ``start`` to ``end`` of each series that has any; empty ones are null.

    As ``fill_null`` does over a table, but a bucket is given out when it is closed, and without ``end`` a series goes on for ever.
    The first measurement of a series also gives out the empty buckets before it. A bucket whose measurements have none
    of the fields is empty. There are no medians here; values that are not finite are none.
    """
    width = interval_seconds(width)
    unknown = {how for how, _f in aggregates.values()} - {"sum", "mean", "max", "min", "count", "last"}
    if unknown:
        raise ValueError(f"not over filled streams: {', '.join(sorted(unknown))}")
    fields = sorted({f for _how, f in aggregates.values()})
    columns = [f"_f{k}" for k in range(len(fields))]
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    first, last = (t and pd.Timestamp(t, tz=zone).value // 1000 for t in (start, end))
    # the watermark comes before the range: what is measured after the range closes its last buckets
    moment = F.unix_micros("ts")
    rows = df.withWatermark("ts", delay).filter(keep & (moment >= first))
    if end:
        rows = rows.filter(moment < last)
        last = (last - 1) // (width * 1_000_000)
    made_up = {"_all": F.lit("")}  # a state needs a key
    rows = rows.select(*[F.coalesce(c, F.lit("")).alias(k) for k, c in (keys or made_up).items()], F.col("ts").alias("_ts"),
                       moment.alias("_us"), *[finite(F.col("fields")[f]).alias(c) for f, c in zip(fields, columns, strict=True)])
    rows = rows.filter(F.coalesce(*columns).isNotNull())
    by = list(keys or made_up)
    place = {f: 6 * k for k, f in enumerate(fields)}

    def step(_carry: Part | None, part: Part | None) -> tuple[Part, tuple]:
        if part is None:
            return [], tuple(None for _ in aggregates)
        return [], tuple(_number(how, part[place[f]:place[f] + 6]) for how, f in aggregates.values())

    made = ", ".join(f"`{name}` double" for name in aggregates)
    found = _every_interval(_parts(rows, by, width, _compose_fields(columns)), by, width, _merge_fields, step, made,
                            first // (width * 1_000_000), last)
    return found.select(F.timestamp_seconds(F.col("_at") * width).alias("bucket"), *keys, *[
        F.col(name).cast("bigint").alias(name) if how == "count" else F.col(name) for name, (how, _f) in aggregates.items()])


def filled_panel_series(df: DataFrame, panel_id: str, asked: Range, width: int | None = None,
                        delay: str = "30 minutes") -> DataFrame:
    """A panel of the cluster dashboard by its id over a stream with its empty buckets, as ``panel_series`` shows it."""
    panel = PANELS[panel_id]
    table = filled_panel_stream(df, panel_filter(df, panel, asked), {k: group_tag(df, k) for k in panel.by},
                                width or asked.width(panel), asked.start, asked.end,
                                {t.column: (t.how, t.field) for t in panel.targets}, delay)
    for t in panel.targets:
        if t.negative:
            table = table.withColumn(t.column, -F.col(t.column))
    return shown_series(table, panel)
