"""The panels of a cluster dashboard, each one query over measurements.

A panel is a filter on measurement, tags and time, then aggregates of fields per time bucket and
tag. Panels of a single broker are one query for all brokers with the broker as a further key,
so their cost does not grow with the number of brokers.

``sum`` over a bucket wider than the scan interval adds the scans in it together. That is how
the panels are defined, also the one that is titled a mean.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.tags import group_tag, series_label, tag
from pulsegrid.functions.values import auto_interval, interval_seconds
from pulsegrid.operators import buckets
from pulsegrid.operators.filters import measurement_is, tag_eq, tag_re, time_range
from pulsegrid.operators.sketches import sketch_quantile, widen_sketches
from pulsegrid.sources.points import DEFAULT_DATABASE, DEFAULT_RETENTION, read_points

ALL = ".+"  # a topic pattern that any topic matches


@dataclass(frozen=True)
class Target:
    """One aggregate of a panel: shown as ``alias``, computed by ``how`` over ``field``."""
    how: str
    field: str
    alias: str = "$col"
    name: str | None = None
    negative: bool = False

    @property
    def column(self) -> str:
        return self.name or self.how


@dataclass(frozen=True)
class Panel:
    title: str
    measurement: str
    targets: tuple[Target, ...]
    by: tuple[str, ...] = ()
    group: str | None = None
    by_topic: bool = False
    per_broker: bool = False
    width: int | str = "scan"
    reduce: str | None = None
    levels: tuple[float, float] | None = None


@dataclass(frozen=True)
class Range:
    """What a dashboard is asked for: its name, the time range, scan interval and topics."""
    dash: str
    start: str
    end: str
    interval: int | str = 10
    topics: str = ALL
    max_points: int = 100

    def width(self, panel: Panel) -> int:
        if panel.width == "scan":
            return interval_seconds(self.interval)
        if panel.width == "auto":
            length = datetime.fromisoformat(self.end) - datetime.fromisoformat(self.start)
            return auto_interval(length.total_seconds(), self.max_points)
        return interval_seconds(panel.width)


def _rate(alias: str = "$col", **more) -> tuple[Target, ...]:
    return (Target("sum", "OneMinuteRate", alias, **more),)


# The panels of a cluster dashboard, by the query they run.
PANELS = {
    "Q01": Panel("Input / Sec", "BytesInPerSec", _rate("$tag_topic"), ("topic",), by_topic=True),
    "Q02": Panel("Messages / Sec", "MessagesInPerSec", _rate("$tag_topic"), ("topic",), by_topic=True),
    "Q03": Panel("Failed Fetch Requests / Sec", "FailedFetchRequestsPerSec", _rate("$tag_topic"),
                 ("topic",), by_topic=True),
    "Q04": Panel("Output / Sec", "BytesOutPerSec", _rate("$tag_topic"), ("topic",), by_topic=True),
    "Q05": Panel("Controllers", "ActiveControllerCount", (Target("sum", "Value"),),
                 group="kafka.controller", reduce="current"),
    "Q06": Panel("Under-Replicated Partitions", "UnderReplicatedPartitions",
                 (Target("mean", "Value", "$tag_service"),), ("service",), "kafka.server"),
    "Q07": Panel("Partition Count", "PartitionCount", (Target("last", "Value", "$tag_service"),),
                 ("service",), "kafka.server", reduce="avg"),
    "Q08": Panel("Log Flush Time (98th maximum)", "LogFlushRateAndTimeMs",
                 (Target("max", "98thPercentile", "$tag_service", "98thPercentile"),),
                 ("service",), "kafka.log", width="1m", levels=(6, 12)),
    "Q09": Panel("Input / Sec", "BytesInPerSec", _rate("$tag_service"), ("service",),
                 "kafka.server", by_topic=True),
    "Q10": Panel("Output / Sec", "BytesOutPerSec", _rate("$tag_service"), ("service",),
                 "kafka.server", by_topic=True),
    "Q11": Panel("Requests/Sec", "RequestsPerSec", (Target("mean", "OneMinuteRate"),),
                 group="kafka.network", reduce="avg"),
    "Q12": Panel("Num.delayed Operations", "NumDelayedOperations",
                 (Target("max", "Value"), Target("median", "Value"), Target("min", "Value")),
                 ("service",), per_broker=True, width="auto"),
    "Q13": Panel("Log Flush Time (mean)", "LogFlushRateAndTimeMs",
                 (Target("sum", "999thPercentile", name="999thPercentile"),
                  Target("sum", "99thPercentile", name="99thPercentile"),
                  Target("sum", "95thPercentile", name="95thPercentile")),
                 ("service",), "kafka.log", per_broker=True, width="30s", levels=(100, 250)),
    "Q14": Panel("Throughput", "BytesOutPerSec", _rate("Output", negative=True), ("service",),
                 by_topic=True, per_broker=True, width="auto"),
    "Q15": Panel("Throughput", "BytesInPerSec", _rate("Input"), ("service",), by_topic=True,
                 per_broker=True, width="auto"),
}


def panel_filter(df: DataFrame, panel: Panel, asked: Range) -> Column:
    keep = (measurement_is(panel.measurement) & tag_eq(df, "name", asked.dash)
            & time_range(df, asked.start, asked.end))
    if panel.group:
        keep &= tag_eq(df, "group", panel.group)
    if panel.by_topic:
        keep &= tag_re(df, "topic", asked.topics)
    if panel.per_broker:
        keep &= tag(df, "service").isNotNull()
    return keep


def panel_table(df: DataFrame, panel: Panel, asked: Range, width: int | None = None,
                fill: bool = True) -> DataFrame:
    """The panel as one row per bucket and key, with a column per target (its name, or how)."""
    width = width or asked.width(panel)
    fields = list(dict.fromkeys(t.field for t in panel.targets))
    # flat columns first: over these, filters and pruning reach the scan where the tags and
    # fields of the table are columns
    rows = df.filter(panel_filter(df, panel, asked)).select(
        "ts", *[group_tag(df, k).alias(k) for k in panel.by],
        *[F.col("fields")[f].alias(f"_{f}") for f in fields])
    present = F.coalesce(*[F.col(f"_{f}") for f in fields]).isNotNull()
    table = buckets.bucket_agg(rows.filter(present), width, list(panel.by),
                               {t.column: (t.how, f"_{t.field}") for t in panel.targets})
    return _finished(table, panel, asked, width, fill)


def _finished(table: DataFrame, panel: Panel, asked: Range, width: int, fill: bool) -> DataFrame:
    """The aggregates of a panel's buckets with its empty buckets, and those shown below the axis negated."""
    if fill:
        table = buckets.fill_null(table, asked.start, asked.end, width, list(panel.by))
    for t in panel.targets:
        if t.negative:
            table = table.withColumn(t.column, -F.col(t.column))
    return table


def panel_series(df: DataFrame, panel: Panel, asked: Range, width: int | None = None,
                 fill: bool = True) -> DataFrame:
    """The panel as shown: bucket, its keys, the series label, value, and level if it has any."""
    return shown_series(panel_table(df, panel, asked, width, fill), panel)


def shown_series(table: DataFrame, panel: Panel) -> DataFrame:
    """A table of a panel's aggregates, of a stream too, as rows of labelled values."""
    names = [t.column for t in panel.targets]
    rows = buckets.unpivot_aggregates(table, list(panel.by), names)
    tags = {k: F.col(k) for k in panel.by}
    label = None
    for t, name in zip(panel.targets, names):
        shown = series_label(t.alias, name, tags)
        label = F.when(F.col("col") == name, shown) if label is None else label.when(
            F.col("col") == name, shown)
    level = [] if panel.levels is None else [F.when(
        F.col("value").isNotNull(), buckets.threshold_level("value", *panel.levels)).alias("level")]
    return rows.select("bucket", *panel.by, label.alias("series"), "value", *level)


def panel_number(df: DataFrame, panel: Panel, asked: Range, width: int | None = None) -> DataFrame:
    """A panel that shows one number per series: ``current`` or ``avg`` over the buckets."""
    if panel.reduce is None:
        raise ValueError(f"{panel.title} shows series, not numbers")
    # empty buckets do not count for either, so they need not be made
    return shown_number(panel_table(df, panel, asked, width, fill=False), panel)


def shown_number(table: DataFrame, panel: Panel) -> DataFrame:
    """A table of a panel's aggregates as one number per series."""
    name = panel.targets[0].column
    return buckets.series_reduce(table, list(panel.by), name, panel.reduce).withColumnRenamed(name, "value")


def evaluate(df: DataFrame, panel_id: str, asked: Range, width: int | None = None) -> DataFrame:
    """A panel of the cluster dashboard by its id, as it is shown."""
    panel = PANELS[panel_id]
    show = panel_number if panel.reduce else panel_series
    return show(df, panel, asked, width)


def can_merge(panel_id: str) -> bool:
    """Whether the panel's aggregates fit into one hash aggregation with those of others: last values and medians do not."""
    return {t.how for t in PANELS[panel_id].targets} <= {"sum", "mean", "max", "min", "count"}


def merged_tables(df: DataFrame, panel_ids: list[str], asked: Range, width: int | None = None) -> DataFrame:
    """The aggregates of several panels from one read and one shuffle: (_panel, bucket, keys of any of them, aggregates).

    A measurement goes to each of the panels that show it, at most as many as have its name, and is aggregated before the
    shuffle by panel, bucket and keys. ``of_merged`` takes a panel out again.
    """
    panels = {p: PANELS[p] for p in panel_ids}
    keys = sorted({k for panel in panels.values() for k in panel.by})
    fields = {p: list(dict.fromkeys(t.field for t in panel.targets)) for p, panel in panels.items()}
    slots = max(map(len, fields.values()))

    def row(panel_id: str) -> Column:
        panel = panels[panel_id]
        values = [F.col("fields")[f] for f in fields[panel_id]]
        values += [F.lit(None).cast("double")] * (slots - len(values))
        shown = F.struct(
            F.lit(panel_id).alias("_panel"), buckets.time_bucket(width or asked.width(panel)).alias("bucket"),
            *[(group_tag(df, k) if k in panel.by else F.lit("")).alias(k) for k in keys],
            *[v.alias(f"_v{j}") for j, v in enumerate(values)])
        return F.when(panel_filter(df, panel, asked) & F.coalesce(*values).isNotNull(), shown)

    names = sorted({panel.measurement for panel in panels.values()})
    rows = (df.filter(df["name"].isin(names) & (tag(df, "name") == asked.dash) & time_range(df, asked.start, asked.end))
            .select(F.explode(F.array_compact(F.array(*map(row, panel_ids)))).alias("_r")).select("_r.*"))
    wanted = sorted({(t.how, fields[p].index(t.field)) for p, panel in panels.items() for t in panel.targets})
    return rows.groupBy("_panel", "bucket", *keys).agg(
        *[buckets.aggregate(how, f"_v{j}", "bucket").alias(f"_{how}_{j}") for how, j in wanted])


def of_merged(tables: DataFrame, panel_id: str, asked: Range, width: int | None = None) -> DataFrame:
    """A panel out of ``merged_tables``, as ``evaluate`` shows it."""
    panel = PANELS[panel_id]
    fields = list(dict.fromkeys(t.field for t in panel.targets))
    table = tables.filter(F.col("_panel") == panel_id).select(
        "bucket", *panel.by, *[F.col(f"_{t.how}_{fields.index(t.field)}").alias(t.column) for t in panel.targets])
    table = _finished(table, panel, asked, width or asked.width(panel), panel.reduce is None)
    return shown_number(table, panel) if panel.reduce else shown_series(table, panel)


def evaluate_sketches(sketches: DataFrame, panel_id: str, asked: Range, width: int | None = None, fill: bool = True) -> DataFrame:
    """A panel of medians and extremes (Q12) from stored sketches of narrower buckets, as ``panel_series`` shows it.

    The extremes are exact, a median is within the rank error of the sketches.
    """
    panel = PANELS[panel_id]
    fractions = {"min": 0.0, "median": 0.5, "max": 1.0}
    if {t.how for t in panel.targets} - set(fractions) or len({t.field for t in panel.targets}) > 1:
        raise ValueError(f"{panel.title} cannot be had from sketches")
    width = width or asked.width(panel)
    rows = sketches.filter((F.col("bucket") >= F.lit(asked.start).cast("timestamp"))
                           & (F.col("bucket") < F.lit(asked.end).cast("timestamp")))
    table = widen_sketches(rows, width, list(panel.by)).select(
        "bucket", *panel.by, *[sketch_quantile(fractions[t.how]).alias(t.column) for t in panel.targets])
    return shown_series(_finished(table, panel, asked, width, fill), panel)


def evaluate_store(spark: SparkSession, path: str, panel_id: str, asked: Range, width: int | None = None,
                   database: str = DEFAULT_DATABASE, retention: str = DEFAULT_RETENTION) -> DataFrame:
    """A panel over stored points. Its days, measurement and tags select rows in the scan, and only its
    fields are resolved."""
    panel = PANELS[panel_id]
    points = read_points(spark, path, database, retention, lambda stored: panel_filter(stored, panel, asked),
                         sorted({t.field for t in panel.targets}))
    return evaluate(points, panel_id, asked, width)
