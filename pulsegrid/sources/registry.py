"""Captured snapshots of instruments as measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.tags import (
    bind, empty_tags, literal_map, metric_name_tags, overlay_map, scope_is_odd)
from pulsegrid.functions.values import finite
from pulsegrid.operators.pack import drop_empty

# The fields each kind of instrument reports.
_RATES = ["Count", "MeanRate", "OneMinuteRate", "FiveMinuteRate", "FifteenMinuteRate"]
_SPREAD = ["Max", "Mean", "Min", "StdDev", "Sum"]
KIND_FIELDS = {
    "client": ["Value"],
    "gauge": ["Value"],
    "counter": ["Count"],
    "meter": _RATES,
    "timer": _RATES + _SPREAD,
    "histogram": ["Count", *_SPREAD, "95thPercentile", "98thPercentile", "99thPercentile",
                  "999thPercentile"],
}
SINGLE_VALUE_KINDS = ("client", "gauge")


def kind_fields() -> Column:
    """Those of ``values`` that the instrument's kind reports. A single value must be finite."""
    names = F.create_map(*[x for kind, fields in KIND_FIELDS.items() for x in (
        F.lit(kind), F.array(*[F.lit(f) for f in fields]))])[F.col("kind")]
    single = F.col("kind").isin(*SINGLE_VALUE_KINDS)
    return bind(F.named_struct(F.lit("names"), names, F.lit("single"), single),
                lambda kind: F.map_filter("values", lambda k, v: F.array_contains(kind["names"], k)
                                          & v.isNotNull() & (~kind["single"] | finite(v).isNotNull())))


def registry_to_measurements(snapshots: DataFrame, fixed_tags: dict[str, str] | None = None) -> DataFrame:
    """Rows (tick, kind, group, type, name, scope, client_tags, values) to measurements.

    Tags: fixed ones, then group, type and scope of a registry metric, or group and own tags of
    a client metric. A metric whose scope has a key without a value carries an ``error``
    (see ``split_rejects``); the others are not touched by it.
    """
    client = F.col("kind") == "client"
    client_tags = overlay_map(F.create_map(F.lit("group"), F.col("group")),
                              F.coalesce(F.col("client_tags"), empty_tags()))
    tags = F.when(client, client_tags).otherwise(metric_name_tags("group", "type", "scope"))
    odd = ~client & scope_is_odd("group", "scope")
    rows = snapshots.select(
        F.col("tick").alias("ts"), "name",
        overlay_map(literal_map(fixed_tags or {}), tags).alias("tags"),
        kind_fields().alias("fields"),
        F.when(odd, F.concat(F.lit("scope with a key but no value: "), F.col("scope"))).alias("error"))
    return drop_empty(rows)
