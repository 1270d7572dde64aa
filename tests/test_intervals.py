import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.sketches import sketch_buckets, sketch_quantile, widen_sketches
from pulsegrid.operators.summary import ewma_rate
from pulsegrid.plans.panels import Range, evaluate_sketches
from pulsegrid.schema import MEASUREMENT
from pulsegrid.streaming.intervals import ewma_rate_stream, filled_panel_stream
from pulsegrid.streaming.jobs import store_stream

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


class Feed:
    """Batches of rows for one job that is stopped and started again between them."""

    def __init__(self, spark, schema, path, make):
        self.spark, self.schema, self.path = spark, schema, path
        self.make, self.given = make, 0

    def give(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.path}/in/{self.given}")
        self.given += 1
        stream = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/in")
        made = self.make(stream)
        store_stream(made, f"{self.path}/out", f"{self.path}/cp", None).awaitTermination()
        return self.spark.read.schema(made.schema).parquet(f"{self.path}/out")


def point(seconds, value, service="a", field="Value"):
    return (at(seconds), "m", {"service": service}, {field: value})


def test_filled_stream_goes_on_after_a_restart_and_leaves_late_rows_out(spark, tmp_path):
    aggregates = {"total": ("sum", "Value"), "mean": ("mean", "Value"), "n": ("count", "Value"), "newest": ("last", "Value"),
                  "low": ("min", "Value"), "high": ("max", "Value"), "other": ("sum", "Other")}
    feed = Feed(spark, MEASUREMENT, str(tmp_path), lambda df: filled_panel_stream(
        df, F.col("name") == "m", {"service": F.col("tags")["service"]}, 10, "2024-01-01", "2024-01-01 00:01:00", aggregates,
        "5 seconds"))
    feed.give([point(12, 1.0), point(18, 5.0), point(11, 3.0), point(14, float("nan")), point(13, 2.0, field="Other")])
    feed.give([point(16, 4.0), point(27, 7.0, "b")])  # 16 s is open until 25 s have been seen
    found = feed.give([point(3, 100.0), point(41, 8.0), point(61, 1.0), point(75, 1.0)])  # 3 s is closed; 61 s is out of range
    got = {(r.bucket, r.service): tuple(r)[2:] for r in found.collect()}
    assert len(got) == found.count() == 12
    empty = (None,) * 7
    expected = {(at(s), x): empty for s in range(0, 60, 10) for x in "ab"}
    expected[at(10), "a"] = (13.0, 13 / 4, 4, 5.0, 1.0, 5.0, 2.0)
    expected[at(20), "b"] = (7.0, 7.0, 1, 7.0, 7.0, 7.0, None)
    expected[at(40), "a"] = (8.0, 8.0, 1, 8.0, 8.0, 8.0, None)
    assert got == expected


def test_filled_stream_has_no_medians(spark):
    with pytest.raises(ValueError):
        filled_panel_stream(None, None, {}, 10, "2024-01-01", None, {"middle": ("median", "Value")})


def test_stream_rates_equal_the_batch_in_any_split(spark, tmp_path):
    rows = [(k, at(s)) for k, times in {"a": [3, 4, 7, 8, 31, 32, 95], None: [12, 13, 44], "b": [61]}.items() for s in times]
    minutes = {"fast": 0.1, "slow": 3.0}
    feed = Feed(spark, "k string, ts timestamp", str(tmp_path), lambda df: ewma_rate_stream(
        df, ["k"], 10, delay="40 seconds", tick_seconds=5, minutes=minutes))
    feed.give([r for n, r in enumerate(rows) if n % 3 == 0 and r[1] < at(60)])
    feed.give([r for n, r in enumerate(rows) if n % 3 and r[1] < at(60)] + [("b", None)])
    feed.give([r for r in rows if r[1] >= at(60)])
    found = feed.give([("clock", at(160))]).filter(~F.col("k").eqNullSafe("clock"))
    batch = ewma_rate(spark.createDataFrame(rows, "k string, ts timestamp"), ["k"], "2024-01-01 00:02:00", 10, tick_seconds=5,
                      minutes=minutes)
    plain = lambda df: {(r.k, r.at): (round(r.fast, 9), round(r.slow, 9)) for r in df.collect()}
    assert plain(found) == plain(batch)
    assert found.count() == batch.count()


def test_sketches_of_narrow_buckets_merge_to_wide_ones(spark):
    rows = spark.range(40_000).select(
        F.timestamp_seconds(F.unix_seconds(F.lit(T0)) + F.col("id") % 3600).alias("ts"),
        F.pmod(F.col("id") * 7919, F.lit(40_000)).cast("double").alias("v"), F.lit("a").alias("service"))
    rows = rows.unionByName(rows.limit(1).withColumn("v", F.lit(None).cast("double")).withColumn("service", F.lit("none")))
    narrow = sketch_buckets(rows, 60, ["service"], "v")
    assert narrow.count() == 60
    one = widen_sketches(narrow, 3600, ["service"]).select("n", "low", "high", sketch_quantile(0.5).alias("middle"),
                                                          sketch_quantile(0.99).alias("most"), sketch_quantile(1).alias("top")).collect()
    assert [(r.n, r.low, r.high, r.top) for r in one] == [(40_000, 0.0, 39_999.0, 39_999.0)]
    assert abs(one[0].middle - 20_000) < 400 and abs(one[0].most - 39_600) < 400
    shown = evaluate_sketches(narrow, "Q12", Range("main", "2024-01-01", "2024-01-01 02:00:00"), 3600)
    assert {r.series: r.value for r in shown.filter("value is not null").collect()}.keys() == {"max", "median", "min"}
    assert shown.count() == 6
    with pytest.raises(ValueError):
        evaluate_sketches(narrow, "Q01", Range("main", "2024-01-01", "2024-01-02"))
