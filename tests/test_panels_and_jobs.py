import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.values import auto_interval
from pulsegrid.operators.filters import lookback, tag_re
from pulsegrid.plans.dashboard import bundle_dashboard, cluster_dashboard
from pulsegrid.plans.panels import PANELS, Range, evaluate, panel_series
from pulsegrid.schema import MEASUREMENT
from pulsegrid.sources.envelope import to_topic_records
from pulsegrid.sources.points import promote_tags, read_points, stored_points, write_archive, write_points
from pulsegrid.sources.text import format_measurements, write_text
from pulsegrid.sources.topic import consumer_options, read_topic, write_topic
from pulsegrid.streaming.jobs import load_topic_to_points, store_stream, stream_panel, union_streams

T0 = dt.datetime(2024, 1, 1)
ASKED = Range("main", "2024-01-01", "2024-01-01 00:01:00", "10s")


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def broker_rows():
    rows = []
    for s in range(0, 60, 5):
        for b in (0, 1):
            tags = {"name": "main", "service": f"broker-{b}", "group": "kafka.server"}
            rate = {"OneMinuteRate": float(s + b)}
            rows.append((at(s), "BytesInPerSec", {**tags, "topic": "t1"}, rate))
            rows.append((at(s), "BytesInPerSec", tags, {"OneMinuteRate": 1000.0}))  # all topics: no topic tag
            rows.append((at(s), "BytesOutPerSec", {**tags, "topic": "t2"}, rate))
            rows.append((at(s), "NumDelayedOperations", tags, {"Value": float(s)}))
            rows.append((at(s), "LogFlushRateAndTimeMs", {**tags, "group": "kafka.log"},
                         {"95thPercentile": 60.0, "98thPercentile": float(s) / 4, "99thPercentile": 20.0,
                          "999thPercentile": 130.0}))
            rows.append((at(s), "PartitionCount", tags, {"Value": float(10 + b)}))
        rows.append((at(s), "BytesInPerSec", {"name": "other", "service": "broker-0", "group": "kafka.server",
                                              "topic": "t1"}, {"OneMinuteRate": 1e9}))
    return rows


@pytest.fixture(scope="module")
def brokers(spark):
    return spark.createDataFrame(broker_rows(), MEASUREMENT)


def test_topic_panel(brokers):
    rows = evaluate(brokers, "Q01", ASKED).collect()
    got = {(r.bucket, r.series): r.value for r in rows}
    assert len(got) == 6 and got[T0, "t1"] == 0 + 1 + 5 + 6


def test_topic_pattern_is_anchored(brokers):
    assert brokers.filter(tag_re(brokers, "topic", "t")).count() == 0
    assert brokers.filter(tag_re(brokers, "topic", "t|t1")).count() == 36
    assert evaluate(brokers, "Q01", Range("main", ASKED.start, ASKED.end, 10, "t2")).count() == 0


def test_one_query_for_all_brokers(brokers):
    rows = evaluate(brokers, "Q12", ASKED, 60).collect()
    assert {(r.service, r.series): r.value for r in rows} == {
        (f"broker-{b}", how): v for b in (0, 1) for how, v in (("max", 55.0), ("median", 27.5), ("min", 0.0))}


def test_negative_output_and_input(brokers):
    out = {r.service: (r.series, r.value) for r in evaluate(brokers, "Q14", ASKED, 60).collect()}
    inp = {r.service: (r.series, r.value) for r in evaluate(brokers, "Q15", ASKED, 60).collect()}
    assert out == {"broker-0": ("Output", -330.0), "broker-1": ("Output", -342.0)}
    assert inp == {"broker-0": ("Input", 330.0), "broker-1": ("Input", 342.0)}


def test_levels(brokers):
    rows = {r.service: r for r in evaluate(brokers, "Q08", ASKED).collect()}
    assert rows["broker-0"].value == 13.75 and rows["broker-0"].level == "critical"
    levels = {r.series: r.level for r in evaluate(brokers, "Q13", ASKED, 5).collect()}
    assert levels == {"999thPercentile": "warn", "99thPercentile": "ok", "95thPercentile": "ok"}


def test_numbers(brokers):
    assert {r.service: r.value for r in evaluate(brokers, "Q07", ASKED).collect()} == {"broker-0": 10.0, "broker-1": 11.0}


def test_every_panel_runs_over_columns_and_maps_alike(brokers):
    flat = promote_tags(brokers)
    for panel_id in PANELS:
        a, b = evaluate(brokers, panel_id, ASKED), evaluate(flat, panel_id, ASKED)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_filters_reach_the_scan(spark, brokers, tmp_path):
    write_points(brokers, str(tmp_path), 0)
    stored = stored_points(spark, str(tmp_path))
    shown = panel_series(stored, PANELS["Q09"], ASKED)
    plan = spark._jvm.PythonSQLUtils.explainString(shown._jdf.queryExecution(), "formatted").splitlines()
    pushed, parts, read = (next(line for line in plan if line.startswith(start)) for start in (
        "PushedFilters", "PartitionFilters", "ReadSchema"))
    assert "EqualTo(name,BytesInPerSec)" in pushed and "EqualTo(tag_group,kafka.server)" in pushed
    assert "d#" in parts and "tags:" not in read
    assert sum("Scan parquet" in line for line in plan) == 2  # in the tree, and its details


def test_bundle(brokers, tmp_path, spark):
    paths = bundle_dashboard(brokers, cluster_dashboard("main", 2), ASKED, str(tmp_path), 10)
    assert len(paths) == len(PANELS)
    for panel_id, path in zip(PANELS, paths):
        expected = evaluate(brokers, panel_id, ASKED, 10).collect()
        if expected:
            assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, expected))


def test_auto_interval_and_lookback(spark):
    assert auto_interval(1800, 100) == 18 and auto_interval(50, 100) == 1 and auto_interval(1801, 100) == 19
    assert Range("m", "2024-01-01", "2024-01-01 00:30:00").width(PANELS["Q12"]) == 18
    start, end = spark.range(1).select(*lookback("2024-01-01 00:30:00")).collect()[0]
    assert (start, end) == (T0, at(1800))


def test_consumer_settings():
    options = consumer_options({
        "consumer.topic": "m", "consumer.numThreads": "1", "consumer.bootstrap.servers": "h:9092",
        "consumer.group.id": "g", "consumer.auto.offset.reset": "earliest", "consumer.fetch.min.bytes": "5",
        "consumer.zookeeper.session.timeout.ms": "2000", "consumer.auto.commit.interval.ms": "10000", "other": "x"})
    assert options == {"subscribe": "m", "kafka.bootstrap.servers": "h:9092", "startingOffsets": "earliest",
                       "kafka.fetch.min.bytes": "5"}
    with pytest.raises(ValueError):
        consumer_options({"consumer.topic": "m", "consumer.auto.offset.reset": "none"})


def test_no_topic_no_stream(spark):
    with pytest.raises(ValueError):
        read_topic(spark, {"consumer.group.id": "g"}, "parquet", "/nowhere")


def test_text(spark, tmp_path):
    df = spark.createDataFrame([(T0, "xyz.abc.123", {"b": "2", "a": "1"}, {"V2": 0.0, "V1": 10.0})], MEASUREMENT)
    expected = "xyz.abc.123,a=1,b=2 [01/01/2024 AD at 00:00:00 UTC] \nV1=10.0\tV2=0.0\t\n\n"
    assert format_measurements(df).collect()[0].value == expected
    failed = df.withColumn("error", F.lit("broken"))
    assert format_measurements(failed).collect()[0].value == "broken\n\n"
    write_text(df, str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t"), wholetext=True).collect()[0].value == expected


def test_archive_day_is_an_hour_behind(spark, tmp_path):
    df = spark.createDataFrame([(at(1800), "n", {}, {"x": 1.0}), (at(7200), "n", {}, {"x": 2.0})], MEASUREMENT)
    write_archive(df, str(tmp_path / "a"))
    got = {str(r.d): r.fields["x"] for r in spark.read.parquet(str(tmp_path / "a")).collect()}
    assert got == {"2023-12-31": 1.0, "2024-01-01": 2.0}


def flat(df):
    return sorted((r.ts, r["name"], sorted(r.tags.items()), sorted(r.fields.items())) for r in df.collect())


def test_topic_to_points_survives_bad_records_retries_and_redelivery(spark, brokers, tmp_path):
    topic, out, checkpoint = (str(tmp_path / p) for p in ("topic", "out", "checkpoint"))
    conf = {"consumer.topic": "metrics"}
    write_topic(brokers, format="parquet", path=topic)
    write_topic(brokers.limit(20), format="parquet", path=topic)
    bad = spark.createDataFrame([(bytearray(b"?"),), (bytearray(b"\x01\x09"),)], "value binary")
    bad.select(F.lit(None).cast("binary").alias("key"), "value", F.lit("metrics").alias("topic"),
               F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
               F.lit(T0).alias("timestamp")).write.mode("append").parquet(topic)
    write_topic(brokers.limit(5), topic="another", format="parquet", path=topic)

    def load():
        records = read_topic(spark, conf, "parquet", topic)
        load_topic_to_points(records, out, checkpoint, None).awaitTermination()

    load()
    load()
    assert flat(read_points(spark, out)) == flat(brokers)
    assert spark.read.parquet(f"{out}/rejects").count() == 2
    # a batch that is tried again replaces its folder
    write_points(brokers, out, 0)
    assert flat(read_points(spark, out)) == flat(brokers)


def test_stream_panel_equals_batch_for_closed_buckets(spark, brokers, tmp_path):
    source = str(tmp_path / "in")
    brokers.write.parquet(source)
    stream = spark.readStream.schema(MEASUREMENT).parquet(source)
    keep = (F.col("name") == "NumDelayedOperations") & (F.col("tags")["name"] == "main")
    panel = stream_panel(stream, keep, {"service": F.col("tags")["service"]}, 10,
                         {"max": ("max", "Value"), "median": ("median", "Value"), "last": ("last", "Value")}, "5 seconds")
    store_stream(panel, str(tmp_path / "out"), str(tmp_path / "cp"), None).awaitTermination()
    got = {(r.bucket, r.service): (r["max"], r["last"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(at(s), f"broker-{b}"): (s + 5.0, s + 5.0) for s in range(0, 50, 10) for b in (0, 1)}


def test_union_tags_do_not_replace_own(spark):
    df = spark.createDataFrame([(T0, "n", {"dc": "own"}, {"x": 1.0}), (T0, "n", {}, {"x": 1.0})], MEASUREMENT)
    got = sorted(r.tags["dc"] for r in union_streams({"a": df, "b": df}).collect())
    assert got == ["a", "b", "own", "own"]


def test_topic_records_decode_to_what_went_in(spark, brokers):
    from pulsegrid.sources.envelope import decode_envelope
    assert flat(decode_envelope(to_topic_records(brokers))) == flat(brokers)


def test_lag_waits_for_a_known_end_and_addresses_count_once(spark):
    from pulsegrid.operators.enrich import enrich_with_inventory
    from pulsegrid.operators.lag import consumer_lag
    ends = spark.createDataFrame([(at(1), "t", 0, 70), (at(2), "t", 0, None), (at(1), "u", 0, None)],
                                 "ts timestamp, topic string, partition int, end_offset long")
    done = spark.createDataFrame([(at(1), "g", t, 0, 40) for t in ("t", "u")],
                                 "ts timestamp, group_id string, topic string, partition int, offset long")
    assert [(r.topic, r.end_offset, r.lag) for r in consumer_lag(ends, done).collect()] == [("t", 70, 30)]
    brokers = spark.createDataFrame([("10", "h", 9092, 1), ("9", "h", 9092, 1)], "id string, host string, port int, jmx_port int")
    rows = spark.createDataFrame([("h:1", {}), ("x:1", {"a": "b"})], "address string, tags map<string,string>")
    got = sorted((r.address, sorted(r.tags.items())) for r in enrich_with_inventory(rows, brokers, "main", ["address"]).collect())
    assert got == [("h:1", [("host", "h"), ("name", "main"), ("service", "broker-9")]), ("x:1", [("a", "b")])]
