import datetime as dt
import json
import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsegrid.schema import MEASUREMENT
from pulsegrid.sources.codec import decode_avro_v1, decode_batch, encode_avro_v1, encode_batch
from pulsegrid.sources.envelope import (
    decode_envelope, measurement_to_struct, split_rejects, struct_to_measurement, to_topic_records)

GOLDEN = (dt.datetime(2024, 1, 1), "xyz.abc.123", {"dimension1": "tag1", "dimension2": "tag2"},
          {"Value1": 10.0, "Value2": 0.0})


def varint(n):
    z = (n << 1) ^ (n >> 63)
    out = b""
    while z > 0x7F:
        out += bytes([z & 0x7F | 0x80])
        z >>= 7
    return out + bytes([z])


def text(s):
    return varint(len(s.encode())) + s.encode()


def record(ms, name, tags, fields, negative_blocks=False):
    """A straightforward encoder, written apart from the one under test."""
    def block(entries):
        if not entries:
            return b"\0"
        body = b"".join(entries)
        if negative_blocks:
            return varint(-len(entries)) + varint(len(body)) + body + b"\0"
        return varint(len(entries)) + body + b"\0"
    return (b"\x01\x01" + varint(ms) + text(name) + block([text(k) + text(v) for k, v in tags.items()])
            + block([text(k) + struct.pack("<d", v) for k, v in fields.items()]))


def random_measurements(n, seed=7):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abz é漢\U0001f600") for _ in range(rng.choice([0, 1, 5, 90])))
    for _ in range(n):
        yield (rng.choice([0, -1, 1, 2 ** 62, -2 ** 62, rng.randrange(2 ** 41)]), word(),
               {word() + str(i): word() for i in range(rng.choice([0, 1, 3, 70]))},
               {word() + str(i): rng.choice([0.0, -1.5, 1e300, rng.random()]) for i in range(rng.choice([0, 1, 9]))})


@pytest.mark.parametrize("negative", [False, True])
def test_decode_agrees_with_a_plain_encoder(negative):
    rows = list(random_measurements(300))
    got = decode_batch(pa.array([record(*r, negative_blocks=negative) for r in rows], pa.binary())).to_pylist()
    for (ms, name, tags, fields), g in zip(rows, got):
        assert (g["ms"], g["name"], dict(g["tags"]), dict(g["fields"]), g["error"]) == (ms, name, tags, fields, None)


def test_encode_agrees_with_a_plain_encoder():
    rows = list(random_measurements(300, seed=8))
    ms, names, tags, fields = zip(*rows)
    got = encode_batch(
        pa.array(ms, pa.int64()), pa.array(names, pa.string()),
        pa.array([list(t.items()) for t in tags], pa.map_(pa.string(), pa.string())),
        pa.array([list(f.items()) for f in fields], pa.map_(pa.string(), pa.float64())))
    assert got.to_pylist() == [record(*r) for r in rows]


def test_slices_and_empty_batches():
    rows = list(random_measurements(20, seed=9))
    whole = pa.array([record(*r) for r in rows], pa.binary())
    assert decode_batch(whole.slice(5, 7)).to_pylist() == decode_batch(whole).to_pylist()[5:12]
    assert decode_batch(pa.array([], pa.binary())).to_pylist() == []
    assert decode_batch(pa.array([None], pa.binary())).to_pylist()[0]["error"] is None


def test_damaged_records_do_not_harm_their_neighbours():
    good = record(5, "n", {"a": "b"}, {"x": 1.0})
    cut = [good[:i] for i in range(2, len(good))]
    odd = [b"", b"\x01", b"\x01\x02" + good[2:], b"\x01\x01" + b"\xff" * 12,
           b"\x01\x01" + varint(1) + varint(-5), b"\x01\x01" + varint(1) + varint(1000) + b"x"]
    mixed = [x for bad in cut + odd for x in (bad, good)]
    got = decode_batch(pa.array(mixed, pa.binary())).to_pylist()
    assert all(g["error"] for g in got[0::2])
    assert all(g["error"] is None and dict(g["fields"]) == {"x": 1.0} for g in got[1::2])
    assert "version 2" in got[2 * len(cut) + 4]["error"]


def test_repeated_map_keys_keep_the_last_value():
    pairs = text("k") + text("1") + text("j") + text("2") + text("k") + text("3")
    raw = b"\x01\x01" + varint(1) + text("n") + varint(3) + pairs + b"\0" + b"\0"
    assert dict(decode_batch(pa.array([raw], pa.binary())).to_pylist()[0]["tags"]) == {"j": "2", "k": "3"}


def test_round_trip_in_spark(spark):
    rows = [GOLDEN, (dt.datetime(1960, 5, 5, 1, 2, 3, 456000), "é", {}, {"x": -0.5})]
    df = spark.createDataFrame(rows, MEASUREMENT)
    back = encode_avro_v1(df).select(decode_avro_v1("value").alias("d")).select(
        F.timestamp_millis("d.ms").alias("ts"), "d.name", "d.tags", "d.fields")
    assert [tuple(r) for r in back.collect()] == rows


def test_struct_round_trip(spark):
    df = spark.createDataFrame([GOLDEN], MEASUREMENT)
    assert [tuple(r) for r in struct_to_measurement(measurement_to_struct(df)).collect()] == [GOLDEN]


def test_key_is_four_bytes_whatever_the_map_order(spark):
    a = (GOLDEN[0], "n", {"a": "1", "b": "2"}, {"x": 1.0})
    b = (GOLDEN[0], "n", {"b": "2", "a": "1"}, {"x": 2.0})
    keys = {bytes(r.key) for r in to_topic_records(spark.createDataFrame([a, b], MEASUREMENT)).collect()}
    assert len(keys) == 1 and len(keys.pop()) == 4


def snapshot(metrics, **header):
    base = {"time": 1700000000123, "reset-time": 5, "version": "0.0.1", "samza-version": "1.0"}
    base.update(header)
    return json.dumps({"header": {k: v for k, v in base.items() if v is not None}, "metrics": metrics})


def decode_text(spark, *texts):
    df = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "id int, value binary")
    return decode_envelope(df)


def measured(df):
    return sorted(((r.id, r["name"], tuple(sorted(r.tags.items())), tuple(sorted(r.fields.items())))
                   for r in df.collect()), key=str)


FIELD_GOLDENS = [
    ("buffered-message-count-SystemStreamPartition [kafkaevents, datasync, 5]",
     dict(system="kafkaevents", topic="datasync", partition="5"), "buffered-message-count"),
    ("kafkaevents-datasync-10-messages-behind-high-watermark",
     dict(system="kafkaevents", topic="datasync", partition="10"), "messages-behind-high-watermark"),
    ("kafkayarn-bl-message-s01.visualdna.com-9092-bytes-read",
     dict(system="kafkayarn", broker="bl-message-s01.visualdna.com-9092"), "bytes-read"),
    ("taskname-partition 4-sends", dict(task="taskname", partition="4"), "sends"),
    ("partition 4-restore-time", dict(partition="4"), "restore-time"),
    ("commit-calls", dict(system="commit"), "calls"),
    ("a-b-c-10-x", dict(system="a", broker="b-c-10"), "x"),
    ("sys-my-topic-3-lag", dict(system="sys", broker="my-topic-3"), "lag"),
    ("window_ns", {}, "window_ns"),
]


@pytest.mark.parametrize("prefix,tagged", [("org.apache.samza.", True), ("org.apache.other.", False)])
def test_field_names(spark, prefix, tagged):
    texts = [snapshot({f"{prefix}x": {name: 1}}) for name, _t, _f in FIELD_GOLDENS]
    got = {r.id: r for r in decode_text(spark, *texts).collect()}
    for i, (name, tags, left) in enumerate(FIELD_GOLDENS):
        expected = {"samza-version": "1.0", **(tags if tagged else {})}
        assert got[i].tags == expected and got[i].fields == {left if tagged else name: 1.0}


def test_only_numbers_are_fields(spark):
    text = ('{"header":{"time":1,"version":"0.0.1","samza-version":"x"},"metrics":{"g":{"a":"5","b":true,"c":null,'
            '"d":{"x":1},"e":[1],"f":123456789012345678901234567890,"g":1e400,"h":9223372036854775808,'
            '"i":9223372036854775807,"j":-9223372036854775808,"k":2.0,"l":0.1,"m":1e19,"n":-3}}}')
    rows = decode_text(spark, text).collect()
    assert len(rows) == 1
    assert rows[0].fields == {"i": 2.0 ** 63, "j": -2.0 ** 63, "k": 2.0, "l": 0.1, "m": 1e19, "n": -3.0}


def test_fields_share_a_measurement_by_tags_and_the_last_counts(spark):
    group = {"a-t-1-x": 1, "b-t-1-x": 2, "a-t-1-y": 3, "x-SystemStreamPartition [a, t, 1]": 4, "z": 5}
    got = measured(decode_text(spark, snapshot({"org.apache.samza.m": group}, job="j", count=3)))
    common = {"samza-version": "1.0", "job": "j"}
    expected = [({"system": "a", "topic": "t", "partition": "1"}, {"x": 4.0, "y": 3.0}),
                ({"system": "b", "topic": "t", "partition": "1"}, {"x": 2.0}), ({}, {"z": 5.0})]
    assert got == sorted(((0, "org.apache.samza.m", tuple(sorted({**common, **t}.items())),
                           tuple(sorted(f.items()))) for t, f in expected), key=str)


def test_field_tags_win_over_header_tags(spark):
    rows = decode_text(spark, snapshot({"org.apache.samza.m": {"commit-calls": 1}}, system="header")).collect()
    assert rows[0].tags["system"] == "commit"


def test_repeated_json_keys_keep_the_last(spark):
    text = ('{"header":{"time":1,"version":"0.0.1","samza-version":"x","job":"a","job":"b"},'
            '"metrics":{"g":{"v":1,"v":2}}}')
    rows = decode_text(spark, text).collect()
    assert rows[0].tags["job"] == "b" and rows[0].fields == {"v": 2.0}


def test_a_group_that_is_no_object_does_not_hide_the_others(spark):
    rows = decode_text(spark, snapshot({"a": 5, "b": {"x": 1}, "c": {}})).collect()
    assert [(r["name"], r.error) for r in rows] == [("b", None)]


def test_refused_documents(spark):
    texts = [snapshot({"g": {"x": 1}}, version="0.0.2"), snapshot({"g": {"x": 1}}, **{"samza-version": None}),
             '{"a":1}', "{oops", snapshot({"g": {"x": 1}}, version=None), snapshot({"g": {"x": 1}}, time=None),
             snapshot({})]
    rows = {r.id: r.error for r in decode_text(spark, *texts).collect()}
    assert set(rows) == {1, 2, 3, 4, 5} and all(rows.values())


def test_envelope_keeps_good_records_of_a_bad_batch(spark):
    good = record(1000, "n", {"a": "b"}, {"x": 1.0})
    values = [good, b"\x00abc", b"zzz", b"", b"\x01\x05", None, snapshot({"g": {"x": 2}}).encode()]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)],
                               "id int, value binary")
    ok, bad = split_rejects(decode_envelope(df))
    assert sorted(r.id for r in ok.collect()) == [0, 6]
    assert sorted(r.id for r in bad.collect()) == [1, 2, 3, 4] and bad.columns == ["id", "error"]


def test_decoding_does_not_shuffle_and_reads_once(spark, tmp_path):
    spark.createDataFrame([(bytearray(b"{}"),)], "value binary").write.parquet(str(tmp_path / "t"))
    df = split_rejects(decode_envelope(spark.read.parquet(str(tmp_path / "t"))))[0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1 and plan.count("ArrowEvalPython") == 1


def test_the_encoder_leaves_null_values_out():
    tags, fields = pa.map_(pa.string(), pa.string()), pa.map_(pa.string(), pa.float64())

    def encoded(*rows):
        ms, names, tag_maps, field_maps = (list(c) for c in zip(*rows))
        return encode_batch(pa.array(ms, pa.int64()), pa.array(names), pa.array(tag_maps, tags), pa.array(field_maps, fields)).to_pylist()

    nulls = [(1, "a", [("k", None), ("l", "x")], [("f", 1.0), ("g", None), ("h", 2.0)]), (2, "b", [("k", None)], [("f", None)]),
             (3, "c", None, [("f", 0.5)]), (4, "d", [("k", ""), ("m", None)], [])]
    without = [(1, "a", [("l", "x")], [("f", 1.0), ("h", 2.0)]), (2, "b", [], []), (3, "c", [], [("f", 0.5)]), (4, "d", [("k", "")], [])]
    assert encoded(*nulls) == encoded(*without)
    read = decode_batch(pa.array(encoded(*nulls))).to_pylist()
    assert [(r["ms"], r["tags"], r["fields"]) for r in read] == [(ms, t, f) for ms, _, t, f in without]
