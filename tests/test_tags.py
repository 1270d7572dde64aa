import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import tags as T
from pulsegrid.functions import values as V
from pulsegrid.sources.beans import mbean_to_measurements
from pulsegrid.sources.registry import registry_to_measurements


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


def test_overlay_and_fixed_tags(spark):
    over = T.overlay_map(T.literal_map({"a": "1", "b": "1"}), T.literal_map({"b": "2", "c": "2"}))
    assert one(spark, over) == {"a": "1", "b": "2", "c": "2"}
    df = spark.range(1).withColumn("tags", T.literal_map({"host": "own"}))
    assert T.with_fixed_tags(df, {"host": "fixed", "dc": "x"}).collect()[0].tags == {"host": "own", "dc": "x"}


@pytest.mark.parametrize("scope,expected,odd", [
    ("topic.foo.partition.3", {"topic": "foo", "partition": "3"}, False),
    ("topic.foo.topic.bar", {"topic": "bar"}, False),
    ("topic.foo.partition", {}, True),
    ("topic.foo..", {"topic": "foo"}, False),
    ("...", {}, False),
    (".a", {"": "a"}, False),
])
def test_decompose_scope(spark, scope, expected, odd):
    assert one(spark, T.decompose_scope(F.lit(scope))) == expected
    assert one(spark, T.scope_is_odd(F.lit("kafka.server"), F.lit(scope))) is odd


@pytest.mark.parametrize("group,type_,scope,expected", [
    ("kafka.server", "T", "topic.foo", {"group": "kafka.server", "type": "T", "topic": "foo"}),
    ("kafka.server", "T", "plain", {"group": "kafka.server", "type": "T", "scope": "plain"}),
    ("other", "T", "a.b", {"group": "other", "type": "T", "scope": "a.b"}),
    ("kafka.server", "T", "type.own", {"group": "kafka.server", "type": "own"}),
    ("", None, "", {}), (None, "", None, {}), (None, None, "a.b", {"scope": "a.b"}),
])
def test_metric_name_tags(spark, group, type_, scope, expected):
    cols = [F.lit(x).cast("string") for x in (group, type_, scope)]
    assert one(spark, T.metric_name_tags(*cols)) == expected


def test_object_name_parts(spark):
    got = one(spark, T.object_name_parts(F.lit('kafka.consumer:type=Group,name=ConsumerLag,x="a,b=c"')))
    assert got.domain == "kafka.consumer"
    assert got.key_props == {"type": "Group", "name": "ConsumerLag", "x": '"a,b=c"'}
    assert one(spark, T.object_name_parts(F.lit("java.lang:"))).key_props == {}


@pytest.mark.parametrize("pattern,matches", [
    ("*:*", True), ("kafka.*:*", True), ("kafka?server:*", True), ("kafkaXserver:*", False), ("kafka:*", False),
    ("kafka.server:type=T,*", True), ("kafka.server:type=T", False), ("kafka.server:type=T,name=N", True),
    ("kafka.server:name=N,type=T", True), ("kafka.server:type=U,*", False), ("kafka.server:type=T,id=1,*", False),
    ("kafka.server:name=?,*", True),
])
def test_scope_match(spark, pattern, matches):
    assert one(spark, T.scope_match(pattern, F.lit("kafka.server"), T.literal_map({"type": "T", "name": "N"}))) is matches


def test_values(spark):
    df = spark.createDataFrame([(1.5, float("nan"), float("inf"), 2 ** 60, True, "5")],
                               "d double, n double, i double, l long, b boolean, s string")
    row = df.select(*[V.any_to_double(df, c).alias(c) for c in df.columns]).collect()[0]
    assert tuple(row) == (1.5, None, None, float(2 ** 60), None, None)


@pytest.mark.parametrize("text,seconds", [(10, 10), ("10", 10), ("10s", 10), ("1m", 60), ("2h", 7200), ("1d", 86400)])
def test_interval(text, seconds):
    assert V.interval_seconds(text) == seconds


def test_bad_interval():
    with pytest.raises(ValueError):
        V.interval_seconds("ten")


def test_floor_div(spark):
    for n, w, q in ((7, 2, 3), (-7, 2, -4), (6, 3, 2), (1_700_000_000_000_001, 10_000_000, 170_000_000)):
        assert one(spark, V.floor_div(F.lit(n).cast("bigint"), w)) == q


ATTRS = ("scan_ts timestamp, address string, domain string, key_props map<string,string>, attr string, "
         "value_type string, value_double double, value_long long, value_text string")


def test_beans(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    named, plain = {"type": "T", "name": "Rate", "group": "g1"}, {"type": "Memory"}
    rows = [
        (t, "a", "kafka.x", named, "Count", "long", None, 7, None),
        (t, "a", "kafka.x", named, "Mean", "double", 1.5, None, None),
        (t, "a", "kafka.x", named, "Bad", "double", float("nan"), None, None),
        (t, "a", "kafka.x", named, "Text", "string", None, None, "x"),
        (t, "a", "java.lang", plain, "Used", "long", None, 3, None),
        (t, "a", "java.lang", plain, "Free", "long", None, 4, None),
        (t, "a", "java.lang", {"type": "Empty", "name": "E"}, "Text", "string", None, None, "x"),
    ]
    got = mbean_to_measurements(spark.createDataFrame(rows, ATTRS), {"host": "h", "type": "fixed", "group": "f"})
    got = {r["name"]: (r.tags, r.fields) for r in got.collect()}
    assert got == {
        "Rate": ({"host": "h", "type": "T", "group": "g1"}, {"Count": 7.0, "Mean": 1.5}),
        "Used": ({"host": "h", "type": "Memory", "group": "java.lang"}, {"Value": 3.0}),
        "Free": ({"host": "h", "type": "Memory", "group": "java.lang"}, {"Value": 4.0}),
    }


SNAPSHOT = ("tick timestamp, kind string, `group` string, type string, name string, scope string, "
            "client_tags map<string,string>, values map<string,double>")


def test_registry(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    everything = {"Value": 1.0, "Count": 2.0, "MeanRate": 3.0, "Max": 4.0, "99thPercentile": 5.0}
    rows = [(t, kind, "kafka.g", "T", kind, "a.b", {"group": "own", "id": "c"}, everything)
            for kind in ("gauge", "counter", "meter", "timer", "histogram", "client")]
    rows += [(t, "gauge", "g", "T", "nan", None, None, {"Value": float("nan")}),
             (t, "meter", "g", "T", "inf", None, None, {"MeanRate": float("inf")}),
             (t, "gauge", "kafka.g", "T", "odd", "a.b.c", None, {"Value": 1.0})]
    got = {r["name"]: r for r in registry_to_measurements(spark.createDataFrame(rows, SNAPSHOT), {"dc": "d"}).collect()}
    keys = {name: set(r.fields) for name, r in got.items()}
    assert keys == {
        "gauge": {"Value"}, "client": {"Value"}, "counter": {"Count"}, "meter": {"Count", "MeanRate"},
        "timer": {"Count", "MeanRate", "Max"}, "histogram": {"Count", "Max", "99thPercentile"},
        "inf": {"MeanRate"}, "odd": {"Value"}}
    assert got["meter"].tags == {"dc": "d", "group": "kafka.g", "type": "T", "a": "b"}
    assert got["client"].tags == {"dc": "d", "group": "own", "id": "c"}
    assert got["odd"].error and got["gauge"].error is None
