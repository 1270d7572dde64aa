import datetime as dt
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import buckets, summary
from pulsegrid.operators.lag import consumer_lag, controller_only, end_offsets_from_metrics
from pulsegrid.operators.pack import pack_fields
from pulsegrid.operators.quantiles import exact_percentiles
from pulsegrid.operators.skew import salted_join, with_next
from pulsegrid.operators.upsert import carry_forward, latest, upsert_points
from pulsegrid.schema import MEASUREMENT

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_percentiles_of_hot_and_odd_groups(spark):
    rng = random.Random(3)
    groups = {
        "hot": [rng.lognormvariate(0, 9) for _ in range(20000)],
        "same": [7.25] * 3000,
        "signs": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(501)] + [0.0, -0.0, 5e-324],
        "close": [1.0 + i * 2.0 ** -52 for i in range(1000)],
        "one": [3.0], "two": [1.0, 2.0], None: [4.0, 5.0, 9.0],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("empty", None)]
    quantiles = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p999": 0.999, "p100": 1.0}
    got = exact_percentiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", quantiles)
    got = {r.k: r for r in got.collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        assert got[k].n == len(vs)
        for name, q in quantiles.items():
            assert got[k][name] == pytest.approx(np.quantile(np.array(vs), q), rel=1e-12, abs=0), (k, name)


def test_percentiles_count_values_before_they_are_shuffled_on_and_scan_once(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v")).write.parquet(str(tmp_path / "t"))
    df = exact_percentiles(spark.read.parquet(str(tmp_path / "t")), ["k"], "v", {"m": 0.5})
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_only_rows_of_opened_bins_are_shuffled(spark, tmp_path, monkeypatch):
    from pulsegrid.operators import quantiles
    spark.range(20000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v")).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    df = exact_percentiles(rows, ["k"], "v", {"m": 0.5})
    few = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    lines = [x.strip() for x in plan.splitlines()]
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x)
    above = lines[:scan][::-1]  # from the scan up, the join with the opened bins comes before any exchange
    first = next(x for x in above if "BroadcastHashJoin" in x or "Exchange hashpartitioning" in x)
    assert "BroadcastHashJoin" in first, plan
    monkeypatch.setattr(quantiles, "OPENED", 0)  # more bins than that meet the rows by key
    other = exact_percentiles(rows, ["k"], "v", {"m": 0.5})
    assert sorted(map(tuple, other.collect())) == sorted(map(tuple, few))


def test_salted_join_keeps_every_row(spark):
    many = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), "id")
    one = spark.range(0, 5000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    inner = salted_join(many, one, ["k"], ["id"])
    assert sorted(map(tuple, inner.collect())) == sorted(map(tuple, many.join(one, "k").collect()))
    left = salted_join(many, one, ["k"], ["id"], "left")
    assert sorted(map(str, left.collect())) == sorted(map(str, many.join(one, "k", "left").collect()))


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_with_next_over_chunks(spark, chunk):
    rng = random.Random(chunk)
    rows = [(k, i, float(i * 2)) for k in ("a", None) for i in sorted(rng.sample(range(-20, 60), 17))]
    got = with_next(spark.createDataFrame(rows, "k string, i bigint, v double"), ["k"], "i", ["v"], chunk)
    by_key = defaultdict(list)
    for k, i, v in rows:
        by_key[k].append((i, v))
    expected = [(k, i, v, *(points[n + 1] if n + 1 < len(points) else (None, None)))
                for k, points in by_key.items() for n, (i, v) in enumerate(points)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_series_without_a_key_value_are_kept(spark):
    rows = [(k, at(s), float(s)) for k in ("a", None) for s in (0, 20, 7000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, value double")
    history = summary.counter_history(df, ["k"], 1)
    assert sorted((str(r.k), r.Count) for r in history.collect()) == [
        (k, n) for k in ("None", "a") for n in (1, 2, 3)]
    rates = summary.ewma_rate(df, ["k"], "2024-01-01 04:00:00", 600)
    assert sorted(Counter(str(r.k) for r in rates.collect()).items()) == [("None", 24), ("a", 24)]
    mixed = buckets.bucket_agg(df, 60, ["k"], {"n": ("count", "value"), "mid": ("median", "value")})
    assert sorted((str(r.k), r.n, r.mid) for r in mixed.collect()) == [
        (k, n, m) for k in ("None", "a") for n, m in ((1, 7000.0), (2, 10.0))]


def test_pack_fields_last_wins(spark):
    rows = [(1, {"a": "x", "b": "y"}, "f", 1.0, 1), (1, {"b": "y", "a": "x"}, "f", 2.0, 2),
            (1, {"a": "x", "b": "y"}, "g", 3.0, 0), (1, {"a": "x"}, "f", 4.0, 0)]
    df = spark.createDataFrame(rows, "id int, tags map<string,string>, field string, value double, pos int")
    got = {tuple(sorted(r.tags.items())): r.fields for r in pack_fields(df, ["id"], order="pos").collect()}
    assert got == {(("a", "x"), ("b", "y")): {"f": 2.0, "g": 3.0}, (("a", "x"),): {"f": 4.0}}


def points(df):
    return sorted((r.ts, r["name"], sorted(r.tags.items()), sorted(r.fields.items())) for r in df.collect())


def test_upsert_is_idempotent_and_ignores_input_order(spark):
    rng = random.Random(1)
    rows = [(at(rng.randint(0, 3)) + dt.timedelta(microseconds=rng.randint(0, 999)), rng.choice("mn"),
             {"t": rng.choice("xy")}, {rng.choice("fgh"): float(i)}, i) for i in range(400)]
    schema = "ts timestamp, name string, tags map<string,string>, fields map<string,double>, seq int"
    once = upsert_points(spark.createDataFrame(rows, schema), "seq")
    expected = {}
    for ts, name, tags, fields, _seq in rows:
        key = (ts.replace(microsecond=ts.microsecond // 1000 * 1000), name, tags["t"])
        expected.setdefault(key, {}).update(fields)
    assert points(once) == sorted((ts, name, [("t", t)], sorted(f.items())) for (ts, name, t), f in expected.items())
    rng.shuffle(rows)
    assert points(upsert_points(spark.createDataFrame(rows, schema), "seq")) == points(once)
    again = once.unionByName(once).withColumn("seq", F.lit(0))
    assert points(upsert_points(again, "seq")) == points(once)


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 5), ("a", 2, 7), ("b", 0, 1)], "k string, ts int, v int")
    assert sorted(map(tuple, latest(df, ["k"], ["ts"]).collect())) == [("a", 2, 7), ("b", 0, 1)]


def test_lag_cases(spark):
    ends = spark.createDataFrame([(at(0), "t", 0, 50), (at(1), "t", 0, 100), (at(0), "t", 1, 5)],
                                 "ts timestamp, topic string, partition int, end_offset bigint")
    committed = spark.createDataFrame([
        (at(0), "g", "t", 0, 10), (at(1), "g", "t", 0, 90), (at(0), "g", "t", 1, 9),
        (at(0), "g", "t", 2, 1), (at(0), "console-consumer-1", "t", 0, 1), (at(0), "h", "t", 0, None),
        (at(0), "h", "t", 1, 2)], "ts timestamp, group_id string, topic string, partition int, offset bigint")
    got = {(r.group_id, r.partition): r.lag for r in consumer_lag(ends, committed).collect()}
    assert got == {("g", 0): 10, ("g", 1): 0, ("h", 1): 3}


def test_end_offsets_from_metrics(spark):
    rows = [(at(0), "kafka.log", "LogEndOffset", s, 5.0) for s in (
        "topic.t.partition.3", "partition.4.topic.u", "topic.t", "topic.t.partition", "topic.t.partition.x")]
    rows += [(at(0), "kafka.log", "Size", "topic.t.partition.1", 1.0), (at(0), "x", "LogEndOffset", "topic.t.partition.1", 1.0)]
    df = spark.createDataFrame(rows, "ts timestamp, `group` string, name string, scope string, value double")
    got = sorted((r.topic, r.partition, r.end_offset) for r in end_offsets_from_metrics(df).collect())
    assert got == [("t", 3, 5), ("u", 4, 5)]


def test_controller_only(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (None, 1)], "reporter_id int, controller_id int")
    assert controller_only(df).count() == 1


def test_carry_forward(spark):
    rows = [("a", at(3), 1.0), ("a", at(9), 2.0), ("a", at(10), 3.0), ("a", at(41), 4.0), ("b", at(20), 5.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    end = "2024-01-01 00:01:00"
    got = sorted((r.k, (r.tick - T0).seconds, r.v) for r in carry_forward(df, ["k"], "v", end, 10).collect())
    assert got == [("a", 10, 3.0), ("a", 20, 3.0), ("a", 30, 3.0), ("a", 40, 3.0), ("a", 50, 4.0),
                   ("b", 20, 5.0), ("b", 30, 5.0), ("b", 40, 5.0), ("b", 50, 5.0)]
    short = carry_forward(df, ["k"], "v", end, 10, expire=20)
    got = sorted((r.k, (r.tick - T0).seconds) for r in short.collect())
    assert got == [("a", 10), ("a", 20), ("a", 50), ("b", 20), ("b", 30)]


def test_fill_and_connect(spark):
    rows = [("a", at(10), 1.0), ("a", at(40), 4.0), ("b", at(20), 9.0)]
    df = spark.createDataFrame(rows, "k string, bucket timestamp, v double")
    filled = buckets.fill_null(df, "2024-01-01", "2024-01-01 00:00:55", 10, ["k"])
    got = sorted(((r.bucket - T0).seconds, r.k, r.v) for r in filled.collect())
    assert [g for g in got if g[1] == "a"] == [(0, "a", None), (10, "a", 1.0), (20, "a", None), (30, "a", None),
                                               (40, "a", 4.0), (50, "a", None)]
    assert len(got) == 12
    joined = buckets.connect_nulls(filled, ["k"], "v", 10)
    got = {(r.k, (r.bucket - T0).seconds): r.v for r in joined.collect()}
    assert [got["a", s] for s in range(0, 60, 10)] == [None, 1.0, 2.0, 3.0, 4.0, None]
    assert [got["b", s] for s in range(0, 60, 10)] == [None, None, 9.0, None, None, None]


def test_fill_without_keys_and_without_rows(spark):
    df = spark.createDataFrame([(at(10), 1.0)], "bucket timestamp, v double")
    assert buckets.fill_null(df, "2024-01-01", "2024-01-01 00:00:30", 10, []).count() == 3
    assert buckets.fill_null(df.filter("v > 5"), "2024-01-01", "2024-01-01 00:00:30", 10, []).count() == 0


def test_last_and_median(spark):
    rows = [("a", at(1), 1.0), ("a", at(2), 2.0), ("a", at(3), 4.0), ("a", at(3), 10.0), ("a", at(4), None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    got = buckets.bucket_agg(df, 60, ["k"], {
        "newest": ("last", "v"), "mid": ("median", "v"), "hi": ("max", "v"), "lo": ("min", "v"), "n": ("count", "v")})
    assert tuple(got.collect()[0]) == (T0, "a", 10.0, 3.0, 10.0, 1.0, 4)


def test_levels_and_reduce(spark):
    rows = [("a", at(0), 5.0), ("a", at(10), 7.0), ("a", at(20), None), ("b", at(0), 12.0)]
    df = spark.createDataFrame(rows, "k string, bucket timestamp, v double")
    current = {r.k: r.v for r in buckets.series_reduce(df, ["k"], "v", "current").collect()}
    average = {r.k: r.v for r in buckets.series_reduce(df, ["k"], "v", "avg").collect()}
    assert current == {"a": 7.0, "b": 12.0} and average == {"a": 6.0, "b": 12.0}
    levels = [r.x for r in df.filter("v is not null").orderBy("v").select(
        buckets.threshold_level("v", 6, 12).alias("x")).collect()]
    assert levels == ["ok", "warn", "critical"]


def sequential_rates(ticks, first, last, tick, minutes):
    rates, out = {}, {}
    for k in range(first, last):
        now = ticks.get(k, 0) / tick
        for name, m in minutes.items():
            alpha = 1 - math.exp(-tick / 60 / m)
            rates[name] = now if k == first else rates[name] + alpha * (now - rates[name])
        out[k] = dict(rates)
    return out


@pytest.mark.parametrize("report,minutes", [(5, {"a": 1, "b": 15}), (60, {"a": 1, "b": 5}), (3600, {"a": 1, "b": 5})])
def test_moving_rates_equal_the_tick_by_tick_fold(spark, report, minutes):
    rng = random.Random(report)
    seconds = {"busy": sorted(rng.choices(range(0, 40000), k=3000)), "rare": [17, 30111]}
    rows = [(k, at(s)) for k, ss in seconds.items() for s in ss]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    until = "2024-01-01 12:00:00"
    got = summary.ewma_rate(df, ["k"], until, report, minutes=minutes)
    got = {(r.k, int((r["at"] - T0).total_seconds())): r for r in got.collect()}
    meters = {r.k: r for r in summary.summarise_meter(df, ["k"], until, minutes=minutes).collect()}
    seen = 0
    for k, ss in seconds.items():
        ticks = Counter(s // 5 for s in ss)
        fold = sequential_rates(ticks, min(ticks), 43200 // 5, 5, minutes)
        for end in range(report, 43200 + 1, report):
            if end // 5 - 1 in fold:
                seen += 1
                for name in minutes:
                    assert got[k, end][name] == pytest.approx(fold[end // 5 - 1][name], rel=1e-9, abs=1e-300)
        last = fold[43200 // 5 - 1]
        assert all(meters[k][n] == pytest.approx(last[n], rel=1e-9, abs=1e-300) for n in minutes)
        assert meters[k].Count == len(ss)
        assert meters[k].MeanRate == pytest.approx(len(ss) / (43200 - min(ticks) * 5))
    assert seen == len(got)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([("a", 3.0)], "k string, value double")
    row = summary.summarise_histogram(df, ["k"]).collect()[0]
    assert (row.Count, row.StdDev, row.Sum, row["999thPercentile"]) == (1.0, 0.0, 3.0, 3.0)
    assert set(summary.summarise_histogram(df, ["k"], exact=False).columns) == set(row.asDict())


def test_timer_has_no_percentiles(spark):
    df = spark.createDataFrame([("a", at(1), 3.0), ("a", at(8), 5.0)], "k string, ts timestamp, value double")
    row = summary.summarise_timer(df, ["k"], "2024-01-01 00:01:00").collect()[0].asDict()
    assert not [c for c in row if "Percentile" in c]
    assert (row["Count"], row["Max"], row["Sum"]) == (2.0, 5.0, 8.0)


def test_gauge_skips_what_is_no_number(spark):
    rows = [("a", at(1), 3.0), ("a", at(2), float("nan")), ("b", at(1), float("inf"))]
    df = spark.createDataFrame(rows, "k string, ts timestamp, value double")
    assert [tuple(r) for r in summary.summarise_gauge(df, ["k"]).collect()] == [("a", 3.0)]


def test_fields_of_a_summary(spark):
    df = spark.createDataFrame([("a", 3.0)], "k string, value double")
    packed = summary.as_fields(summary.summarise_histogram(df, ["k"]), ["Count", "Max"])
    assert packed.collect()[0].fields == {"Count": 1.0, "Max": 3.0}
    assert MEASUREMENT["fields"].dataType == packed.schema["fields"].dataType
