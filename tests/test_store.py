"""The point store with several writers and time zones; values that are no numbers; redelivery; rejects."""

import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.operators.filters import time_range
from pulsegrid.operators.quantiles import exact_percentiles
from pulsegrid.operators.summary import summarise_gauge
from pulsegrid.plans.panels import Range, evaluate, evaluate_store
from pulsegrid.sources.envelope import decode_envelope, split_rejects
from pulsegrid.sources import points as store
from pulsegrid.sources.ledger import Folder
from pulsegrid.sources.points import compact_points, drop_replaced, read_points, stored_points, write_points
from pulsegrid.sources.topic import producer_options, reserve, write_files, write_topic
from pulsegrid.streaming.jobs import drop_redelivered, load_topic_to_points

SCHEMA = "ts timestamp, name string, tags map<string,string>, fields map<string,double>"


def point(hour, measurement, fields, **tags):
    return (dt.datetime(2024, 1, 1 + hour // 24, hour % 24), measurement, tags, fields)


def flat(df):
    return sorted((r.ts.isoformat(), r.name, sorted(r.fields.items())) for r in df.collect())


def test_two_jobs_feed_one_store(spark, tmp_path):
    out = str(tmp_path / "store")
    for name in ("one", "two"):
        topic = str(tmp_path / f"topic-{name}")
        write_topic(spark.createDataFrame([point(k, name, {"x": float(k)}) for k in range(3)], SCHEMA),
                    format="parquet", path=topic)
        records = spark.readStream.schema(spark.read.parquet(topic).schema).parquet(topic)
        load_topic_to_points(records, out, str(tmp_path / f"checkpoint-{name}"), None).awaitTermination()
    assert {r[1] for r in flat(read_points(spark, out))} == {"one", "two"}
    # a batch that is written again takes its other days along
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_points(spark.createDataFrame([point(0, "a", {"x": 1.0})], SCHEMA), out, 0, writer="w")
        write_points(spark.createDataFrame([point(30, "a", {"x": 1.0})], SCHEMA), out, 0, writer="w")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r[0] for r in flat(read_points(spark, out)) if r[1] == "a"] == ["2024-01-02T06:00:00"]


def test_writing_after_compaction_keeps_history(spark, tmp_path):
    path, target = str(tmp_path / "a"), str(tmp_path / "b")
    write_points(spark.createDataFrame([point(0, "a", {"x": 1.0, "y": 2.0})], SCHEMA), path, 0)
    compact_points(spark, path, target)
    write_points(spark.createDataFrame([point(0, "a", {"x": 5.0}), point(1, "b", {"x": 1.0})], SCHEMA), target, 0)
    assert [r[2] for r in flat(read_points(spark, target))] == [[("x", 5.0), ("y", 2.0)], [("x", 1.0)]]


def test_days_do_not_depend_on_the_zone(spark, tmp_path):
    path = str(tmp_path / "zones")
    write_points(spark.createDataFrame([point(k, "a", {"x": 1.0}) for k in range(48)], SCHEMA), path, 0)
    try:
        for zone in ("Asia/Tokyo", "America/Los_Angeles", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for hours in ((0, 24), (20, 30)):
                start, end = (spark.sql(f"SELECT string(timestamp_seconds({1704067200 + 3600 * h}))").first()[0] for h in hours)
                found = read_points(spark, path, where=lambda p: time_range(p, start, end))
                assert found.count() == hours[1] - hours[0], (zone, hours)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_panel_over_the_store_reads_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "panel")
    rows = [point(k, name, {"OneMinuteRate": float(k), "Value": 1.0}, name="main", group="kafka.server", topic=f"t{k % 3}",
                  service="broker-1") for k in range(48) for name in ("BytesInPerSec", "BytesOutPerSec")]
    df = spark.createDataFrame(rows, SCHEMA)
    write_points(df, path, 0)
    asked = Range("main", "2024-01-01 00:00:00", "2024-01-02 00:00:00", interval="1h", topics="t[01]")
    shown = evaluate_store(spark, path, "Q01", asked)
    plan = shown._sc._jvm.PythonSQLUtils.explainString(shown._jdf.queryExecution(), "formatted")
    days = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "(d#" in days and "EqualTo(tag_name,main)" in pushed and "EqualTo(name,BytesInPerSec)" in pushed, (days, pushed)
    key = lambda r: (r.bucket, r.series)
    assert sorted(shown.collect(), key=key) == sorted(evaluate(df, "Q01", asked).collect(), key=key)


def test_percentiles_of_values_that_are_no_numbers(spark):
    inf, nan = float("inf"), float("nan")
    groups = {"nan": [1.0, 2.0, 3.0, 4.0, nan], "inf": [1.0, 2.0, inf], "both": [-inf, -inf, 5.0, inf, nan],
              "plain": [-3.0, 0.0, -0.0, 4.5]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    asked = {"median": 0.5, "high": 1.0, "low": 0.0, "between": 0.6}
    got = {r.k: r for r in exact_percentiles(df, ["k"], "v", asked).collect()}
    assert (got["nan"].median, got["inf"].median, got["both"].median, got["plain"].median) == (3.0, 2.0, 5.0, 0.0)
    assert got["nan"].high != got["nan"].high and got["inf"].high == inf and got["both"].low == -inf
    assert got["inf"].between == inf


def test_gauge_of_text(spark):
    df = spark.createDataFrame([(1, "a", "7"), (2, "a", "high"), (1, "b", "low")], "ts int, k string, value string")
    assert [tuple(r) for r in summarise_gauge(df, ["k"]).collect()] == [("a", 7.0)]


def test_redelivery_with_other_fields_stays(spark):
    rows = [point(0, "a", {"x": 1.0}), point(0, "a", {"y": 2.0}), point(0, "a", {"x": 1.0}), point(0, "a", {"x": 3.0})]
    once = drop_redelivered(spark.createDataFrame(rows, SCHEMA))
    assert sorted(sorted(r.fields.items()) for r in once.collect()) == [[("x", 1.0)], [("x", 3.0)], [("y", 2.0)]]


def test_rejects_keep_their_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"\x00abc"),), (bytearray(b"zz"),)], "value binary")
    good, bad = split_rejects(decode_envelope(df.withColumn("payload", F.col("value"))))
    assert good.columns == ["ts", "name", "tags", "fields"]
    assert sorted(bytes(r.payload) for r in bad.collect()) == [b"\x00abc", b"zz"]


def test_topic_offsets_go_on_and_streams_are_written(spark, tmp_path):
    df = spark.createDataFrame([point(k, "a", {"x": float(k)}) for k in range(4)], SCHEMA)
    path, rows = str(tmp_path / "topic"), str(tmp_path / "rows")
    write_topic(df, format="parquet", path=path)
    df.write.parquet(rows)
    stream = spark.readStream.schema(df.schema).parquet(rows)
    write_topic(stream, format="parquet", path=path, checkpoint=str(tmp_path / "checkpoint"),
                trigger={"availableNow": True}).awaitTermination()
    found = spark.read.parquet(path).select("partition", "offset").collect()
    assert len(found) == len(set(found)) == 8
    assert producer_options({"producer.acks": "all", "producer.topic": "t", "other": "x"})["kafka.acks"] == "all"


def test_offsets_never_repeat(spark, tmp_path):
    path = str(tmp_path / "topic")
    one = spark.createDataFrame([point(0, "a", {"x": 1.0})], SCHEMA)
    for _ in range(3):
        write_topic(one, format="parquet", path=path)
    write_files(one, "metrics", "parquet", path, "writer-7")
    write_files(one, "metrics", "parquet", path, "writer-7")  # tried again
    write_files(one.limit(0), "metrics", "parquet", path, "writer-8")
    offsets = sorted(r.offset for r in spark.read.parquet(path).collect())
    assert len(offsets) == len(set(offsets)) == 4
    # ranges of writers at the same time do not touch
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(4) as pool:
        firsts = sorted(pool.map(lambda _: reserve(spark, path, 10), range(12)))
    assert all(b - a == 10 for a, b in zip(firsts, firsts[1:])) and firsts[0] > offsets[-1]


def values(spark, path):
    return {(r.ts.hour, k): v for r in read_points(spark, path).collect() for k, v in r.fields.items()}


def test_points_are_resolved_in_their_buckets(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [point(k, "a", {"x": float(k), "y": 1.0}, topic=f"t{k % 5}") for k in range(60)]
    for batch in range(3):
        write_points(spark.createDataFrame(rows[batch:], SCHEMA), path, batch, writer="w")
    plan = read_points(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan, plan
    pruned = read_points(spark, path, where=lambda p: time_range(p, "2024-01-02", "2024-01-03"))
    assert "Exchange" not in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 24 and read_points(spark, path).count() == 60
    shuffled = spark.createDataFrame(rows * 2, SCHEMA).repartition(7)  # a hot series is spread over the buckets
    write_points(shuffled, path, 9)
    assert stored_points(spark, path).select("slot").distinct().count() >= 60


def test_readers_see_whole_commits_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    write_points(spark.createDataFrame([point(0, "a", {"x": 1.0})], SCHEMA), path, 0, writer="w")
    own = store._log

    def broken(log, change):
        if change.__name__ == "end":
            raise OSError("the writer dies before its commit")
        return own(log, change)

    with monkeypatch.context() as m:
        m.setattr(store, "_log", broken)
        for batch in (0, 1):
            try:
                write_points(spark.createDataFrame([point(0, "a", {"x": 7.0}), point(5, "a", {"x": 7.0})], SCHEMA), path, batch,
                             writer="w")
            except OSError:
                pass
    assert values(spark, path) == {(0, "x"): 1.0}
    assert len(Folder(spark, f"{path}/metrics/default/data").names()) == 3
    assert drop_replaced(spark, path) == []  # too young
    assert len(drop_replaced(spark, path, age=0)) == 2
    assert values(spark, path) == {(0, "x"): 1.0}


def test_ranks_outlive_compaction_and_retries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "SNAPSHOT", 3)  # the state is read from snapshots
    path = str(tmp_path / "store")

    def write(batch, writer="w", **fields):
        write_points(spark.createDataFrame([point(0, "a", fields), point(30, "b", fields)], SCHEMA), path, batch, writer=writer)

    write(0, x=1.0, y=1.0, z=1.0)
    write(0, writer="other", y=3.0, z=2.0)
    compact_points(spark, path)
    assert stored_points(spark, path).select("commit").distinct().count() == 1
    write(0, x=9.0, y=9.0, z=9.0)  # the last batch of its writer again: as old as it was
    write(1, z=4.0)
    write(2, x=5.0)
    write(1, x=8.0, z=4.0)  # and one that is live
    compact_points(spark, path)
    compact_points(spark, path)
    assert values(spark, path) == {(0, "x"): 5.0, (0, "y"): 3.0, (0, "z"): 4.0, (6, "x"): 5.0, (6, "y"): 3.0, (6, "z"): 4.0}
    assert stored_points(spark, path).select("commit").distinct().count() == 1
    compact_points(spark, path, before="2024-01-01")


def test_a_write_during_compaction_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    for batch in (0, 1):
        write_points(spark.createDataFrame([point(0, "a", {"x": float(batch)})], SCHEMA), path, batch, writer="w")
    own, late = store._store, []

    def slow(rows, base, buckets):
        done = own(rows, base, buckets)
        if not late:  # another commit, and one that replaces an input, before the compaction's own
            late.append(True)
            write_points(spark.createDataFrame([point(0, "a", {"y": 5.0})], SCHEMA), path, 2, writer="w")
            write_points(spark.createDataFrame([point(0, "a", {"x": 8.0})], SCHEMA), path, 1, writer="w")
        return done

    monkeypatch.setattr(store, "_store", slow)
    compact_points(spark, path)
    assert values(spark, path) == {(0, "x"): 8.0, (0, "y"): 5.0}
    assert stored_points(spark, path).select("commit").distinct().count() == 1


def test_writers_at_the_same_time(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    path = str(tmp_path / "store")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: write_points(spark.createDataFrame([point(k, "a", {"x": float(k)})], SCHEMA), path, 0), range(8)))
    assert values(spark, path) == {(k, "x"): float(k) for k in range(8)}
    assert read_points(spark, str(tmp_path / "nothing")).collect() == []


def test_redelivered_copies_take_no_state(spark, tmp_path):
    """The state holds a row for each delivery that is kept, however many copies there are and wherever they lie."""
    rows = [(*point(k % 24, "a", {"x": float(k)}, t=t), copy) for k in range(40) for t in ("u", None) for copy in range(3)]
    rows += [(dt.datetime(2024, 1, 1), "a", tags, {"x": 0.0}, copy) for copy in range(3)
             for tags in ({"b": None, "c": "d"}, {"b": "c", "d": None}, {})]
    rows += [(dt.datetime(2024, 1, 1), "a", {}, {"x": x}, copy) for copy in range(3) for x in (-0.0, float("nan"), None)]
    df = spark.createDataFrame(rows, SCHEMA + ", place int")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    for spread in (None, ["place"]):
        once = drop_redelivered(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "2 days", spread)
        out = str(tmp_path / f"out-{spread}")
        job = once.drop("place").writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start()
        job.awaitTermination()
        states = [s.numRowsTotal for s in job.recentProgress[0].stateOperators]
        found = [(r.ts, str(sorted(r.tags.items(), key=str)), str(r.fields["x"])) for r in spark.read.parquet(out).collect()]
        assert (len(found), len(set(found)), states) == (86, 86, [86])


def test_large_stores_have_more_buckets_and_tasks(spark, tmp_path, monkeypatch):
    """A task's share of a store stays, whether its first write is large or later ones are, also through compaction."""
    monkeypatch.setattr(store, "CELLS", 50)
    rows = [point(k % 48, "a", {"x": float(k), "y": 1.0}, t=str(k)) for k in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    first, grown, target = (str(tmp_path / p) for p in ("first", "grown", "target"))
    write_points(df, first, 0)
    assert read_points(spark, first).rdd.getNumPartitions() == 24  # 400 rows of two values, 50 for each
    write_points(df.limit(1), grown, 0)
    for batch in range(3):
        write_points(df.withColumn("fields", F.create_map(F.lit("x"), F.lit(float(batch)))), grown, 1 + batch, writer="w")
    assert read_points(spark, grown).rdd.getNumPartitions() == 49
    late = [r.fields["x"] for r in read_points(spark, grown).select("fields").collect()]
    assert late == [2.0] * 400
    compact_points(spark, grown, target)
    assert flat(read_points(spark, target)) == flat(read_points(spark, grown))
    compact_points(spark, grown)
    assert flat(read_points(spark, target)) == flat(read_points(spark, grown))
    assert stored_points(spark, grown).groupBy("commit", "d").count().groupBy("d").count().filter("count > 1").count() == 0


def test_a_batch_is_decoded_by_size_not_by_file(spark, tmp_path, monkeypatch):
    """Records of one file go to several tasks, and only rejects keep their payload there."""
    from pulsegrid.streaming import jobs
    topic, out, seen = str(tmp_path / "topic"), str(tmp_path / "out"), []
    rows = [point(k % 48, f"n{k}", {"x": float(k)}) for k in range(2000)]
    write_topic(spark.createDataFrame(rows, SCHEMA).coalesce(1), format="parquet", path=str(tmp_path / "many"))
    bad = spark.range(1).selectExpr("cast(null as binary) AS key", "cast('?' as binary) AS value", "'metrics' AS topic", "0 AS partition",
                                    "-1L AS offset", "current_timestamp() AS timestamp")
    records = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "many"))
    records.unionByName(bad).coalesce(1).write.parquet(topic)

    def split(decoded):
        kept = decoded.select(F.spark_partition_id().alias("part"), "error", "payload").collect()
        seen.append((len({r.part for r in kept}), sum(r.payload is not None for r in kept), sum(r.error is not None for r in kept)))
        return split_rejects(decoded)

    monkeypatch.setattr(jobs, "split_rejects", split)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                                   "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    for key in before:
        spark.conf.set(key, "8k")
    try:
        stream = spark.readStream.schema(spark.read.parquet(topic).schema).parquet(topic)
        load_topic_to_points(stream, out, str(tmp_path / "checkpoint"), None).awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    (tasks, payloads, errors), = seen
    assert tasks > 1 and payloads == errors == 1
    assert read_points(spark, out).count() == 2000
    assert [bytes(r.payload) for r in spark.read.parquet(f"{out}/rejects").collect()] == [b"?"]


def test_many_tasks_are_reached_in_two_steps(spark, tmp_path, monkeypatch):
    """What a sender of a large write holds does not follow its input: no shuffle goes from the input to more than 200 tasks."""
    plans = []
    monkeypatch.setattr(store, "CELLS", 2)
    rows = [point(k % 48, "a", {"x": float(k), "y": 1.0}, t=str(k)) for k in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    with monkeypatch.context() as within:
        within.setattr(store, "_store", lambda rows, *_: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), ("c", []))[1])
        write_points(df, str(tmp_path / "planned"), 0)
    widths = [int(line.split("REPARTITION_BY_NUM")[0].rstrip(" ,)").rsplit(" ", 1)[1]) for line in plans[0].splitlines() if "REPARTITION_BY_NUM" in line]
    assert widths == [900, 200]  # the last one first
    # the same points by steps, also where a store has outgrown its buckets
    monkeypatch.setattr(store, "CELLS", 40)
    some, late = spark.createDataFrame(rows[:200], SCHEMA), F.create_map(F.lit("x"), F.lit(-1.0))
    for most in (200, 3):
        monkeypatch.setattr(store, "STREAMED", most)
        path = str(tmp_path / f"most-{most}")
        write_points(spark.createDataFrame(rows[:1], SCHEMA), path, 0)
        write_points(some, path, 1)
        write_points(some.withColumn("fields", late), path, 2)
        write_points(some.withColumn("fields", late), path, 3)
        found = read_points(spark, path)
        assert found.rdd.getNumPartitions() == 36  # 1403 values and rows, 40 for each
        assert sorted(r.tags["t"] for r in found.collect()) == sorted(str(k) for k in range(200))
        assert all(r.fields == {"x": -1.0, "y": 1.0} for r in found.collect())
