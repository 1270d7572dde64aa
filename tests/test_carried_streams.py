"""Values carried forward over streams, by groups of keys."""

import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.operators.upsert import carry_forward
from pulsegrid.streaming.state import carry_forward_stream

SCHEMA = "k bigint, t timestamp, x double, ts timestamp, value double"


def test_keys_share_groups_and_keep_their_values(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(None if k == 0 else 2 ** 53 + k, start + dt.timedelta(microseconds=k) if k % 3 else None, 0.1 * k if k % 5 else None,
             start + dt.timedelta(minutes=7 * k % 600 + 250 * n, seconds=k), None if (k + n) % 7 == 0 else 1.0 * k + n)
            for k in range(60) for n in range(3)]
    clock = [(-1, None, None, dt.datetime(2024, 1, 3), 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for part in (df.filter("ts < '2024-01-01 08:00:00'"), df.filter("ts >= '2024-01-01 08:00:00'"), spark.createDataFrame(clock, SCHEMA)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    keys = ["k", "t", "x"]
    for expire in (None, 7200):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        held = carry_forward_stream(stream, keys, "value", 1800, delay="1 hour", expire=expire, groups=3)
        out = str(tmp_path / f"out-{expire}")
        job = held.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(
            availableNow=True).start()
        job.awaitTermination()
        assert 1 <= max(p.stateOperators[0].numRowsTotal for p in job.recentProgress) <= 3
        whole = carry_forward(df, keys, "value", "2024-01-02 20:00:00", 1800, expire=expire)
        shown = spark.read.schema(held.schema).parquet(out).filter(F.col("tick") < "2024-01-02 20:00:00").filter("k is null or k <> -1")
        assert held.schema == stream.select(*keys, F.col("ts").alias("tick"), "value").schema
        assert sorted(map(str, shown.collect())) == sorted(map(str, whole.collect()))
        assert shown.count() > 1000 or expire is not None
