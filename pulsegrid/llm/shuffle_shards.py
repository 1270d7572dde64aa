"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

All rows are to be in random order, and shard j gets its exact number of them. How many rows partition p sends to
shard j is then a cell of a random matrix with given row sums (rows of the partitions) and column sums (sizes of
the shards): a multivariate hypergeometric draw. With the matrix known, every task deals out its own rows:

1. Draw: nobody holds the matrix. A task draws its own row by walking down a binary tree over the partitions: at each
   node the shards' rows left over are split between the halves, by a generator seeded by the node, so all tasks agree. The
   driver knows the rows and bytes of each partition and no more.
2. Permute locally: the labels of the row, in random order, go to the partition's rows, each with a random key of 63 bits.
3. Exchange, and permute again: keys order the rows of a shard. A block is an even stretch of a shard's keys, meant for
   ``block_rows`` rows and ``block_bytes`` bytes at most on average, so no group grows with the input. How many
   rows fall into each block follows from the partitions' sizes alone; those before a block, and a row's place in it,
   make its slot.

What a task draws is in proportion to its rows, and what it is sent to the number of partitions, whatever the number of blocks.

Rows are written to the checkpoint folder first, so that a task that runs again deals the same rows the same way.

Law: ``rows``. Shard sizes differ by one at most, the greater ones first. Equal texts are not kept together, as
any shuffle that did so would not be uniform. Defined cases: an empty table gives no rows; with fewer rows than
shards some shards stay empty; null texts have no bytes; repeated rows are rows like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, lgamma, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, stable, table
from pulsegrid.session import ensure_shared_dir, work_dir

BLOCK_ROWS = 100_000
BLOCK_BYTES = 16_000_000
EXCHANGE_BYTES = 128_000_000  # for each task of the exchange
BROADCAST_BLOCKS = 1_000_000  # of 20 bytes each
LARGEST = 10 ** 9  # populations that numpy draws from


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` things taken from ``good + bad`` are good.

    Beyond numpy's limit by ratio of uniforms under a table mountain (Stadlober 1990).
    """
    if not good or not bad or not drawn:
        return drawn if good else 0
    if good + bad < LARGEST:
        return int(rng.hypergeometric(good, bad, drawn))
    everything = good + bad
    share, few = good / everything, min(drawn, everything - drawn)
    mean = few * share
    spread = sqrt((everything - few) * few * share * (1 - share) / (everything - 1) + 0.5)
    height = 2 * sqrt(2 / np.e) * spread + (3 - 2 * sqrt(3 / np.e))
    low, high = max(0, few - bad), min(few, good)

    def weight(k: int) -> float:
        return -(lgamma(k + 1) + lgamma(good - k + 1) + lgamma(few - k + 1) + lgamma(bad - few + k + 1))

    top = weight(floor((few + 1) * (good + 1) / (everything + 2)))
    while True:
        u, v = rng.random(), rng.random()
        k = floor(mean + 0.5 + height * (v - 0.5) / u) if u else -1
        if low <= k <= high and 2 * log(u) <= weight(k) - top:
            return k if few == drawn else good - k


def split(rng: np.random.Generator, columns: np.ndarray, drawn: int) -> np.ndarray:
    """How many of ``drawn`` rows fall to each column, out of ``columns`` rows in all."""
    total = int(columns.sum())
    if total < LARGEST:
        return rng.multivariate_hypergeometric(columns, drawn, method="marginals")
    taken = np.zeros(len(columns), np.int64)
    for j, size in enumerate(columns.tolist()):
        taken[j] = hypergeometric(rng, size, total - size, drawn)
        total, drawn = total - size, drawn - int(taken[j])
    return taken


def matrix_row(sizes: np.ndarray, columns: np.ndarray, row: int, seed: int) -> np.ndarray:
    """Row ``row`` of the matrix with row sums ``sizes`` and column sums ``columns``."""
    low, high = 0, len(sizes)
    before = np.concatenate(([0], np.cumsum(sizes)))
    while high - low > 1:
        middle = (low + high) // 2
        left = split(np.random.default_rng([seed, low, high]), columns, int(before[middle] - before[low]))
        if row < middle:
            columns, high = left, middle
        else:
            columns, low = columns - left, middle
    return columns


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    return np.array([rows // shards + (shard < rows % shards) for shard in range(shards)], np.int64)


def draw(sizes: np.ndarray, columns: np.ndarray, parts: int, part: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and key of each row of a partition; block k of shard j, of ``parts`` each, is ``j * parts + k``."""
    rng = np.random.default_rng([seed, part])
    shard = np.repeat(np.arange(len(columns), dtype=np.int64), matrix_row(sizes, columns, part, seed))
    rng.shuffle(shard)
    key = rng.integers(0, 2 ** 63, len(shard))
    return shard * parts + ((key >> 32) * parts >> 31), key


def counter(sizes: np.ndarray, columns: np.ndarray, parts: int, seed: int):
    """Rows of each block that partitions send, by their numbers."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                block, n = np.unique(draw(sizes, columns, parts, part, seed)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(n)], names=["block", "n"])
    return count


def dealer(sizes: np.ndarray, columns: np.ndarray, parts: int, seed: int):
    """The rows of a partition with block and key."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, drawn = 0, None
        for batch in batches:
            if drawn is None:
                drawn = draw(sizes, columns, parts, TaskContext.get().partitionId(), seed)
            block, key = (pa.array(x[at:at + batch.num_rows]) for x in drawn)
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), block, key], names=["row", "block", "key"])
    return deal


def partition_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = size = 0
    for batch in batches:
        rows += batch.num_rows
        size += batch.nbytes
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                      pa.array([rows], pa.int64()), pa.array([size], pa.int64())], names=["p", "n", "size"])


def shuffled_shards(df: DataFrame, shards: int, seed: int = 0, block_rows: int = BLOCK_ROWS,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``df`` with shard int and slot long; columns of these names are replaced."""
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    rows = stable(df.select(F.struct(*keep).alias("row")))
    found = rows.mapInArrow(partition_sizes, "p int, n bigint, size bigint").collect()
    counts = {r["p"]: r["n"] for r in found}
    sizes = np.array([counts.get(p, 0) for p in range(max(counts, default=-1) + 1)], np.int64)
    total = int(sizes.sum())
    size = sum(r["size"] for r in found)
    columns = shard_sizes(total, shards)
    parts = max(1, -(-total // (shards * max(1, min(block_rows, block_bytes * total // max(1, size))))))
    spark, kind = df.sparkSession, rows.schema["row"].dataType.simpleString()

    counted = spark.range(len(sizes)).mapInArrow(counter(sizes, columns, parts, seed), "block bigint, n bigint").groupBy(
        "block").agg(F.sum("n").alias("n")).withColumn("shard", (F.col("block") / parts).cast("int"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counted.select("block", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // EXCHANGE_BYTES))
    dealt = rows.mapInArrow(dealer(sizes, columns, parts, seed), f"row {kind}, block bigint, key bigint").repartition(
        tasks, "block")
    few = parts * shards <= BROADCAST_BLOCKS
    place = F.row_number().over(Window.partitionBy("block").orderBy("key"))
    return dealt.join(F.broadcast(first) if few else first.hint("merge"), "block").withColumn(
        "slot", F.col("first") + place - 1).select("row.*", "shard", "slot")


def written(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as written to the shared folder."""
    ensure_shared_dir(df.sparkSession)
    path = work_dir(df.sparkSession, "shards")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("op3_sharding")
def op3(spark, sf_dir):
    # whole documents are written to their shards; sizes and digests are those of the texts that stand there
    shards = written(shuffled_shards(table(spark, sf_dir, "documents"), 40))
    text = F.coalesce(F.col("text"), F.lit(""))
    return shards.select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), "shard", "slot",
                         F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard"))
