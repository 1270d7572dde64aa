"""What several operators share: stable intermediate tables, and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.session import ensure_shared_dir, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over the given tables; ``sql`` where DuckDB can say the same."""
    def add(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            short_batches(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


def short_batches(spark: SparkSession) -> None:
    """Arrow batches of 500 rows: texts are long, and both a task and its Python worker hold batches whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_and(df: DataFrame, column: str, made: str) -> T.StructType:
    """The schema of a column of ``df``, whatever the names inside, and of what is ``made`` beside it."""
    return T.StructType([df.schema[column], *T.StructType.fromDDL(made).fields])


def whole_row(columns: list[str]) -> Column:
    """Columns as one struct."""
    return F.struct(*(F.col(f"`{c}`") for c in columns))


def stable(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written to the shared checkpoint folder and read back.

    Later jobs see the same rows in the same partitions, whatever happens to executors.
    """
    ensure_shared_dir(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``stable`` table that nothing reads any more."""
    plan = df._jdf.queryExecution().logical()
    kept = plan.rdd().getCheckpointFile()
    if kept.isDefined():
        context = df.sparkSession._jsc
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(kept.get())
        path.getFileSystem(context.hadoopConfiguration()).delete(path, True)


#: rows of one long that may be broadcast: some 24 bytes each in an executor's hash table, 100 MB in all
BROADCAST_ROWS = 4_000_000


def without(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not among ``ids`` (key, a long); rows without a key stay.

    The ids are counted: up to ``BROADCAST_ROWS`` of them go to where the rows are, more meet them in a shuffle.
    """
    ids = stable(ids.select(F.col(key).alias("_gone")).distinct())
    small = ids.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if small else ids.hint("merge"), df[key] == F.col("_gone"), "left_anti")


SALTS = 32


def spread_join(many: DataFrame, one: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Join ``many`` with ``one`` (few rows for each key) where a key may hold a third of all rows of ``many``.

    A key's rows are dealt to ``SALTS`` parts by the columns ``by``, and ``one`` is repeated for the parts there are.
    ``many`` is read twice: it should be a stable table.
    """
    dealt = many.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)))
    parts = dealt.select(key, "_salt").distinct().join(one, key)
    return dealt.join(parts, [key, "_salt"]).drop("_salt")


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of a text column, to size the parts that later steps work in."""
    return df.agg(F.sum(F.octet_length(F.col(text))).alias("n")).first()["n"] or 0
