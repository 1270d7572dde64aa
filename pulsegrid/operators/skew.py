"""Help against hot keys: a third of all rows may share one key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16


def salted_join(many: DataFrame, one: DataFrame, on: list[str], spread: list[Column | str],
                how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join a side that may have hot keys to a side with few rows per key.

    Rows of ``many`` are dealt to ``salts`` parts of their key by the columns in ``spread``;
    ``one`` is repeated per part. Nothing is forced to broadcast: Spark does that by itself
    where it has seen that ``one`` is small.
    """
    left = many.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*spread), F.lit(salts)), F.lit(0)))
    right = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def join_series(left: DataFrame, right: DataFrame, keys: list[str], on: list[str],
                how: str = "inner") -> DataFrame:
    """Join on the keys of a series, where a missing key equals a missing key, and on ``on``.

    Keys that cannot be null join plainly, which keeps the partitioning that both sides have.
    """
    safe = [k for k in keys if left.schema[k].nullable]
    if not safe:
        return left.join(right, [*keys, *on], how)
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in [*keys, *on]})
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) if c in safe else F.col(c) == F.col(f"_r_{c}")
            for c in [*keys, *on]]
    return left.join(right, reduce(and_, same), how).drop(*[f"_r_{c}" for c in [*keys, *on]])


def with_next(points: DataFrame, keys: list[str], index: str, columns: list[str],
              chunk: int = 65536) -> DataFrame:
    """Add to each point the index and columns of the next point of its key (``next_<column>``).

    ``index`` is a whole number, once per key. A key is cut into chunks of the index, each
    ordered by itself; the first point of every chunk then closes the chunk before it. So no
    task ever holds more than ``chunk`` points of a key, plus one row for each of its chunks.
    """
    taken = [index, *columns]
    point = F.struct(*taken)
    points = points.withColumn("_chunk", F.floor(F.col(index) / chunk))
    heads = points.groupBy(*keys, "_chunk").agg(F.min(point).alias("_head"))
    heads = heads.select(*keys, "_chunk", F.lead("_head").over(
        Window.partitionBy(*keys).orderBy("_chunk")).alias("_after"))
    inside = points.withColumn("_next", F.lead(point).over(
        Window.partitionBy(*keys, "_chunk").orderBy(index)))
    joined = join_series(inside, heads, keys, ["_chunk"], "left")
    following = F.coalesce("_next", "_after")
    return joined.select(*points.columns[:-1],
                         *[following[c].alias(f"next_{c}") for c in taken])


def explode_in_chunks(rows: DataFrame, keys: list[str], low: str, high: str, name: str,
                      chunk: int = 65536) -> DataFrame:
    """One row for each whole number from ``low`` to ``high``, as ``name``.

    A range is cut at multiples of ``chunk`` first, and the pieces are dealt to tasks by key and chunk: a key
    with long ranges is spread, and no array is longer than a chunk. ``_chunk`` is the piece's number.
    """
    pieces = rows.withColumn("_chunk", F.explode(F.sequence(
        F.floor(F.col(low) / chunk), F.floor(F.col(high) / chunk)))).repartition(*keys, "_chunk")
    return pieces.withColumn(name, F.explode(F.sequence(
        F.greatest(F.col(low), F.col("_chunk") * chunk), F.least(F.col(high), F.col("_chunk") * chunk + chunk - 1))))
