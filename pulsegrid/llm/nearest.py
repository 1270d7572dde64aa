"""Nearest neighbours by cosine: a block matrix join of int8 tiles with error bounds.

Queries and candidates are dealt into stripes, and every stripe of queries meets every stripe of candidates in one
cogroup: a cell of the product matrix. Within a cell:

1. Vectors are scaled to length 1 and rounded to int8 with a step of their own. Tiles of int8 products are taken by
   matrix multiplication (in float32, which holds these whole numbers exactly) and give each cosine up to a bound:
   the lengths of the two rounding errors bound what rounding can change.
2. A pair whose cosine may still reach the query's k-th best so far survives and is computed again in double precision
   from the vectors themselves. The best k of each query go on to the next tile.
3. What a task has found in its cells is merged by heaps, and so are the findings of the tasks.

The result is exact: bounds only spare work. A stripe has ``STRIPE_BYTES`` at most, so a cell fits in a task whatever
the input; a cell sends on k rows for each query. Rows cross the network once for every stripe of the other side.

Defined cases: vectors that are null, empty or zero, or hold null, NaN or infinity, take no part, nor do rows without an
id. Vectors are compared with those of their own length. Rows that repeat an id are one item that may have several
vectors: its nearest pair counts, and it is never its own neighbour. Equal cosines go to the smaller id. With fewer
candidates than k all are returned; a query without any has no rows, and an empty table gives none. Ids are whole
numbers; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, table

STRIPE_BYTES = 16_000_000  # vectors of a stripe, as doubles
LEAST_STRIPE = 2_048       # rows: no smaller stripes for the sake of more tasks
TILE = (1_024, 2_048)      # queries and candidates multiplied at a time
PAIRS = 4_000_000          # numbers computed again at a time
EXACT = 1_024              # dimensions whose int8 products float32 adds up exactly

BEST = "query_id bigint, vec_id bigint, score double"
BEST_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

#: (ids of queries, ids of candidates, scores)
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row divided by a power of two, which changes no cosine, so that no square leaves the range of doubles."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -power[:, None])


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def rounded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows of unit vectors, their steps, the lengths of their errors and of what they stand for."""
    unit = vectors / lengths(vectors)[:, None]
    step = np.abs(unit).max(axis=1) / 127
    near = np.rint(unit / step[:, None])
    error = lengths(unit - near * step[:, None])
    return near.astype(np.int8), step, error, lengths(near) * step


def tile_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows, exactly."""
    out = None
    for at in range(0, a.shape[1], EXACT):
        part = a[:, at:at + EXACT].astype(np.float32) @ b[:, at:at + EXACT].astype(np.float32).T
        out = part.astype(float) if out is None else out + part
    return out


def cosines(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The cosines of rows i of ``a`` and j of ``b``; equal vectors give equal values."""
    out, size = np.empty(len(i)), max(1, PAIRS // a.shape[1])
    la, lb = lengths(a), lengths(b)
    for at in range(0, len(i), size):
        x, y = i[at:at + size], j[at:at + size]
        out[at:at + size] = (a[x] * b[y]).sum(axis=1) / (la[x] * lb[y])
    return out


def best_of(found: Found, k: int) -> Found:
    """The best k of each query, each candidate once."""
    q, c, s = found
    order = np.lexsort((-s, c, q))
    q, c, s = q[order], c[order], s[order]
    once = np.ones(len(q), bool)
    once[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
    q, c, s = q[once], c[once], s[once]
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    first = np.searchsorted(q, q)
    top = np.arange(len(q)) - first < k
    return q[top], c[top], s[top]


def cell(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> Found:
    """The best k candidates of a cell for each of its queries."""
    queries, rows = scaled(queries), scaled(rows)
    codes, steps, errors, kept = rounded(rows)
    out: list[Found] = []
    for at in range(0, len(queries), TILE[0]):
        ids, block = query_ids[at:at + TILE[0]], queries[at:at + TILE[0]]
        named, place = np.unique(ids, return_inverse=True)
        own, step, error, _ = rounded(block)
        least = np.full(len(named), -np.inf)  # the k-th best cosine of each query so far
        best: Found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for b in range(0, len(rows), TILE[1]):
            span = slice(b, b + TILE[1])
            near = tile_products(own, codes[span]) * step[:, None] * steps[span]
            # |q.c - q'.c'| <= |q| |c - c'| + |q - q'| |c'|; the last term is for what rounding the sums may change
            near += errors[span] + error[:, None] * kept[span] + 1e-12 * (1 + rows.shape[1])
            i, j = np.nonzero((near >= least[place][:, None]) & (ids[:, None] != row_ids[span]))
            if not len(i):
                continue
            if len(i) > 4 * k * len(block):
                # many pairs, as in the first tile: cosines of the k most promising ones of each query raise the bar
                top = np.argpartition(-near, min(k, near.shape[1]) - 1, axis=1)[:, :k]
                x = np.repeat(np.arange(len(block)), top.shape[1])
                y = top.reshape(-1)
                other = ids[x] != row_ids[span][y]
                x, y = x[other], y[other]
                best = best_of(joined(best, (ids[x], row_ids[span][y], cosines(block, rows[span], x, y))), k)
                least = kth(best, named, k)
                i, j = np.nonzero((near >= least[place][:, None]) & (ids[:, None] != row_ids[span]))
            for p in range(0, len(i), PAIRS):
                x, y = i[p:p + PAIRS], j[p:p + PAIRS]
                best = best_of(joined(best, (ids[x], row_ids[span][y], cosines(block, rows[span], x, y))), k)
            least = kth(best, named, k)
        out.append(best)
    return best_of(tuple(np.concatenate(x) for x in zip(*out, strict=True)), k)


def joined(a: Found, b: Found) -> Found:
    return tuple(np.concatenate(x) for x in zip(a, b, strict=True))


def kth(best: Found, named: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each of the sorted ``named`` queries, -inf where there are fewer."""
    q, _, s = best
    start, end = np.searchsorted(q, named), np.searchsorted(q, named, side="right")
    out = np.full(len(named), -np.inf)
    full = end - start >= k
    out[full] = s[start[full] + k - 1]
    return out


class Heaps:
    """The best k candidates of each query, each candidate once."""

    def __init__(self, k: int):
        self.k, self.heaps = k, {}

    def add(self, batch: pa.RecordBatch) -> None:
        for q, c, s in zip(*(batch.column(n).to_pylist() for n in ("query_id", "vec_id", "score")), strict=True):
            heap = self.heaps.setdefault(q, [])
            again = next((x for x in heap if x[1] == -c), None)
            if again is not None:
                if s > again[0]:
                    heap.remove(again)
                    heap.sort()
                    heappush(heap, (s, -c))
            elif len(heap) < self.k:
                heappush(heap, (s, -c))
            else:
                heappushpop(heap, (s, -c))

    def rows(self) -> Iterator[tuple[int, int, int, float]]:
        for q, heap in self.heaps.items():
            for rank, (s, c) in enumerate(sorted(heap, reverse=True), 1):
                yield q, rank, -c, s


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~odd & F.exists("v", lambda c: c != 0))


def stripes(rows: int, bytes_: int, cores: int) -> int:
    """How many stripes: none above ``STRIPE_BYTES``, and as many as there are cores if they are not too short."""
    return max(1, -(-bytes_ // STRIPE_BYTES), min(cores, rows // LEAST_STRIPE))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 5, vec_id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest ``candidates`` of each of ``queries``, by cosine."""
    left, right = usable(queries, vec_id, vector), usable(candidates, vec_id, vector)
    cores = queries.sparkSession.sparkContext.defaultParallelism
    size = [F.count("*").alias("n"), F.coalesce(F.sum(F.size("v") * 8), F.lit(0)).alias("size")]
    many, wide = (df.agg(*size).first() for df in (left, right))
    down, across = stripes(many["n"], many["size"], 1), stripes(wide["n"], wide["size"], cores)

    def dealt(df: DataFrame, own: int, other: int, mine: str, theirs: str) -> DataFrame:
        """Rows with the stripe they belong to, once for every stripe of the other side."""
        return df.select(F.size("v").alias("d"), F.pmod(F.monotonically_increasing_id(), F.lit(own)).cast("int").alias(mine),
                         F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(theirs), "id", "v")

    def meet(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return BEST_SCHEMA.empty_table()
        found = cell(matrix(queries["v"]), queries["id"].to_numpy(), matrix(rows["v"]), rows["id"].to_numpy(), k)
        return pa.table([pa.array(x) for x in found], schema=BEST_SCHEMA)

    def within_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(k)
        for batch in batches:
            heaps.add(batch)
        rows = list(heaps.rows())
        for at in range(0, len(rows), 10_000):
            part = rows[at:at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int64()),
                                              pa.array([r[3] for r in part], pa.float64())], schema=BEST_SCHEMA)

    def merged(group: pa.Table) -> pa.Table:
        heaps = Heaps(k)
        for batch in group.to_batches():
            heaps.add(batch)
        q, rank, c, s = zip(*heaps.rows(), strict=True)
        return pa.table({"query_id": pa.array(q, pa.int64()), "rank": pa.array(rank, pa.int32()),
                         "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.float64())})

    keys = ["d", "r", "c"]
    cells = (dealt(left, down, across, "r", "c").groupBy(*keys)
             .cogroup(dealt(right, across, down, "c", "r").groupBy(*keys)).applyInArrow(meet, BEST))
    return (cells.mapInArrow(within_task, BEST).groupBy("query_id")
            .applyInArrow(merged, "query_id bigint, rank int, vec_id bigint, score double"))


@query("op13_nearest_neighbours", """
    WITH kept AS (
        SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
        FROM kept q JOIN kept c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pairs)
    SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
""")
def op13(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors.where("vec_id % 50 = 0"), vectors)
