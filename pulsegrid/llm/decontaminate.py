"""Benchmark decontamination: Wu-Manber search for many word windows at once.

The alphabet is words. For patterns of one length m, a table of blocks of two words says how far the search may
move on: a block of no pattern lets it skip m - 1 words. At a shift of zero the block, as the end of some
pattern, selects a bucket of patterns, which are compared word by word. Patterns of each length have tables of
their own (windows of the benchmark have one length; only items shorter than a window add others).

Test items are a stated query set. They are taken in blocks of at most ``BLOCK_BYTES`` of text, each sent to all
tasks and searched for in all documents in turn, so what is sent has a bound whatever their number.

Defined cases: null and empty texts have no words and no hits; an item without words has no window; an item
without an id can be hit but is not listed; items that repeat an id are listed once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, table, text_bytes, whole_row

WINDOW = 13
BLOCK_BYTES = 16_000_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8: what [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ takes


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class ShiftTable:
    """Wu-Manber tables of patterns that are ``m`` words long."""

    def __init__(self, m: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.m, self.block = m, min(2, m)
        self.far = m - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[str]]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, m + 1):
                block = pattern[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.far), m - end)
            self.bucket.setdefault(pattern[m - self.block:], []).append((pattern, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Where a pattern starts, and the items that have it."""
        m, block, far, shift = self.m, self.block, self.far, self.shift
        end, n = m, len(words)
        while end <= n:
            last = tuple(words[end - block:end])
            move = shift.get(last, far)
            if move:
                end += move
                continue
            start = end - m
            for pattern, items in self.bucket[last]:
                if words[start] == pattern[0] and tuple(words[start:end]) == pattern:
                    yield start, items
            end += 1


def tables(items: Iterable[tuple[object, str | None]], window: int) -> list[ShiftTable]:
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item, text in items:
        words = words_of(text.encode() if text else None)
        m = min(window, len(words))
        for start in range(len(words) - m + 1) if m else ():
            known = by_length.setdefault(m, {}).setdefault(tuple(words[start:start + m]), [])
            if item is not None and str(item) not in known:
                known.append(str(item))
    return [ShiftTable(m, patterns) for m, patterns in sorted(by_length.items())]


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all), with n_words, n_hit, item_ids and contaminated.

    A word inside any occurrence of a window of an item is hit. A document is contaminated if it has a hit and
    at least one word in twenty is hit. Columns of these names are replaced.
    """
    made = ["n_words", "n_hit", "item_ids", "contaminated"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    rows = docs.select(F.col(text).cast("binary").alias("text"), whole_row(keep).alias("row"),
                       F.lit(0).cast("bigint").alias("words"),
                       F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)").alias("spans"),
                       F.expr("cast(array() as array<string>)").alias("items"))
    blocks = max(1, -(-text_bytes(items, item_text) // BLOCK_BYTES))
    asked = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).withColumn(
        "block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    for block in range(blocks):
        found = [(r["i"], r["t"]) for r in asked.where(F.col("block") == block).collect()]
        rows = rows.mapInArrow(searcher(found, window), rows.schema)
    spans = F.array_sort("spans")
    # merged from the left: what each span adds beyond all before it
    n_hit = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], acc["reach"]))).alias("n"),
            F.greatest(acc["reach"], s["stop"]).alias("reach")), lambda acc: acc["n"])
    return (rows.withColumn("n_hit", n_hit)
            .select("row.*", F.col("words").alias("n_words"), "n_hit",
                    F.array_sort(F.array_distinct("items")).alias("item_ids"),
                    ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("words"))).alias("contaminated")))


def searcher(items: list[tuple[str | None, str | None]], window: int):
    """A task's search for one block of items; what it finds is added to spans and items."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables(items, window)
        for batch in batches:
            counts, spans, hits = [], batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for k, text in enumerate(batch.column(0)):
                words = words_of(text.as_py())
                counts.append(len(words))
                for shifts in known:
                    for start, ids in shifts.search(words):
                        stop = start + shifts.m
                        if spans[k] and start <= spans[k][-1]["stop"] <= stop:
                            spans[k][-1] = {"start": min(start, spans[k][-1]["start"]), "stop": stop}
                        else:
                            spans[k].append({"start": start, "stop": stop})
                        hits[k].extend(x for x in ids if x not in hits[k])
            schema = batch.schema
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(counts, pa.int64()), pa.array(spans, schema.field(3).type),
                 pa.array(hits, schema.field(4).type)], schema=schema)
    return search


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM (
        SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (
          SELECT item_id, w, least(13, len(w)) AS m FROM b WHERE len(w) > 0))),
o AS (SELECT DISTINCT doc_id, i, m, item_id FROM (
        SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s FROM (
          SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
          FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)) JOIN p USING (m, s)),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + m)) AS x FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
        SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op8_benchmark_decontamination", SQL)
def op8(spark, sf_dir):
    found = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")
