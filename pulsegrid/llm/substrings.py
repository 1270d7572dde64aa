"""Substring dedup: a relative Lempel-Ziv parse of each document against the documents before it.

The reference is every document with a smaller id, indexed by windows of ``window`` words (see postings):
of each window the index has a document before that holds it, and its place there. A document is parsed greedily from the
left: a factor starts at the next window that the index knows, stands at that place of the reference document, and
goes on as long as the following windows stand at the following places of the same document. So the words of a factor are
those of its reference from the given place on. Words between factors are literals; what is shorter than a window is no
factor. A window across the end of a factor may stand in another reference, so the parse goes back over the boundary:
the next factor may begin at any of the last ``window - 1`` words of the one before. All words in factors are
duplicate spans. The parse looks at the input as it was, not at what is left of it. Texts travel compressed to where their
windows meet.

Defined cases: null and empty texts have no words and keep the empty text; documents shorter than a window keep
all; a row without doc_id is kept whole and is nobody's reference; rows that repeat a doc_id are one document,
each checked by its own text, and a place in it is one in any of its rows. Ids are whole numbers. Texts are cut at ``[\x20\x09-\x0D]+`` and kept words joined by one space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, table, text_bytes
from pulsegrid.llm.postings import known_ids, range_count, repeated
from pulsegrid.llm.words import window_codes, word_hashes

WINDOW = 13


def window_features(window: int):
    """The window codes of a batch, with the document of each and its place there."""
    def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, first = word_hashes(batch.column(1))
        codes = window_codes(hashes, window)
        counts = np.maximum(np.diff(first) - window + 1, 0)
        inside = np.zeros(len(codes) + 1, np.int64)
        own = counts > 0
        np.add.at(inside, first[:-1][own], 1)
        np.add.at(inside, (first[:-1] + counts)[own], -1)
        begins = np.repeat(np.cumsum(counts) - counts, counts)
        return (np.repeat(batch.column(0).to_numpy(), counts), codes[np.cumsum(inside[:-1]) > 0],
                np.arange(len(begins)) - begins)
    return features


def factors(at: np.ndarray, reference: np.ndarray, place: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (first word, end, reference, place in it) from the windows ``at`` which the index knows."""
    if not len(at):
        return []
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (reference[1:] != reference[:-1]) | (place[1:] != place[:-1] + 1)
    starts = np.flatnonzero(new)
    last = np.append(starts[1:], len(at)) - 1
    return list(zip(at[starts].tolist(), (at[last] + window).tolist(), reference[starts].tolist(), place[starts].tolist(),
                    strict=True))


def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) with each text compressed."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [None if t is None else packer.compress(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "text"])


def parser(window: int, schema: pa.Schema):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                texts = [None if t is None else unpacker.decompress(t) for t in batch.column(1).to_pylist()]
                hashes, first = word_hashes(pa.array(texts, pa.binary()))
                codes = window_codes(hashes, window)
                counts, removed, spans, kept = [], [], [], []
                for k, known in enumerate(batch.column(2)):
                    words = (texts[k] or b"").split()
                    found = []
                    if known.is_valid and len(words) >= window:
                        index, references, places = (known.values.field(k).to_numpy() for k in range(3))
                        index = index.view(np.uint64)
                        order = np.argsort(index)
                        own = codes[first[k]:first[k + 1] - window + 1]
                        place = np.searchsorted(index, own, sorter=order)
                        place[place == len(index)] = 0
                        at = np.flatnonzero(index[order[place]] == own)
                        there = order[place[at]]
                        found = factors(at, references[there], places[there], window)
                    drop = np.zeros(len(words), bool)
                    for a, b, *_ in found:
                        drop[a:b] = True
                    counts.append(len(words))
                    removed.append(int(drop.sum()))
                    spans.append([dict(zip(("start", "stop", "reference", "place"), f, strict=True)) for f in found])
                    kept.append(b" ".join(w for w, x in zip(words, drop.tolist(), strict=True) if not x)
                                if found else b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, schema.field("spans").type),
                     pa.array(kept, pa.binary()).cast(pa.string())], schema=schema)
    return parse


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept), one row for each row of ``docs``.

    ``spans`` are the factors in words, each with the reference document and its place in it; ``kept`` the text that is left.
    """
    found = repeated(known_ids(docs, doc_id, text), window_features(window), range_count(text_bytes(docs, text)), True)
    # one document's windows: as long as its text
    index = found.groupBy("doc_id").agg(F.collect_list(F.struct("code", "first", "place")).alias("known"))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    rows = rows.mapInArrow(compressed, "doc_id bigint, text binary")
    span = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "stop", "reference", "place")]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", span), ("kept", pa.string())])
    return rows.join(index, "doc_id", "left").select("doc_id", "text", "known").mapInArrow(
        parser(window, schema), "doc_id bigint, n_words bigint, n_removed bigint, "
        "spans array<struct<start:bigint,stop:bigint,reference:bigint,place:bigint>>, kept string")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (
        SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT s, min(doc_id) AS least FROM n GROUP BY s HAVING min(doc_id) < max(doc_id)),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM n JOIN f USING (s) WHERE doc_id > least),
w AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM w ANTI JOIN x USING (doc_id, i) GROUP BY doc_id),
r AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query("op5_substring_dedup", SQL)
def op5(spark, sf_dir):
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
