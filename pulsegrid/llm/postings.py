"""Find the codes that more than one document holds, over a whole table, in one shuffle.

Each task sorts the codes of a chunk of documents and keeps one entry per code and chunk, so that a
code which a third of all documents hold reaches its group once per chunk. Entries go to ranges of
the code space as packed arrays (differences of sorted codes, byte by byte), which is a third of the
size of rows. What a chunk settles itself meets nothing: it goes on in pieces of bounded size, each a group of its
own. A range holds one entry per code and chunk, and the number of ranges follows the bytes of the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 500_000         # codes sorted together in a task
RANGE_BYTES = 4_000_000  # bytes of text for each range of codes
LEAST_RANGES = 64
PIECE = 50_000          # settled rows that go on together

ENTRIES = "part int, piece bigint, n int, codes binary, docs binary, settled binary, places binary"
FOUND = "doc_id bigint, code bigint, first bigint, place bigint"

#: features of a batch: (doc ids, codes, places in the document); places are not read unless ``earlier``
Features = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers, as planes of their low bytes; planes of zeros at the top are left out.

    The planes are compressed by their bytes' frequencies, which makes the upper ones short.
    """
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, n: int) -> np.ndarray:
    width = data[0]
    wide = np.zeros((n, 8), np.uint8)
    planes = zstandard.ZstdDecompressor().decompress(data[1:])
    wide[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return wide.reshape(-1).view("<u8").astype(np.uint64, copy=False)


def pack_sorted(codes: np.ndarray) -> bytes:
    return pack(np.diff(codes, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n), dtype=np.uint64)


def pack_ids(ids: np.ndarray) -> bytes:
    """Signed ids: the least, then what each is above it."""
    least = int(ids.min()) if len(ids) else 0
    return least.to_bytes(8, "little", signed=True) + pack((ids - least).astype(np.uint64))


def unpack_ids(data: bytes, n: int) -> np.ndarray:
    return unpack(data[8:], n).astype(np.int64) + int.from_bytes(data[:8], "little", signed=True)


def runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal sorted codes begins, and which run each place is in."""
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def range_count(total_bytes: int) -> int:
    return max(LEAST_RANGES, -(-total_bytes // RANGE_BYTES))


def cut(codes: np.ndarray, ranges: int) -> Iterator[tuple[int, int, int]]:
    """Where sorted codes enter and leave each range of the code space."""
    bounds = np.array([(r << 64) // ranges for r in range(1, ranges)], dtype=np.uint64)
    at = [0, *np.searchsorted(codes, bounds).tolist(), len(codes)]
    for r in range(ranges):
        if at[r] < at[r + 1]:
            yield r, at[r], at[r + 1]


def least_first(codes: np.ndarray, docs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents and places beside sorted codes, so ordered that each run begins with its least document's least place."""
    first, group = runs(codes)
    held = np.flatnonzero((np.bincount(group) > 1)[group])  # most codes stand alone
    order = held[np.lexsort((places[held], docs[held], codes[held]))]
    docs, places = docs.copy(), places.copy()
    docs[held], places[held] = docs[order], places[order]
    return docs, places


def chunk_entries(docs: np.ndarray, codes: np.ndarray, ranges: int, earlier: bool,
                  pieces: Iterator[int], places: np.ndarray | None = None) -> dict[str, list]:
    """Entries of one chunk: one for each code, with its least document, and what the chunk settles itself.

    The settled ones have the part ``ranges`` and a number of ``pieces``; the others have the piece 0.

    A code held twice in the chunk is settled here: for all its documents, or with ``earlier`` for those
    after the first, which goes on as the chunk's entry for the code, with its place there.
    """
    order = np.argsort(codes)
    docs, codes = docs[order], codes[order]
    if earlier:
        docs, places = least_first(codes, docs, np.zeros_like(docs) if places is None else places[order])
    first, group = runs(codes)
    least = docs[first] if earlier else np.minimum.reduceat(docs, first)
    several = np.maximum.reduceat(docs, first) > least
    out = {name: [] for name in ("part", "piece", "n", "codes", "docs", "settled", "places")}

    def add(part, piece, codes, docs, settled, places):
        values = part, piece, len(codes), pack_sorted(codes), pack_ids(docs), settled, places
        for name, value in zip(out, values, strict=True):
            out[name].append(value)

    entry = codes[first]
    spots = places[first].astype(np.uint64) if earlier else None
    for r, a, b in cut(entry, ranges):
        add(r, 0, entry[a:b], least[a:b], np.packbits(several[a:b]).tobytes(), pack(spots[a:b]) if earlier else b"")
    known = docs > least[group] if earlier else several[group]
    known_codes, known_docs = codes[known], docs[known]
    for a in range(0, len(known_codes), PIECE):
        at = slice(a, a + PIECE)
        firsts, theirs = (pack_ids(least[group][known][at]), pack(spots[group][known][at])) if earlier else (b"", b"")
        add(ranges, next(pieces), known_codes[at], known_docs[at], firsts, theirs)
    return out


def repeated(docs: DataFrame, features: Features, ranges: int, earlier: bool) -> DataFrame:
    """(doc_id, code, first, place) of codes that several documents hold.

    With ``earlier``, only of documents after the first that holds the code; ``first`` is this one, or of documents
    that met in a task the least there, and ``place`` where the code stands in it. Without, of all documents that
    hold it, and ``first`` and ``place`` say nothing.
    """
    names = [f.split()[0] for f in ENTRIES.split(", ")]
    entry_schema = pa.schema([("part", pa.int32()), ("piece", pa.int64()), ("n", pa.int32()), ("codes", pa.binary()),
                              ("docs", pa.binary()), ("settled", pa.binary()), ("places", pa.binary())])
    found_schema = pa.schema([("doc_id", pa.int64()), ("code", pa.int64()), ("first", pa.int64()), ("place", pa.int64())])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        pieces = count((TaskContext.get().partitionId() << 32) + 1)

        def flush():
            ids, codes, *places = (np.concatenate(x) for x in zip(*held, strict=True))
            made = chunk_entries(ids, codes, ranges, earlier, pieces, *places)
            return pa.RecordBatch.from_pydict({name: made[name] for name in names}, schema=entry_schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                found = features(batch.slice(at, 500))
                if len(found[1]):
                    held.append(found)
                    size += len(found[1])
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def meet(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        code = np.concatenate([unpack_sorted(r["codes"], r["n"]) for r in rows])
        doc = np.concatenate([unpack_ids(r["docs"], r["n"]) for r in rows])
        place = (np.concatenate([unpack(r["places"], r["n"]) for r in rows]).astype(np.int64) if earlier
                 else np.zeros(len(doc), np.int64))
        if rows[0]["part"] >= ranges:  # a piece of what a chunk has settled
            first = np.concatenate([unpack_ids(r["settled"], r["n"]) for r in rows]) if earlier else doc
        else:
            order = np.argsort(code)
            code, doc, place = code[order], doc[order], place[order]
            if earlier:
                doc, place = least_first(code, doc, place)
            starts, at = runs(code)
            if earlier:
                first, place = doc[starts][at], place[starts][at]
                keep = doc > first
            else:
                settled = np.concatenate([np.unpackbits(np.frombuffer(r["settled"], np.uint8), count=r["n"])
                                          for r in rows]).astype(bool)[order]
                first, keep = doc, (np.bincount(at)[at] > 1) & ~settled
            code, doc, first, place = code[keep], doc[keep], first[keep], place[keep]
        return pa.table([pa.array(doc), pa.array(code.view(np.int64)), pa.array(first), pa.array(place)], schema=found_schema)

    return docs.mapInArrow(entries, ENTRIES).groupBy("part", "piece").applyInArrow(meet, FOUND)


def refuse_other_ids(docs: DataFrame, doc_id: str) -> None:
    """Ids are whole numbers here; a table with others is refused before any work is done."""
    kind = docs.select(doc_id).schema[0].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{doc_id} must hold whole numbers, not {kind.simpleString()}")


def known_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that can take part: those with an id and a text."""
    refuse_other_ids(docs, doc_id)
    return docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
