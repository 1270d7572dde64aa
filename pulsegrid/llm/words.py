"""Words of whole Arrow columns as 64-bit hashes, without a Python object for each word.

A word's hash is a polynomial in its bytes, taken as the difference of two running sums; a window's
code mixes the hashes of its words in order. Two different windows share a code with a chance of
about 2**-64, which every caller that names a result "exact" accepts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x5851F42D4C957F2D
PIECE = 1 << 20  # bytes hashed at a time: bounds the memory of the running sums

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32
SAME = np.arange(256, dtype=np.uint8)

#: words of ``[^\x20\x09-\x0D]+``
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64, at least ``n`` of them."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, PIECE + 1), base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[base] = known
    return known


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def piece_ends(inside: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut the bytes into pieces that end where no word does: at a gap, or between two rows."""
    start, n = 0, len(inside)
    while start < n:
        stop, size = n, PIECE
        while start + size < n:
            gap = np.flatnonzero(~inside[start:start + size])
            last_gap = start + int(gap[-1]) + 1 if len(gap) else start
            k = int(np.searchsorted(rows, start + size, side="right")) - 1
            last_row = int(rows[k]) if k >= 0 else start
            stop = max(last_gap, last_row)
            if stop > start:
                break
            stop, size = n, size * 2  # one word longer than a piece
        yield start, stop
        start = stop


def word_hashes(column: pa.Array, word: np.ndarray = SPACED, fold: np.ndarray = SAME
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column of texts; and where each row's words begin (one more at the end).

    ``word`` says which bytes belong to words, ``fold`` maps bytes before. Null has no words.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    chars = fold[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]]
    rows = ends - ends[0]
    inside = word[chars]
    inverse = pow(BASE, -1, 1 << 64)
    hashes, places = [], []
    for start, stop in piece_ends(inside, rows):
        here = inside[start:stop]
        begins = here.copy()
        begins[1:] &= ~here[:-1]
        k = rows[np.searchsorted(rows, start):np.searchsorted(rows, stop)] - start
        begins[k] = here[k]
        s = np.flatnonzero(begins)
        if not len(s):
            continue
        last = here.copy()
        last[:-1] &= ~here[1:]
        k = k[k > 0] - 1
        last[k] = here[k]
        e = np.flatnonzero(last) + 1
        sums = np.zeros(stop - start + 1, np.uint64)
        np.cumsum((chars[start:stop].astype(np.uint64) + np.uint64(1)) * powers(BASE, stop - start)[:stop - start],
                  out=sums[1:])
        hashes.append(mixed((sums[e] - sums[s]) * powers(inverse, stop - start)[s]))
        places.append(s + start)
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), rows)


def window_codes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The code of every run of ``size`` words, across row ends too: the caller cuts them."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    code = np.full(n, size, np.uint64)
    for k in range(size):
        code *= np.uint64(0xD6E8FEB86659FD93)
        code += hashes[k:k + n]
    return mixed(code)
