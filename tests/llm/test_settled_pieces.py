"""What a chunk settles by itself never meets the same code of other chunks in one group."""

from itertools import count

import numpy as np
import pytest

from pulsegrid.llm import postings


@pytest.mark.parametrize("earlier", [True, False])
def test_a_hot_code_is_settled_in_bounded_groups(monkeypatch, earlier):
    monkeypatch.setattr(postings, "PIECE", 40)
    groups, rows = {}, {}
    for chunk in range(30):
        docs = np.arange(100, dtype=np.int64) + 100 * chunk
        codes = np.where(np.arange(100) % 3 == 0, 7, docs + 1_000).astype(np.uint64)  # a third hold code 7
        made = postings.chunk_entries(docs, codes, 4, earlier, count((chunk << 32) + 1))
        for part, piece, n, packed, ids in zip(made["part"], made["piece"], made["n"], made["codes"], made["docs"], strict=True):
            if part >= 4:
                groups[part, piece] = groups.get((part, piece), 0) + n
                assert set(postings.unpack_sorted(packed, n).tolist()) == {7}
                rows.setdefault(chunk, []).extend(postings.unpack_ids(ids, n).tolist())
    assert max(groups.values()) <= 40
    assert all(sorted(rows[c]) == [100 * c + k for k in range(3 * earlier, 100, 3)] for c in range(30))


@pytest.mark.parametrize("earlier", [True, False])
def test_repeated_codes_over_many_chunks(spark, monkeypatch, earlier):
    # the tasks get these functions by value, so they see small chunks and pieces
    monkeypatch.setattr(postings, "CHUNK", 50)
    monkeypatch.setattr(postings, "PIECE", 7)

    def features(batch):
        ids = batch.column(0).to_numpy()
        return np.repeat(ids, 2), np.stack([np.where(ids % 3 == 0, 7, ids + 1_000), ids // 5 + 50_000], 1).reshape(-1).astype(np.uint64)

    docs = spark.range(600).selectExpr("id as doc_id", "'x' as text").repartition(4)
    got = postings.repeated(docs, features, 4, earlier).collect()
    held = {}
    for k in range(600):
        for code in ({7} if k % 3 == 0 else set()) | {k // 5 + 50_000}:
            held.setdefault(code, []).append(k)
    want = sorted((k, code) for code, ids in held.items() for k in (ids[1:] if earlier else ids))
    assert sorted((r.doc_id, r.code) for r in got) == want
    assert not earlier or all(r.first < r.doc_id and r.first in held[r.code] for r in got)
