"""Jaccard join, substring dedup, decontamination and sharding against plain versions."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pulsegrid.llm import decontaminate, jaccard_join, shuffle_shards, substrings
from pulsegrid.llm.components import components
from pulsegrid.llm.postings import pack, pack_ids, pack_sorted, unpack, unpack_ids, unpack_sorted
from pulsegrid.llm.words import FOLD, SPACED, window_codes, word_hashes

SPACES = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def prose(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, vocabulary, n)]


def near_copy(words: list[str], seed: int, edits: int) -> list[str]:
    rng, out = np.random.default_rng(seed), list(words)
    for at in rng.integers(0, len(out), edits):
        out[at] = f"e{seed}x{at}"
    return out


@pytest.fixture(scope="module")
def documents(spark):
    """Copies, near copies in a large group, chains, a common line, odd texts, and columns with clashing names."""
    base, common = prose(1, 120), prose(2, 15)
    texts: list[str | None] = [" ".join(near_copy(base, k, k % 5)) for k in range(80)]
    texts += [" ".join(base)] * 6 + [" ".join(prose(3, 40)).upper(), " ".join(prose(3, 40))]
    texts += [" ".join(prose(10 + k, 30) + common + prose(50 + k, 25)) for k in range(25)]
    texts += [None, "", " \t\n", "a", "a b c", "a  b\nc", "é ü ß x y z", "x" * 300, "same " * 400, "same " * 400]
    texts.append(" ".join(prose(5, 30)) + " " + " ".join(prose(6, 5000)))
    rows = [(k * 3 % 1009, t, "src", 1, "code", 0) for k, t in enumerate(texts)]
    rows.append(rows[4])  # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n int, codes string, sig int")


def brute_components(rows, size, percent):
    sets = {}
    for doc, text in rows:
        w = SPACES.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (3, 60)])
def test_jaccard_join_is_whole(spark, documents, size, percent):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = [(r.doc_id, (r.n_shingles, r.component_id))
           for r in jaccard_join.near_duplicates(documents, size, percent).collect()]
    want = brute_components(rows, size, percent)
    assert Counter(d for d, _ in got) == Counter(d for d, _ in rows)
    assert {x for x in got if want[x[0]] != x[1]} == set()
    assert len({c for _, (_, c) in got}) < len(want) - 40


def test_jaccard_join_of_nothing(spark, documents):
    assert jaccard_join.near_duplicates(documents.where("false")).collect() == []
    odd = spark.createDataFrame([(None, "a b c d e"), (1, None), (2, "a b c d e")], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(odd).collect()}
    assert got == {(None, 1, None), (1, 0, 1), (2, 1, 2)}


def test_components(spark):
    chain = [(k, k + 1) for k in range(10, 60)] + [(5, 100), (100, 7), (3, 3)]
    links = spark.createDataFrame([*chain, (None, 4)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {k: 10 for k in range(10, 61)} | {5: 5, 100: 5, 7: 5}
    early = [(r.node, r.root) for r in components(links, rounds=1).collect()]
    assert len(early) == len(got) == len(dict(early)) and all(got[a] == got[b] for a, b in early)
    assert components(links.where("false")).collect() == []


def brute_repeats(rows, window):
    words = [(d, SPACES.findall(t or "")) for d, t in rows]
    least = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            least[key] = min(least.get(key, d), d)
    out = []
    for d, w in words:
        drop = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < d:
                drop.update(range(i, i + window))
        out.append((d, len(w), len(drop), " ".join(x for i, x in enumerate(w) if i not in drop)))
    return sorted(out)


@pytest.mark.parametrize("window", [13, 3])
def test_substring_dedup(spark, documents, window):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = substrings.remove_repeats(documents, window).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == brute_repeats(rows, window)
    words = {}
    for d, t in rows:
        words.setdefault(d, []).append(SPACES.findall(t or ""))
    for r in found:
        for s in r.spans:
            assert s.reference < r.doc_id and s.stop - s.start >= window
            # the words of a factor stand in its reference, from the given place on
            own = {tuple(w[s.start:s.stop]) for w in words[r.doc_id]}
            assert own & {tuple(w[s.place:s.place + s.stop - s.start]) for w in words[s.reference]}


def test_a_factor_ends_where_its_reference_does(spark):
    w = [f"w{k}" for k in range(14)]
    texts = {1: w[:13] + ["x", "y", "z"] + w[1:], 2: w, 3: ["a"] + w + ["b"] + w}
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in substrings.remove_repeats(docs).collect()}
    assert got[1] == []
    assert got[2] == [(0, 13, 1, 0), (1, 14, 1, 16)]  # two places of document 1, which has no run of 14
    assert got[3] == [(1, 14, 1, 0), (2, 15, 1, 16), (16, 29, 1, 0), (17, 30, 1, 16)]


def test_substring_dedup_of_nothing(spark, documents):
    assert substrings.remove_repeats(documents.where("false")).collect() == []
    odd = spark.createDataFrame([(None, "a b c d"), (1, None), (2, "a b c d")], "doc_id long, text string")
    got = {(r.doc_id, r.n_removed, r.kept) for r in substrings.remove_repeats(odd, 2).collect()}
    assert got == {(None, 0, "a b c d"), (1, 0, ""), (2, 0, "a b c d")}


def test_word_hashes_by_pieces(monkeypatch):
    import pyarrow as pa
    from pulsegrid.llm import words
    texts = ["a bb  ccc", None, "", " x", "long" * 50, "y\tz ", "É é"]
    whole, first = word_hashes(pa.array(texts), SPACED, FOLD)
    assert np.diff(first).tolist() == [3, 0, 0, 1, 1, 2, 2]
    monkeypatch.setattr(words, "PIECE", 4)
    cut, again = word_hashes(pa.array(["skip", *texts]).slice(1), SPACED, FOLD)
    assert whole.tolist() == cut.tolist() and first.tolist() == again.tolist()
    assert len(set(whole.tolist())) == len(whole)
    assert window_codes(whole, 2)[0] != window_codes(whole[[1, 0]], 2)[0]


def test_packing():
    rng = np.random.default_rng(0)
    codes = np.sort(rng.integers(0, 2 ** 63, 1000).astype(np.uint64) * 2)
    assert unpack_sorted(pack_sorted(codes), 1000).tolist() == codes.tolist()
    for values in ([], [0], [5, 0, 2 ** 40]):
        assert unpack(pack(np.array(values, np.uint64)), len(values)).tolist() == values
    ids = np.array([-2 ** 62, 0, 7, 2 ** 62])
    assert unpack_ids(pack_ids(ids), 4).tolist() == ids.tolist()


def test_decontamination(spark):
    item, short = prose(20, 30), ["only", "four", "words", "here"]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short)), (3, " ".join(item[5:25])), (4, None),
                                   (5, "?!"), (None, "lone"), (1, " ".join(item))], "item_id long, text string")
    texts = [" ".join(prose(30, 40) + item[3:22] + prose(31, 30)), " ".join(item[:12]), "ONLY, four-words (here)!",
             "lone", None, "", " ".join(item * 3), " ".join(prose(33, 500)), " ".join(prose(34, 300) + short),
             "only four words only four words here words here"]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, n_hit string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    patterns = []
    for r in items.collect():
        w = word.findall((r.text or "").translate(LOWER))
        m = min(13, len(w))
        patterns += [(r.item_id, tuple(w[i:i + m])) for i in range(len(w) - m + 1) if m]
    for blocks in (decontaminate.BLOCK_BYTES, 50):
        decontaminate.BLOCK_BYTES = blocks
        got = {r.doc_id: r for r in decontaminate.benchmark_hits(docs, items).collect()}
        for k, text in enumerate(texts):
            w, hit, ids = word.findall((text or "").translate(LOWER)), set(), set()
            for item_id, p in patterns:
                for i in range(len(w) - len(p) + 1):
                    if tuple(w[i:i + len(p)]) == p:
                        hit.update(range(i, i + len(p)))
                        ids |= {str(item_id)} if item_id is not None else set()
            want = (len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w))
            assert (got[k].n_words, got[k].n_hit, got[k].item_ids, got[k].contaminated) == want
        assert got[0].text == texts[0]
    decontaminate.BLOCK_BYTES = 16_000_000


def test_sharding(spark, documents):
    rows = documents.collect()
    for shards, block_rows in ((7, 5), (40, 100_000), (500, 10)):
        got = shuffle_shards.shuffled_shards(documents.repartition(5), shards, 3, block_rows).collect()
        assert Counter(tuple(r[:6]) for r in got) == Counter(tuple(r) for r in rows)
        sizes = Counter(r.shard for r in got)
        assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
        for s in sizes:
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert shuffle_shards.shuffled_shards(documents.where("false"), 4).collect() == []


def test_communication_matrix():
    sizes, columns = np.array([5, 0, 7, 3]), np.array([4, 4, 4, 3])
    cells = [np.array([shuffle_shards.matrix_row(sizes, columns, p, seed) for p in range(4)]) for seed in range(4000)]
    assert all((c.sum(0) == columns).all() and (c.sum(1) == sizes).all() for c in cells)
    # mean of a cell: row sum * column sum / all
    assert np.abs(np.mean(cells, axis=0) - np.outer(sizes, columns) / 15).max() < 0.06


def test_large_populations(monkeypatch):
    rng = np.random.default_rng(1)
    plain = rng.hypergeometric(300, 700, 200, 20000)
    monkeypatch.setattr(shuffle_shards, "LARGEST", 1)
    own = np.array([shuffle_shards.hypergeometric(rng, 300, 700, 200) for _ in range(20000)])
    a, b = (np.bincount(x, minlength=120) for x in (plain, own))
    seen = a + b > 40
    assert ((a - b) ** 2 / (a + b + 1e-9))[seen].sum() < 2 * seen.sum()
    assert shuffle_shards.hypergeometric(rng, 4 * 10 ** 9, 10 ** 9, 10 ** 9) == pytest.approx(8 * 10 ** 8, rel=1e-3)
    columns = np.array([3 * 10 ** 9, 0, 10 ** 9])
    assert shuffle_shards.split(rng, columns, 2 * 10 ** 9).sum() == 2 * 10 ** 9


def test_query_sizes(spark):
    import os
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("the given tables are not here")
    got = shuffle_shards.op3(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    assert hashlib.sha256(b"").hexdigest()  # digests of empty texts are those of no bytes
