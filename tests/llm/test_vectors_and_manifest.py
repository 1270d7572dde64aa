"""Whitening, nearest neighbours and the Merkle manifest against plain versions, and odd input."""

import math
import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import merkle, nearest, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 0) for k, v in rows], VECTORS)


def some_vectors(n, d, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) * np.linspace(2, 0.5, d)).astype(np.float32)


# ---- whitening

@pytest.mark.parametrize("width", [1, 2, 7, 40])
@pytest.mark.parametrize("kind", ["any", "equal", "groups", "flat"])
def test_spectrum_slices(width, kind):
    rng = np.random.default_rng(width)
    if kind == "any":
        a = rng.standard_normal((3 * width, width))
        v = a.T @ a
    elif kind == "equal":
        v = 3 * np.eye(width)
    elif kind == "groups":  # eigenvalues that occur three times
        q, _ = np.linalg.qr(rng.standard_normal((width, width)))
        v = (q * np.repeat(np.arange(1, width + 1), 3)[:width]) @ q.T
        v = (v + v.T) / 2
    else:
        a = rng.standard_normal((max(1, width // 3), width))
        v = a.T @ a
    values, vectors = whitening.leading(v, 32)
    known = np.linalg.eigvalsh(v)[::-1]
    assert len(values) == min(32, int((known > 1e-9 * known[0]).sum()))
    assert np.allclose(values, known[:len(values)], rtol=0, atol=1e-12 * known[0])
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ vectors.T - vectors.T * values).max() < 1e-12 * known[0]


def test_counts_of_a_shifted_matrix():
    a = np.random.default_rng(5).standard_normal((30, 12))
    v = a.T @ a
    shifts = np.linspace(-1, 80, 50)
    got = whitening.above(*whitening.tridiagonal(v), shifts)
    assert got.tolist() == [(np.linalg.eigvalsh(v) > s).sum() for s in shifts]


def test_whitening_against_whole_numbers(spark):
    vectors = some_vectors(300, 6)
    df = frame(spark, [(k, v.tolist()) for k, v in enumerate(vectors)]).repartition(7)
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    model = whitening.fit(df, count=4)
    assert (model.n, model.sums) == (n, sums.tolist())
    v = np.cov(x.T, bias=True)
    assert np.allclose(model.values, np.linalg.eigvalsh(v)[::-1][:4], rtol=1e-12)
    assert model.trace == pytest.approx(np.trace(v), rel=1e-12)
    got = {r.vec_id: r for r in whitening.whitened(df, model).collect()}
    for k in range(n):
        assert got[k].deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[k], sums, strict=True))
        assert got[k].deviation_digits == str(got[k].deviation)
        assert np.allclose(got[k].whitened, model.components @ (x[k] - sums / n) / np.sqrt(model.values), atol=1e-9)
    assert whitening.identity_error(df, model) < 1e-12
    # neither order nor number of tasks changes a digit
    again = whitening.fit(df.orderBy(F.rand(1)).repartition(3), count=4)
    assert again.sums == model.sums and (again.components == model.components).all()


def test_odd_vectors(spark, tmp_path):
    good = some_vectors(60, 3)
    rows = [(k, v.tolist()) for k, v in enumerate(good)]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [math.nan, 0.0, 0.0]), (904, [0.0, math.inf, 0.0]),
           (905, [1.0, 2.0]), (None, [0.5, 0.5, 0.5]), (1, rows[1][1])]  # a null id and a repeated row take part
    df = frame(spark, rows + odd).withColumn("n", F.lit("mine")).withColumn("component", F.lit(9))
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = whitening.op11(spark, str(tmp_path)).collect()
    ids = [None if r.vec_id is None else r.vec_id for r in got if r.component == 1]
    assert sorted(ids, key=str) == sorted([k for k, _ in rows] + [None, 1], key=str)
    assert {r.n for r in got} == {62} and {r.component for r in got} == {1, 2, 3}
    assert all(r.identity_error < 1e-10 for r in got)
    assert sum({r.component: r.explained for r in got}.values()) == pytest.approx(1)


def test_entries_beyond_a_long_and_sums_beyond_it(spark):
    big = frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 5.0])])
    model = whitening.fit(big)
    found = whitening.whitened(big, model).collect()
    x = [[2 ** 62 + 10 ** 6, 64 + 10 ** 6], [10 ** 6 - 2 ** 62, 128 + 10 ** 6], [10 ** 6, 320 + 10 ** 6]]
    assert model.sums == [sum(c) for c in zip(*x, strict=True)]
    for r in found:
        exact = sum((3 * a - s) ** 2 for a, s in zip(x[r.vec_id - 1], model.sums, strict=True))
        assert r.deviation_digits == str(exact) and r.deviation == (exact if exact < 2 ** 63 else None)


def test_nothing_to_whiten(spark, tmp_path):
    for k, rows in enumerate([[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]]):
        frame(spark, rows).write.parquet(str(tmp_path / str(k) / "embeddings.parquet"))
        assert whitening.op11(spark, str(tmp_path / str(k))).collect() == []


# ---- nearest neighbours

def plain_nearest(queries, rows, k):
    out = []
    for q in sorted({i for i, _ in queries}):
        best = {}
        for i, a in queries:
            for j, b in rows:
                if i == q and j != q and len(a) == len(b):
                    a_, b_ = np.asarray(a, float), np.asarray(b, float)
                    s = (a_ * b_).sum() / (math.sqrt((a_ * a_).sum()) * math.sqrt((b_ * b_).sum()))
                    best[j] = max(s, best.get(j, -2))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, rank, j, s) for rank, (j, s) in enumerate(ranked, 1)]
    return out


def same(got, want):
    got = sorted(tuple(r) for r in got)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(a[3] == pytest.approx(b[3], abs=1e-14) for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("width", [1, 3, 64])
def test_nearest_is_exact(spark, monkeypatch, width):
    # several stripes on both sides, small tiles
    monkeypatch.setattr(nearest, "STRIPE_BYTES", 8 * width * 90)
    monkeypatch.setattr(nearest, "TILE", (7, 16))
    monkeypatch.setattr(nearest, "PAIRS", 64)
    vectors = some_vectors(260, width, seed=8)
    vectors[50:90] = vectors[3]                     # copies, ties
    vectors[90:120] = vectors[3] * np.float32(2)    # the same direction
    vectors[120:160] = vectors[4] + vectors[120:160] * np.float32(1e-4)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    df = frame(spark, rows).repartition(5)
    same(nearest.nearest(df.where("vec_id % 9 = 3"), df).collect(), plain_nearest([r for r in rows if r[0] % 9 == 3], rows, 5))


def test_bounds_hold():
    rng = np.random.default_rng(2)
    for width in (1, 5, 200, 2500):
        a, b = rng.standard_normal((20, width)), rng.standard_normal((30, width)) ** 3
        (x, sx, ex, _), (y, sy, ey, ky) = nearest.rounded(a), nearest.rounded(b)
        assert (nearest.tile_products(x, y) == x.astype(int) @ y.astype(int).T).all()
        near = nearest.tile_products(x, y) * sx[:, None] * sy
        exact = (a / nearest.lengths(a)[:, None]) @ (b / nearest.lengths(b)[:, None]).T
        assert (np.abs(near - exact) <= ey + ex[:, None] * ky + 1e-12).all()


def test_odd_neighbours(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1e-3]), (7, [0.0, 2.0]), (8, [0.0, 2.0]), (9, [3e38, 0.0]), (9, [1e-38, 1e-38]),
            (0, [1.0, 0.0]), (50, [0.0, 1.0]), (100, [1.0, 2.0, 3.0])]
    out = [(150, None), (200, []), (250, [0.0, 0.0]), (300, [math.nan, 1.0]), (350, [None, 1.0]), (None, [1.0, 0.0])]
    df = frame(spark, rows + out).withColumn("score", F.lit("mine")).withColumn("rank", F.lit(1))
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = nearest.op13(spark, str(tmp_path)).collect()
    floats = [(k, np.asarray(v, np.float32).tolist()) for k, v in rows]
    same(got, plain_nearest([r for r in floats if r[0] % 50 == 0], floats, 5))
    assert {r.query_id for r in got} == {0, 50}  # the vector of length 3 has nothing to be compared with
    frame(spark, []).write.parquet(str(tmp_path / "none" / "embeddings.parquet"))
    assert nearest.op13(spark, str(tmp_path / "none")).collect() == []


# ---- Merkle manifest

def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(out[-1][k:k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, place):
    for nodes in tree[:-1]:
        first = place - place % 8
        yield nodes[first:place], nodes[place + 1:first + 8]
        place //= 8


def plain_manifest(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    def leaf(r, text):
        return digest(encoded(v) for v in (r[0], r[3], r[2], r[4], text))

    names = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r, r[1]), r) for r in rows if r[2] == name), key=lambda x: x[:3])
        trees[name] = own, levels([x[2] for x in own])
    top, out = levels([trees[n][1][-1][0] for n in names]), []
    for k, name in enumerate(names):
        own, tree = trees[name]
        for place, (_, _, node, r) in enumerate(own):
            at = node
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                at = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]))
            proof = [*siblings(tree, place), *siblings(top, k)]
            for a, b in proof:
                at = digest([*a, at, *b])
            out.append((r[0], node, tree[-1][0], top[-1][0], digest(x for a, b in proof for x in a + b), at, at == top[-1][0]))
    return sorted(out, key=str)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def manifest_of(spark, tmp_path, rows, extra=False):
    df = spark.createDataFrame(rows, DOCS).repartition(6)
    if extra:
        for c in ("node", "tree", "place", "size", "leaf", "rid"):
            df = df.withColumn(c, F.lit("mine"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in merkle.op12(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("deep", [1, 4])
def test_manifest(spark, tmp_path, monkeypatch, deep):
    monkeypatch.setattr(merkle, "LEVELS", deep)  # superblocks of 8: several stages, also over the trees
    rnd = random.Random(deep)
    rows = [(k, rnd.choice(["Ab", "é Text", "", None, "plain"]) and f"Word {k} É", rnd.choice(["en", "de", None, "", "é"]),
             rnd.choice([None, "web:1", "-"]), rnd.choice([None, k])) for k in range(700)]
    rows += [(1000 + k, "One", f"lang{k}", "s", 3) for k in range(12)]  # languages of one row
    rows += [(2 ** 60 + 1, "Big", "en", "s", 3), (None, "No id", "en", None, None), (None, None, None, None, None)]
    rows += [rows[5]] * 40 + [(rows[6][0], "Other", rows[6][2], None, 1)]  # repeated rows, a repeated id
    assert manifest_of(spark, tmp_path, rows, extra=True) == plain_manifest(rows)


@pytest.mark.parametrize("count", [0, 1, 2, 8, 9, 64, 65])
def test_small_manifests(spark, tmp_path, count):
    rows = [(k, f"T{k}" * (3_000 if k == 5 else 1), "en", "s", 2) for k in range(count)]
    assert manifest_of(spark, tmp_path, rows) == plain_manifest(rows) if rows else True
    if not rows:
        assert manifest_of(spark, tmp_path, rows) == []
