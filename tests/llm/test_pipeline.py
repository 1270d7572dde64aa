"""The pipeline's stages, each on its own input, and the queries against their SQL."""

import hashlib
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")

import corpus_pipeline  # noqa: E402
from test_pairs_and_spans import LOWER, brute_components  # noqa: E402
from test_text_operators import base_of  # noqa: E402

from pulsegrid.llm import bpe, toxicity  # noqa: E402
from pulsegrid.llm.queries import ORACLES, QUERIES  # noqa: E402


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLES[name])
    found = [c[0] for c in cursor.description]
    assert sorted(found) == columns
    want = sorted(tuple(plain(r[found.index(c)]) for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


def plain(value):
    return str(round(value, 12) if isinstance(value, float) else value)


def test_native_queries_have_no_python(spark):
    for name in ("op7_secret_scan", "op9_host_quality", "op10_chat_format"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    odd = spark.createDataFrame([(10 ** 7, None, None, None, None), (10 ** 7 + 1, "", "en", "s", 0),
                                 (10 ** 7 + 2, "token=abcdefgh12345 and then words", "en", "s", 34)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.drop("extra").unionByName(odd)
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).checkpoint() if spark.sparkContext.getCheckpointDir() else stage(spark, docs, SF)
        rows = {r.doc_id: r for r in out.collect()}
        assert {10 ** 7, 10 ** 7 + 1, 10 ** 7 + 2} <= set(rows) <= set(before)
        if name == "tokens":
            assert set(rows) == set(before) and rows[10 ** 7].n_tokens == 0
        else:
            assert out.columns == docs.columns
            if name == "secrets":
                assert set(rows) == set(before) and rows[10 ** 7 + 2].text == "<SECRET> and then words"
                same = [k for k in rows if rows[k].text == before[k].text]
                assert len(same) > 0.95 * len(rows)
            else:
                assert all(rows[k] == before[k] for k in rows) and len(rows) < len(before)
            docs, before = out, rows


def test_near_duplicates_leave_one_of_each_group(spark):
    words = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(5, words), (3, words), (9, words + " more"), (1, "other words stand here for once"),
                                  (None, words), (2, None)], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "None"]


def test_stages_overwrite_no_column(spark):
    """Columns named like what the stages compute, and names that need quoting, come out as they went in."""
    names = ["score", "hits", "n_words", "n_hit", "item_ids", "contaminated", "spans", "component_id", "n_shingles", "row",
             "document", "base", "own", "decoded", "a b", "x.y", "q:r"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    mine = docs.withColumns({c: F.concat(F.lit(f"{c} of "), "doc_id") for c in names})
    before = {r.doc_id: r for r in mine.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, mine, SF).collect()
        assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in names), name
        assert rows[0].__fields__ == mine.columns
        if name != "secrets":
            assert all(r == before[r.doc_id] for r in rows)


def test_near_duplicates_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr("pulsegrid.llm.common.BROADCAST_ROWS", 0)
    words = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(5, words), (3, words), (None, words), (2, None)], "doc_id long, text string")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().sparkPlan().toString()
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "3", "None"]


def test_pipeline_stages_on_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_ids_of_text_are_refused(spark):
    docs = spark.createDataFrame([("a", "x y z")], "doc_id string, text string")
    with pytest.raises(TypeError):
        corpus_pipeline.drop_near_duplicates(spark, docs, SF)


def test_run_against_plain_versions(spark):
    """All stages one after the other on the smallest tables, each rule written again over Python rows.

    The fitted parts (the toxicity model, the Markov spans) are taken from the operators.
    """
    from tokenizers import Tokenizer
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.learn(docs, spark.read.parquet(f"{small}/labels.parquet"))
    lexicon = toxicity.Lexicon(model.terms) if model.terms else None
    kept = {}
    for k, r in rows.items():
        hits = toxicity.hits_of(r.text or "", lexicon) if lexicon else []
        if model.score(toxicity.features_of(hits, model.terms)) < toxicity.THRESHOLD:
            kept[k] = r.text or ""
    classes = brute_components(list(kept.items()), 5, 80)
    kept = {k: t for k, t in kept.items() if classes[k][1] == k}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for r in spark.read.parquet(f"{small}/benchmark.parquet").collect():
        w = word.findall((r.text or "").translate(LOWER))
        m = min(13, len(w))
        windows |= {tuple(w[i:i + m]) for i in range(len(w) - m + 1) if m}
    lengths = {len(w) for w in windows}
    for k, text in list(kept.items()):
        w = word.findall(text.translate(LOWER))
        hit = {j for m in lengths for i in range(len(w) - m + 1) if tuple(w[i:i + m]) in windows for j in range(i, i + m)}
        if hit and 20 * len(hit) >= len(w):
            del kept[k]
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, small).collect()}
    assert set(found) == set(kept)
    library = Tokenizer.from_file(bpe.tokenizer_file())
    plain = [k for k, t in kept.items() if not re.search(r"[A-Za-z0-9+/_=-]{16,}", t) and not base_of(t)]
    assert len(plain) > len(kept) / 4
    for k in plain:
        ids = np.array(library.encode(kept[k], add_special_tokens=False).ids, "<u4").tobytes()
        assert bytes(found[k].ids) == ids and found[k].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert found[k].n_tokens == len(ids) // 4
