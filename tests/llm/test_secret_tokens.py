"""Random strings that stand alone are found through the scan, whatever they are made of."""

import os
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import secret_scan

SF = "/root/testdata/sf0.01"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = {"letters": LETTERS, "letters and digits": LETTERS + "0123456789", "base 64": LETTERS + "0123456789+/",
         "hex": "0123456789abcdef"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
def test_recall_and_false_rate_through_the_scan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train, held = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    ratios = secret_scan.train(train)
    rnd = random.Random(5)
    rows, words = [], ["some", "words", "around", "it,", "und", "dann", "(mais)", "noch"]
    for kind, alphabet in KINDS.items():
        for low, high in ((8, 11), (12, 15), (16, 24)):
            for _ in range(150):
                token = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(low, high)))
                rows.append((kind, low, token, f"{rnd.choice(words)} {rnd.choice(words)} {token} {rnd.choice(words)}"))
    planted = spark.createDataFrame(rows, "kind string, low int, token string, text string")
    found = secret_scan.scanned(planted, ratios).withColumn(
        "hit", F.exists("spans", lambda s: (s["value"] == F.col("token")) & (F.substr(
            "text", (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")) == F.col("token"))))
    recall = {(r["kind"], r["low"]): r["r"] for r in found.groupBy("kind", "low").agg(
        F.avg(F.col("hit").cast("int")).alias("r")).collect()}
    assert all(r >= (0.85 if kind == "hex" and low == 8 else 0.93) for (kind, low), r in recall.items()), recall
    assert sum(recall.values()) / len(recall) >= 0.97

    # at most one in a thousand of the distinct tokens of documents that were not trained on
    tokens = held.select(F.explode(F.regexp_extract_all("text", F.lit(secret_scan.TOKEN), F.lit(0))).alias("t")).distinct()
    wrong = secret_scan.scanned(held, ratios, keep=[]).select(F.explode("spans").alias("s")).where(
        "s.kind = 'markov'").select("s.value").distinct()
    assert wrong.count() <= tokens.count() / 1000


def test_odd_texts(spark):
    texts = [None, "", "x", "qWeRtYuIoPaSdFgHjKlZxCvB", "a" * 300_000, "+" * 40 + " " + "=" * 9, "\x00" * 20, "Ω" * 30,
             "xK9vQ2mZ7pL4 xK9vQ2mZ7pL4+ (xK9vQ2mZ7pL4)", "xK9v+Q2m/Z7p_L4="]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(None, texts[3]), (3, texts[3])],
                                 "doc_id long, text string")
    common = " ".join(a + b + c for a in ("the", "con", "ver", "and") for b in ("ti", "ra", "lo", "mi", "ster")
                      for c in ("ing", "tion", "ment", "able", "ly"))
    ratios = secret_scan.train(spark.createDataFrame([(0, common), (1, "token: 7dK2pXq9LmZ01bTy")],
                                                     "doc_id long, text string"))
    got = secret_scan.scanned(docs, ratios).collect()
    assert len(got) == len(texts) + 2
    spans = {r.doc_id: [(s.start, s.stop, s.kind) for s in r.spans] for r in got}
    assert spans[0] == spans[1] == spans[2] == spans[7] == []
    assert spans[3] == spans[None] == [(0, 24, "markov")]
    # a token is a longest run: with a sign after it it is another one, weighed on its own
    assert [s for s in spans[8] if s[0] != 13] == [(0, 12, "markov"), (28, 40, "markov")]
    assert spans[9] == [(0, 16, "markov")]
    assert secret_scan.scanned(docs.where("false"), secret_scan.train(docs.where("false"))).collect() == []
