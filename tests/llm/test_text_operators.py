"""Toxicity, BPE, licences, secrets, quality rules and chat formatting against plain versions."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import bpe, chat_format, host_quality, licence_scan, secret_scan, toxicity

SF = "/root/testdata/sf0.01"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    terms = [toxicity.Term(t, w, 1.0) for t, w in
             (("moron", True), ("idiot", True), ("vequ", False), ("scum", True), ("lowei", False), ("morons", True))]
    lexicon, rnd = toxicity.Lexicon(terms), random.Random(4)
    for _ in range(6000):
        word = list(rnd.choice([t.text for t in terms]) + rnd.choice(["", "s", "schaft", "x"]))
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randrange(len(word) + 1)
            word[at:at + rnd.randint(0, 1)] = rnd.choice(["", "a", "o", "z"])
        word = "".join(word)
        best = None
        for t in terms:
            ends = [len(word)] if t.whole else range(len(word) + 1)
            edits = min(distance(t.text, word[:e]) for e in ends)
            if edits <= (len(t.text) >= toxicity.FUZZY):
                best = edits if best is None else min(best, edits)
        got = lexicon.match(word)
        assert (got and got[1]) == best, word


def test_quotation_weighs_less(spark):
    terms = [toxicity.Term("moron", True, 6.0, 3.0), toxicity.Term("idiot", True, 6.0, 3.0)]
    model = toxicity.Model(terms, (2.0, 1.0, -4.5))
    texts = ['You moron, you IDIOT!!', 'She wrote "you moron, you idiot" in the report', "> moron idiot\nI disagree",
             "you m0ron you idi0t", "", None, "plain words only", "x " * 30000 + "moron idiot"]
    docs = spark.createDataFrame([(k, t, 9) for k, t in enumerate(texts)], "doc_id long, text string, hits int")
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert got[0].score > 0.95 and got[7].score > 0.9 and got[3].score > 0.75
    assert all(got[k].score < got[0].score - 0.05 for k in (1, 2)) and all(h.quoted for h in got[1].hits)
    assert got[4].score == got[5].score == got[6].score < 0.05
    assert [h.edits for h in got[3].hits] == [1, 1]
    assert toxicity.scored(docs, toxicity.Model([], ())).agg(F.max("score")).first()[0] == 0.0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels).terms == []


@here
def test_toxicity_held_out(spark):
    got = toxicity.op1(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    hits = Counter((r.toxic, r.predicted) for r in rows)
    assert hits[1, 1] >= 0.7 * (hits[1, 1] + hits[1, 0]) and hits[0, 1] <= 0.01 * len(rows)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.collect())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.tokenizer_file())


def test_bpe_equals_library(spark, library):
    rnd = random.Random(1)
    parts = list(" \t\n\r\x0b ab'strellm!?1é中🙂\x1c") + ["<|endoftext|>", "'re", "'ll", "à ", "’s", "“", "…",
                                                             " ", "ß", "İ", " 's", "  ", "word"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(8000)]
    texts += ["".join(chr(rnd.choice([rnd.randint(0, 127), rnd.randint(0, 0x2ff), rnd.randint(0x10000, 0x1ffff)]))
                      for _ in range(rnd.randint(1, 30))) for _ in range(4000)]
    texts += [None, "", "x" * 100_000, " " * 5000, "a\n" * 20_000]
    docs = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, ids int")
    got = {r.doc_id: r for r in bpe.encoded(docs, bpe.tokenizer_file(), keep=["doc_id"]).collect()}
    wanted = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for k, want in enumerate(wanted):
        assert np.frombuffer(got[k].ids, "<u4").tolist() == want.ids, texts[k]
        assert got[k].n_tokens == len(want.ids)
        assert got[k].decoded == library.decode(want.ids, skip_special_tokens=False)


def test_bpe_cuts_texts_with_rare_white_space(library):
    codec = bpe.Codec(open(bpe.tokenizer_file(), encoding="utf-8").read())
    rare = [chr(x) for x in (0x0B, 0x0C, 0x1C, 0x1F, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x205F, 0x3000)]
    pieces = [*"abcXYZ019 \n\t\r'.,!-_(){}é日😀²", "'s", "'LL", " the", "http://", "<|endoftext|>", "\r\n"]
    draw = random.Random(3)
    for _ in range(4000):
        text = "".join(draw.choice(rare if draw.random() < 0.25 else pieces) for _ in range(draw.randint(1, 24)))
        ids = np.frombuffer(codec.encode([text.encode()])[0], "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text
    assert len(codec.fragments("one,\u00a0two\n(three) \u3000 four\n".encode())) > 3


def test_bpe_broken_characters(library):
    codec = bpe.Codec(open(bpe.tokenizer_file(), encoding="utf-8").read())
    ids = library.encode("🙂é", add_special_tokens=False).ids
    for part in (ids[:1], ids[1:], ids[:2]):
        assert codec.decode(np.array(part, "<u4").tobytes()) == library.decode(part, skip_special_tokens=False)


def test_licences(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, and so on.\n"
           "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
           "of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, express.")
    cases = {
        "Foo. Released under the MIT License.\nbar": ["MIT"], mit: ["MIT"], "x. " + mit.upper() + " y": ["MIT"],
        "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"], "licensed  under the apache license, version 2.0": ["Apache-2.0"],
        "This work is licensed under the GNU General Public License, version 3.\nOr, at your option, any later version.":
            ["GPL-3.0-or-later"],
        "This work is licensed under the GNU General Public License, version 3. Also, any later version.":
            ["GPL-3.0-only"],
        "SPDX-License-Identifier: Apache-2.0 OR MIT\nSPDX-License-Identifier: 0BSD": ["Apache-2.0 OR MIT", "0BSD"],
        "Copyright (c) 2020 X. All rights reserved.": ["unmatched:copyright", "unmatched:all-rights"],
        "": [], None: [], "a licence to speak": [], "Released under the MIT License. " * 500: ["MIT"] * 500}
    docs = spark.createDataFrame([(k, t, "n") for k, t in enumerate(cases)], "doc_id long, text string, notices string")
    got = {r.doc_id: r.notices for r in licence_scan.with_licences(docs, keep=["doc_id"]).collect()}
    assert [[n.licence for n in got[k]] for k in range(len(cases))] == list(cases.values())
    assert list(cases)[0][got[0][0].start:got[0][0].stop] == "Released under the MIT License."
    for name, form in licence_scan.SENTENCES:  # every known sentence has a key word
        assert any(k in form.replace("licen[cs]e", "licence") for k in licence_scan.KEYS), name


@here
def test_licence_query_finds_every_notice(spark):
    got = {r.doc_id: r for r in licence_scan.op6(spark, SF).collect()}
    forms = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        want = {name for line, name in forms.items() if line in (r.text or "").split("\n")}
        assert want <= set(got[r.doc_id].licences.split(",")) | set()


ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def base_of(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(spans)


def test_secret_spans(spark):
    rnd = random.Random(3)
    parts = ["password", "ToKeN", "api_key", "apikey", "secret", "=", ":", " ", "\"", "'", "abc", "AKIA", "ABCD1234EFGH",
             "0123456789abcdef" * 2, "deadbeef", "é🙂", "\n", "==", "x.y-z/w", "Z"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) for _ in range(1500)]
    texts += [None, "", "secret=token: abcdefghijk", "a" * 50_000, "token=abcdefgh " * 300,
              "see 7f3Kq9ZxW2mP0sLb8TnV here", "the_quick_identifier_of_2024"]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, spans string")
    syllables = ["the", "quick", "_", "iden", "tifier", "of", "or", "din", "ary", "words", "ly", "er", "ing", "con"]
    words = ["".join(rnd.choice(syllables) for _ in range(4)) for _ in range(600)]
    ordinary = spark.createDataFrame([(0, " ".join(words)), (1, "secret=7dK2pXq9LmZ01bTy")],
                                     "doc_id long, text string")
    found = secret_scan.scanned(docs, secret_scan.train(ordinary), keep=["doc_id", "text"])
    got = {r.doc_id: r for r in found.withColumn("clean", secret_scan.redacted(
        F.coalesce("text", F.lit("")), F.col("spans"))).collect()}
    for k, text in enumerate(texts):
        spans = [(s.start, s.rank, s.stop, s.kind) for s in got[k].spans]
        assert [s for s in spans if s[3] != "markov"] == base_of(text or ""), text
        out, at = "", 0
        for start, _, stop, _ in spans:
            if start >= at:
                out += (text or "")[at:start] + "<SECRET>"
            at = max(at, stop)
        assert got[k].clean == out + (text or "")[at:]
    assert [s.kind for s in got[len(texts) - 2].spans] == ["markov"] and not got[len(texts) - 1].spans


@here
def test_secret_models_tell_random_from_ordinary(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ratios = secret_scan.train(docs)
    rnd = random.Random(5)
    words = [w for r in docs.limit(50).collect() for w in re.findall(r"[A-Za-z]{5,}", r.text or "")]
    ordinary = ["_".join(rnd.choice(words).lower() for _ in range(3)) for _ in range(300)]
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    drawn = ["".join(rnd.choice(alphabet) for _ in range(24)) for _ in range(300)]
    rows = spark.createDataFrame([(x, t) for x, ts in ((0, ordinary), (1, drawn)) for t in ts], "random int, t string")
    scored = rows.withColumn("r", secret_scan.mean_ratio(F.col("t"), ratios) > secret_scan.THRESHOLD).collect()
    assert sum(r.r == bool(r.random) for r in scored) >= 0.95 * len(scored)


def test_quality_rules(spark):
    rnd = random.Random(2)
    texts = [None, "", " \n\t", "a b c", "a b c a b c a b", "x\n\nx\n y\nx", "#$ a|b <c>", "é ü ß", "a\x0bb\x0cc"]
    texts += ["".join(rnd.choice(["a ", "b ", "c\n", "dd ", "#", "\n"]) for _ in range(rnd.randint(5, 200))) for _ in range(120)]
    texts += [" ".join(f"w{k}" for k in range(60))] * 3 + ["same words here " * 3000]
    docs = spark.createDataFrame([(k, t, None if k % 7 == 0 else f"h{k % 5}", 1) for k, t in enumerate(texts)],
                                 "doc_id long, text string, source string, n_words int")
    got = {r.doc_id: r for r in host_quality.judged(docs, keep=["doc_id", "source"], limit=0.98).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        again = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), len("".join(w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert r.kept == (not r.base_failed and not r.host_rejected)
    assert host_quality.judged(docs.where("false")).collect() == []


def test_small_hosts_are_shrunk(spark):
    rows = [(f"h{k}", k % 10 == 0) for k in range(100) for _ in range(50)] + [("small", True)] + [("bad", True)] * 200
    facts = spark.createDataFrame(rows, "host string, short boolean").select(
        "*", *(F.lit(False).alias(r) for r in host_quality.RULES[1:]))
    got = {r.host: r for r in host_quality.host_verdicts(facts, "host", 0.6).collect()}
    assert got["bad"].rejected and got["h10"].rejected and not got["h11"].rejected
    assert 0.1 < got["small"].rate_short < 0.6 < got["h10"].rate_short and not got["small"].rejected


def test_chat_format(spark):
    rnd = random.Random(6)
    parts = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "<", "|", "\\", "\n", "a", "%0A", "%", "é🙂", "<\\|", "<|"]
    rows = []
    for conv in range(120):
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, turn // 2 if conv % 3 else turn, rnd.choice(["user", "assistant", "assistant", "sys\ntem%0A", "<|x", None]),
                         rnd.choice([None, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))]), "m"))
    rows += [rows[0], (None, 0, "user", "hi", "m"), (500, None, "assistant", "x", "m")]
    rows += [(600, k, "assistant" if k % 2 else "user", f"t{k}", "m") for k in range(1500)]
    data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mask string")
    made = chat_format.formatted(data)
    got = {r.conv_id: r for r in made.select(
        "*", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.masked_text(F.col("formatted"), F.col("mask")).alias("learnt")).collect()}
    for conv in {r[0] for r in rows}:
        want = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x, _ in rows if c == conv),
                      key=lambda v: (v[0], v[1], v[2].encode(), v[3].encode()))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r, x) for _, _, r, x in want]
        assert got[conv].learnt == "".join(x for _, _, r, x in want if r == "assistant")
        assert got[conv].formatted.count(chat_format.START) == sum(
            k == 0 or want[k][2] != want[k - 1][2] for k in range(len(want)))
    assert chat_format.formatted(data.where("false")).collect() == []


def test_digests_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
