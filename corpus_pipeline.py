"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

1. toxicity: rejects documents whose score reaches the threshold.
2. near duplicates: of each component of documents with alike sets of five-word shingles (0.8 or more of the union)
   the one with the least doc_id stays.
3. decontamination: rejects documents contaminated by items of ``benchmark``.
4. secrets: each stretch that holds a secret is replaced by a mark; documents stay, and n_chars follows the text.
5. tokens: adds nothing to drop; returns doc_id, lang, source, the number of tokens, the ids and their digest.

The first four return the columns of ``documents``, extra ones too, whatever their names. Defined cases: documents without an id or without words are never
near duplicates and stay; rows that repeat a doc_id are one document and stay or go together; null texts have no hits,
no secrets and no tokens. Where SQL has no word for a stage (a fitted model, BPE), the
result is tested against a plain version in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import bpe, decontaminate, jaccard_join, secret_scan, toxicity
from pulsegrid.llm.common import short_batches, table, without
from pulsegrid.session import ensure_shared_dir, work_dir

ORACLE_SQL = None


def packed(docs: DataFrame) -> DataFrame:
    """The texts and, apart from what a stage adds, the whole rows: a stage overwrites no column of its input."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(packed(docs), model, keep=["document"]).where(F.col("score") < toxicity.THRESHOLD).select("document.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    classes = jaccard_join.near_duplicates(docs, size=5, percent=80)
    # a row without an id has no class and stays
    return without(docs, classes.where("doc_id <> component_id").select("doc_id"), "doc_id")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    found = decontaminate.benchmark_hits(packed(docs), table(spark, sf_dir, "benchmark"), keep=["document"])
    return found.where(~F.col("contaminated")).select("document.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(packed(docs), secret_scan.train(docs), keep=["document"])
    clean = secret_scan.redacted(F.col("document.text"), F.col("spans"))
    changed = {"text": clean, "n_chars": F.when(F.size("spans") > 0, F.length(clean).cast("bigint")).otherwise(
        F.col("document.n_chars"))}
    return found.select(*(changed[c].alias(c) if c in changed else F.col(f"document.`{c}`") for c in docs.columns))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    short_batches(spark)
    found = bpe.encoded(docs, bpe.tokenizer_file(), keep=["doc_id", "lang", "source"])
    return found.select("doc_id", "lang", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is a table in the shared folder."""
    ensure_shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
