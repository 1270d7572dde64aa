"""Quality rules of documents, and verdicts on the hosts they come from.

Each document is measured within its row: words, their characters, symbols, repeated lines, and words in repeated
windows of three. Rules that fail are counted by host. A host of few documents says little, so its rate is shrunk:
a beta prior is fitted to the rates of all hosts by their mean and variance (weighted by documents), and a host's
rate is the mean of the posterior. A host is rejected if the shrunk rate of any rule exceeds ``limit``, and its
documents with it. Only DataFrame expressions are used. What is shuffled are the counts of hosts, summed within
tasks first, so that a host with a third of all documents is a row like others; verdicts are joined back.

Words are ``[^\x20\x09-\x0D]+``. Windows are told apart by a 64-bit hash within their document. Defined cases: null
and empty texts have no words and fail; a null host is a host of its own; repeated rows count each; an empty table
has no hosts. Columns of the names made here are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, stable, table

LEAST_WORDS = 50
LIMIT = 0.5

RULES = ("short", "repetitive", "symbols", "lines")


def measured(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    gaps = " \t\n\x0b\x0c\r"
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(gaps))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(F.struct(*keep).alias("row"), body.alias("text"), F.when(
        trimmed == "", F.expr("cast(array() AS array<string>)")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")).alias("w"))
    step = step.select(
        "row", "w", F.length(F.array_join("w", "")).alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).alias("n_symbols"),
        lines_repeated(lines).alias("n_dup_lines"))
    windows = F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(
        F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))
    step = step.withColumn("h", F.when(F.size("w") > 2, windows).otherwise(F.expr("cast(array() AS array<bigint>)")))
    # equal windows stand side by side when sorted; most texts have none
    placed = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    step = step.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), placed))
    again = F.filter("s", lambda e, i: F.coalesce(e["h"] == F.get("s", i - 1)["h"], F.lit(False))
                     | F.coalesce(e["h"] == F.get("s", i + 1)["h"], F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))))
    return step.select("row.*", F.size("w").cast("bigint").alias("n_words"),
                       F.col("word_chars").cast("bigint"), F.col("n_symbols").cast("bigint"),
                       F.col("n_dup_lines").cast("bigint"),
                       F.when(F.col("s").isNull(), 0).otherwise(F.size(covered)).cast("bigint").alias("n_repeat_words"))


def lines_repeated(lines: Column) -> Column:
    return F.size(lines) - F.size(F.array_distinct(lines))


def failures() -> dict[str, Column]:
    """What each rule says of a measured document."""
    words = F.col("n_words")
    return {"short": words < LEAST_WORDS, "repetitive": F.col("n_repeat_words") * 100 > words * 50,
            "symbols": F.col("n_symbols") * 10 > words * 3, "lines": F.col("n_dup_lines") * 15 > words}


def host_verdicts(documents: DataFrame, host: str, limit: float = LIMIT) -> DataFrame:
    """(host, n_documents, rate_<rule> ..., rejected) from rows with a boolean column for each rule."""
    counts = documents.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_documents"), *(F.sum(F.col(r).cast("bigint")).alias(r) for r in RULES))
    n = F.col("n_documents")
    facts = counts.agg(F.sum(n).alias("n"), *(F.sum(r).alias(f"k_{r}") for r in RULES), *(
        F.sum(F.col(r) * F.col(r) / n).alias(f"q_{r}") for r in RULES)).first()  # one row
    shrunk = []
    for r in RULES:
        mean = (facts[f"k_{r}"] or 0) / (facts["n"] or 1)
        spread = (facts[f"q_{r}"] or 0) / (facts["n"] or 1) - mean * mean
        # between hosts that do not differ the prior is as strong as all documents together
        strength = min(max(mean * (1 - mean) / spread - 1, 1.0), float(facts["n"] or 1)) if spread > 0 else float(
            facts["n"] or 1)
        shrunk.append(((F.col(r) + mean * strength) / (n + strength)).alias(f"rate_{r}"))
    rated = counts.select("host", "n_documents", *shrunk)
    rejected = F.greatest(*(F.col(f"rate_{r}") for r in RULES)) > limit
    return rated.withColumn("rejected", rejected)


def judged(docs: DataFrame, host: str = "source", text: str = "text", keep: list[str] | None = None,
           limit: float = LIMIT) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all), the measures, base_failed, host_rejected and kept."""
    made = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rejected",
            "kept"}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    rows = docs.select(F.struct(*keep).alias("own"), F.col(text).alias("text"), F.col(host).alias("host"))
    facts = measured(rows, "text", ["own", "host"])
    facts = stable(facts.select("*", *(rule.alias(name) for name, rule in failures().items())))
    verdicts = host_verdicts(facts, "host", limit).select(F.col("host").alias("of"), "rejected")
    base = F.col("short") | F.col("repetitive")
    return facts.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "left").select(
        "own.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        F.coalesce("rejected", F.lit(False)).alias("host_rejected"),
        (~base & ~F.coalesce("rejected", F.lit(False))).alias("kept"))


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
n AS (SELECT doc_id, i, w[i:i + 2] AS s FROM (
        SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
r AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS x FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM n) WHERE c > 1) GROUP BY doc_id),
f AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
c AS (SELECT source, rule, count(*) AS n, sum(failed::INT) AS k FROM (
        SELECT source, unnest([{'rule': 'short', 'failed': n_words < 50},
            {'rule': 'repetitive', 'failed': 100 * n_repeat_words > 50 * n_words},
            {'rule': 'symbols', 'failed': 10 * n_symbols > 3 * n_words},
            {'rule': 'lines', 'failed': 15 * n_dup_lines > n_words}], recursive := true) FROM b) GROUP BY ALL),
p AS (SELECT rule, sum(n) AS total, sum(k) / sum(n) AS mean,
        sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2 AS spread FROM c GROUP BY rule),
s AS (SELECT rule, mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 1), total)
        ELSE total END AS strength FROM p),
v AS (SELECT source, max((k + mean * strength) / (n + strength)) > 0.5 AS rejected FROM c JOIN s USING (rule)
      GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""


@query("op9_host_quality", SQL)
def op9(spark, sf_dir):
    return judged(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("host_rejected")
