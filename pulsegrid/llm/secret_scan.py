"""Secret scan: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Base spans come from three patterns. Beside them, every token (a longest run of ``[A-Za-z0-9+/_=-]``) of 8 or more
characters is weighed, whatever it is made of: the log likelihood of its characters, each given the one before, under a
model of random strings less that under a model of ordinary identifiers. If the sum exceeds ``EVIDENCE`` and the mean over
the token ``THRESHOLD`` it is a span too, unless a base span overlaps it.

Both models are tables of character pairs, trained on two samples of at most ``SAMPLE_ROWS`` ids each (those with the least
hash): of documents in which a base pattern occurs, and of all documents. Values in base spans are labelled
random, tokens elsewhere ordinary, and these are taken to be written in capitals at times. Each distinct string counts once. Pairs that were hardly seen go by their
second character. Strings drawn evenly from all characters are random too, so the random model is an even mixture with these.
The ratio goes back into the plan as one array of 66 x 66 numbers.

Only Spark expressions are used. The distinct tokens of a text are weighed first; those found random make a pattern, by
which, as by the fixed ones, a text is split and the matches taken out; running lengths of both
give the places, in code points, end exclusive. Defined cases: null and empty texts have no spans; repeated rows are
rows like others; a null id can be scanned and is not in the sample; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import product
from math import log
from string import ascii_lowercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, table, whole_row

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: a run that is too short cannot hold one that is long enough, so the least length stands in these two patterns
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}+"
IN_TOKEN = "[A-Za-z0-9+/_=-]"
TOKEN = IN_TOKEN + "{8,}+"
ORDINARY = IN_TOKEN + "{4,}+"
#: where a base span is likely, to choose documents that hold labelled strings
LABELLED = "(?:" + ASSIGN[:-2] + "{8,}))|(?:" + ACCESS + ")|(?:" + HEX + ")"

KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_"
OTHER = len(ALPHABET)  # = and -, which end or join
WIDTH = OTHER + 1
SAMPLE_ROWS = 4_000
UNIFORM, BACK_OFF = 0.05, 5.0
CAPITALS = 0.02  # of ordinary words may be in capitals
EVEN = 0.5  # share of evenly drawn strings among random ones
THRESHOLD, EVIDENCE = 0.5, 8.0

SPANS = "array<struct<start:bigint,rank:int,stop:bigint,kind:string,value:string>>"


def matches(text: Column, pattern: str | Column, kind: str, value: int = 0) -> Column:
    """Spans (start, rank, stop, kind, value) of all leftmost matches; ``value`` is the group that is kept."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(value))
    parts = F.arrays_zip(F.slice(F.transform(gaps, lambda g: F.length(g)), F.lit(1), F.size(whole)).alias("gap"),
                         F.transform(whole, lambda m: F.length(m)).alias("size"), kept.alias("value"))
    nothing = F.expr(f"struct(0L AS at, cast(array() AS {SPANS}) AS spans)")

    def onward(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        stop = start + p["size"]
        return F.struct(stop.alias("at"), F.concat(acc["spans"], F.array(F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), stop.alias("stop"), F.lit(kind).alias("kind"),
            p["value"].alias("value")))).alias("spans"))

    found = F.aggregate(parts, nothing, onward, lambda acc: acc["spans"])
    return F.when(F.rlike(text, pattern), found).otherwise(F.expr(f"cast(array() AS {SPANS})"))


def base_spans(text: Column) -> Column:
    return F.concat(F.filter(matches(text, ASSIGN, "assign", 2), lambda s: F.length(s["value"]) >= 8),
                    F.when(text.contains("AKIA"), matches(text, ACCESS, "access")).otherwise(
                        F.expr(f"cast(array() AS {SPANS})")),
                    matches(text, HEX, "hex"))


def pair_counts(sample: DataFrame, text: str) -> DataFrame:
    """(random, pair, n): how often each pair of characters stands in distinct random and ordinary strings."""
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "), HEX, " ")

    def labelled(values: Column, random: bool) -> Column:
        return F.transform(values, lambda s: F.struct(F.lit(random).alias("random"), s.alias("s")))

    both = F.concat(labelled(base_spans(F.col(text))["value"], True),
                    labelled(F.array_distinct(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))), False))
    strings = sample.select(F.explode(both).alias("x")).select("x.*").distinct()
    chars = F.split("s", "")
    pairs = F.zip_with(chars, F.slice(chars, 2, F.size(chars)), lambda a, b: F.concat(a, b))  # null after the last
    return strings.where(F.length("s") > 1).select("random", F.explode(pairs).alias("pair")).where(
        "pair IS NOT NULL").groupBy("random", "pair").agg(F.count("*").alias("n"))


def place(c: str) -> int:
    at = ALPHABET.find(c)
    return OTHER if at < 0 else at


def sampled(ids: DataFrame, rows: int) -> DataFrame:
    return ids.select("id").where("id IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(rows)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[float]:
    """Log likelihood ratios of pairs, random to ordinary, by place of the first and the second character."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = sampled(rows.where(F.rlike("text", F.lit(LABELLED))), sample_rows).union(sampled(rows, sample_rows)).distinct()
    sample = rows.join(F.broadcast(ids), "id")  # at most twice sample_rows ids
    counts = {side: [[0] * WIDTH for _ in range(WIDTH)] for side in (False, True)}
    for row in pair_counts(sample, "text").collect():  # two tables of pairs
        counts[row["random"]][place(row["pair"][0])][place(row["pair"][1])] += row["n"]
    for a, b in product(ascii_lowercase, repeat=2):
        counts[False][place(a.upper())][place(b.upper())] += CAPITALS * counts[False][place(a)][place(b)]
    random, ordinary = (likelihoods(counts[side]) for side in (True, False))
    return [log((1 - EVEN) * r + EVEN / WIDTH) - log(o) for r, o in zip(random, ordinary, strict=True)]


def likelihoods(counts: list[list[float]]) -> list[float]:
    """Of each character after each: by the pairs seen, and as far as few were, by the characters alone."""
    seen = [sum(column) for column in zip(*counts, strict=True)]
    alone = [(1 - UNIFORM) * (n + 1) / (sum(seen) + WIDTH) + UNIFORM / WIDTH for n in seen]
    return [(n + BACK_OFF * p) / (sum(row) + BACK_OFF) for row in counts for n, p in zip(row, alone, strict=True)]


def total_ratio(token: Column, ratios: list[float]) -> Column:
    """The log likelihood ratio of a token's pairs, in one walk over its characters."""
    # both tables are folded to literals
    known = F.split(F.lit(",".join(f"{x:.3f}" for x in ratios)), ",").cast("array<float>")
    places = F.split(F.lit(",".join(str(place(chr(c))) for c in range(128))), ",").cast("array<int>")

    def onward(acc: Column, c: Column) -> Column:
        at = F.coalesce(F.get(places, F.ascii(c)), F.lit(OTHER))
        pair = F.when(acc["last"] < 0, 0.0).otherwise(F.get(known, acc["last"] * WIDTH + at).cast("double"))
        return F.struct(at.alias("last"), (acc["total"] + pair).alias("total"))

    return F.aggregate(F.split(token, ""), F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("total")), onward,
                       lambda acc: acc["total"])


def mean_ratio(token: Column, ratios: list[float]) -> Column:
    """The mean log likelihood ratio of a token's pairs."""
    return total_ratio(token, ratios) / (F.length(token) - 1)


def random_tokens(text: Column, ratios: list[float]) -> Column:
    """The distinct tokens of a text that are likelier random strings than ordinary ones."""
    return F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))), lambda t: total_ratio(
        t, ratios) > F.greatest(F.lit(EVIDENCE), THRESHOLD * (F.length(t) - 1)))


def any_of(tokens: Column) -> Column:
    """A pattern of whole tokens."""
    return F.concat(F.lit(rf"(?<!{IN_TOKEN})(?:\Q"), F.array_join(tokens, r"\E|\Q"), F.lit(rf"\E)(?!{IN_TOKEN})"))


def scanned(docs: DataFrame, ratios: list[float], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all), with spans (start, rank, stop, kind, value) by start and kind.

    A column named spans is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    rows = docs.select(whole_row(keep).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("row", "text", base_spans(F.col("text")).alias("base"), random_tokens(F.col("text"), ratios).alias("tokens"))
    own = F.when(F.size("tokens") > 0, matches(F.col("text"), any_of(F.col("tokens")), "markov")).otherwise(
        F.expr(f"cast(array() AS {SPANS})"))
    rows = rows.select("row", "base", own.alias("own"))
    free = F.filter("own", lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    rows = rows.select("row", "base", free.alias("own"))
    return rows.select("row.*", F.sort_array(F.concat("base", "own")).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "<SECRET>") -> Column:
    """The text with each stretch that spans cover replaced by a mark."""
    def onward(acc: Column, s: Column) -> Column:
        begins = s["start"] >= acc["at"]
        out = F.when(begins, F.concat(acc["out"], F.substr(
            text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), out.alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), onward,
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int")))))


def told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


@query("op7_secret_scan")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = scanned(docs, train(docs), keep=["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(
        told(F.filter("spans", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
