"""Toxicity: a lexicon learnt from labels, met by Levenshtein automata, weighed in windows of context.

Lexicon. From at most ``TRAIN_ROWS`` labelled documents (those with the least hash of the id; the bound of the
fit, not of the scoring) every word and word beginning is counted in toxic and in clean documents. A form becomes
a term if it tells the classes apart by more than chance would among so many forms, and no shorter beginning does;
it is then made as long as its toxic documents allow.
Documents that share the least of their hashed word triples, near copies mostly, are counted once.

Matching. The trie of all terms is intersected with the Levenshtein automaton of each word: a state is a set of
(trie node, edits) pairs, met states are numbered and their steps remembered, so that a word costs one step for
each character until no term can follow. Terms of ``FUZZY`` letters may be one edit away; shorter ones may not.

Context. Hits are weighed by their term's log odds. A hit one edit away has ``NEAR`` of it, and less the more clean
documents of the fit have such hits of the term. A quoted hit has ``QUOTED`` of it: inside quotation marks, in a
line that is quoted with ``>``, or after a word of reporting. What counts is the sum over the document and the best
sum within ``WINDOW`` words; a logistic curve, fitted to the same documents, makes the score. Labels, lang, source and doc_id never enter it.

Defined cases: null and empty texts have no words and the score of a document without hits. Without labelled
toxic documents there is no lexicon and all scores are 0. Labels that are null do not train; documents labelled
twice train once for each label; a null doc_id is neither labelled nor held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, rows_and, stable, table, whole_row
from pulsegrid.llm.words import FOLD, SPACED, window_codes, word_hashes

TRAIN_ROWS = 20_000
TERMS = 4_000      # forms that go to the driver at most: the best by evidence
LONGEST = 12       # letters of a word beginning
FORMS = 200_000    # counted in a task before they are passed on
FUZZY = 5
WINDOW = 40
NEAR, QUOTED = 0.6, 0.2
THRESHOLD = 0.7
WORDS = 50_000     # remembered words of a task

OPENING, CLOSING = "\"'“„«‘‹", "\"'”“»’›"
#: words of reporting, before a term
REPORTING = frozenset("said says wrote writes called calling quoted quote word words term terms slur insult".split())
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def bare(word: str) -> str:
    """A word in lower case, without what is no letter or digit at its ends."""
    word = word.lower()
    return word if word.isalnum() else EDGES.sub("", word)


@dataclass
class Term:
    text: str
    whole: bool      # or any word that begins with it
    weight: float
    near: float = 0.0  # of a hit one edit away


@dataclass
class Lexicon:
    """Terms as a trie, with the determinised intersection with the automata of words."""

    terms: list[Term]
    steps: dict[tuple[int, str], int] = field(default_factory=dict)

    def __post_init__(self):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.slack = [0]  # edits that some term below a node allows
        for k, term in enumerate(self.terms):
            node = 0
            allowed = int(len(term.text) >= FUZZY)
            self.slack[0] = max(self.slack[0], allowed)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.slack.append(0)
                node = self.children[node][c]
                self.slack[node] = max(self.slack[node], allowed)
            self.ends[node].append(k)
        self.states: list[dict[int, int]] = []
        self.numbers: dict[frozenset, int] = {}
        self.found: list[tuple[tuple[int, int] | None, tuple[int, int] | None]] = []
        self.start = self.number({0: 0})
        self.words: dict[str, tuple[int, int] | None] = {}

    def number(self, state: dict[int, int]) -> int:
        """The number of a state; letters of a term may be left out, for an edit each."""
        todo = list(state.items())
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits < self.slack[child] and edits + 1 < state.get(child, 9):
                    state[child] = edits + 1
                    todo.append((child, edits + 1))
        key = frozenset(state.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(state)
            best: list[tuple[int, int] | None] = [None, None]  # of beginnings, of whole words
            for node, edits in state.items():
                for k in self.ends[node]:
                    if edits <= (len(self.terms[k].text) >= FUZZY):
                        w = int(self.terms[k].whole)
                        if best[w] is None or (edits, k) < (best[w][1], best[w][0]):
                            best[w] = (k, edits)
            self.found.append((best[0], best[1]))
        return self.numbers[key]

    def step(self, number: int, c: str) -> int:
        after: dict[int, int] = {}
        for node, edits in self.states[number].items():
            child = self.children[node].get(c)
            if child is not None:
                after[child] = min(edits, after.get(child, 9))
            if edits < self.slack[node]:  # one letter too many, or another letter
                after[node] = min(edits + 1, after.get(node, 9))
                for other in self.children[node].values():
                    if edits < self.slack[other]:
                        after[other] = min(edits + 1, after.get(other, 9))
        self.steps[number, c] = found = self.number(after)
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the nearest term of a bare word."""
        if len(self.states) > 20_000:
            self.steps.clear()
            self.numbers.clear()
            self.states, self.found = [], []
            self.start = self.number({0: 0})
        state, best = self.start, None
        for c in word:
            following = self.steps.get((state, c))
            state = self.step(state, c) if following is None else following
            if not self.states[state]:
                return best
            begun = self.found[state][0]
            if begun is not None and (best is None or begun[1] < best[1]):
                best = begun
                if not best[1]:
                    return best
        whole = self.found[state][1]
        return whole if whole is not None and (best is None or whole[1] <= best[1]) else best

    def of_raw(self, word: str) -> tuple[int, int] | None:
        if word not in self.words:
            if len(self.words) > WORDS:
                self.words.clear()
            self.words[word] = self.match(bare(word))
        return self.words[word]


def is_quoted(words: list[str], at: int) -> bool:
    """Whether the word stands in quotation marks opened and closed nearby, or after a word of reporting."""
    before = words[max(0, at - 8):at]
    if any(bare(w) in REPORTING for w in before[-2:]):
        return True
    opened = words[at][0] in OPENING
    for w in before:
        if w[0] in OPENING:
            opened = True
        if w.rstrip(".,;:!?")[-1:] in CLOSING:
            opened = w[0] in OPENING and len(w) == 1
    return opened and any(w.rstrip(".,;:!?")[-1:] in CLOSING for w in words[at:at + 9])


def hits_of(text: str, lexicon: Lexicon) -> list[tuple[int, int, int, bool]]:
    """(word, term, edits, quoted) of each hit."""
    words = text.split()
    known, found = lexicon.words, []
    for at, word in enumerate(words):
        hit = known[word] if word in known else lexicon.of_raw(word)
        if hit is not None:
            found.append((at, *hit, is_quoted(words, at)))
    if found and (text[0] == ">" or "\n>" in text):
        quoted = [w for line in text.split("\n") for w in [line.startswith(">")] * len(line.split())]
        if len(quoted) == len(words):
            found = [(a, t, e, q or quoted[a]) for a, t, e, q in found]
    return found


def features_of(hits: list[tuple[int, int, int, bool]], terms: list[Term]) -> tuple[float, float]:
    """Weights of all hits together, and of the best window of words."""
    total = best = running = 0.0
    first = 0
    weights = [(terms[t].near if e else terms[t].weight) * (QUOTED if q else 1) for _, t, e, q in hits]
    for (at, *_), w in zip(hits, weights, strict=True):
        total += w
        running += w
        while hits[first][0] <= at - WINDOW:
            running -= weights[first]
            first += 1
        best = max(best, running)
    return float(np.log1p(max(0.0, total))), float(np.log1p(max(0.0, best)))


@dataclass
class Model:
    terms: list[Term]
    curve: tuple[float, ...]  # of the features, then the constant

    def score(self, features: tuple[float, float]) -> float:
        if not self.terms:
            return 0.0
        z = self.curve[-1] + sum(c * x for c, x in zip(self.curve[:-1], features, strict=True))
        return float(1 / (1 + np.exp(-max(-40.0, min(40.0, z)))))


def held_out(doc_id):
    """Rows whose labels never train."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of documents by form: (form, toxic, clean). A form that ends in a blank is a whole word."""
    counts: dict[str, list[int]] = {}

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array([v[1] for v in counts.values()], pa.int64()),
                                           pa.array([v[0] for v in counts.values()], pa.int64())],
                                          names=["form", "toxic", "clean"])

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            own = set()
            for word in {bare(w) for w in text.as_py().split()}:
                own.update(word[:k] for k in range(3, min(len(word), LONGEST) + 1))
                if 2 < len(word) <= 2 * LONGEST:
                    own.add(word + " ")
            for form in own:
                counts.setdefault(form, [0, 0])[toxic] += 1
            if len(counts) > FORMS:
                yield flush()
                counts.clear()
    yield flush()


def likeness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hashed word triple of each text, which near copies share."""
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            batch = whole.slice(at, 200)
            hashes, first = word_hashes(batch.column(0), SPACED, FOLD)
            codes = window_codes(hashes, 3)
            least = [int(codes[a:b - 2].min()) >> 1 if b - a > 2 else int(hashes[a:b].sum()) >> 1 if b > a else 0
                     for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())],
                                             names=["text", "toxic", "like"])


def select_terms(counted: list[tuple[str, int, int]], toxic: int, clean: int) -> list[Term]:
    """The shortest telling forms, each made as long as nine in ten of its toxic documents allow; with log odds."""
    known = {form: (t, c) for form, t, c in counted}
    longer: dict[str, list[str]] = {}
    for form in known:
        longer.setdefault(form[:-1], []).append(form)
    taken, terms = set(), {}
    for form in sorted(known, key=lambda x: (len(x), x)):
        text, whole = form.rstrip(" "), form.endswith(" ")
        if any(text[:k] in taken for k in range(3, len(text) + (1 if whole else 0))):
            continue
        if not whole:
            taken.add(text)
        while True:
            following = [x for x in longer.get(form, ()) if known[x][0] >= 0.9 * known[text][0]] if not whole else []
            if not following:
                break
            form = max(following, key=lambda x: (known[x][0], x))
            whole = form.endswith(" ")
        t, c = known[form]
        terms[form] = Term(form.rstrip(" "), whole,
                           float(np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))))
    return list(terms.values())


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 60) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a ridge on all but the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step * min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          train_rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``train_rows`` labelled documents, none of them held out."""
    chosen = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("toxic"))
              .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
              .orderBy(F.xxhash64("id"), "id", "toxic").limit(train_rows))
    # at most train_rows pairs of numbers
    joined = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(
        F.broadcast(chosen), "id").select("text", "toxic")
    train = stable(joined.mapInArrow(likeness, "text string, toxic int, like bigint")
                   .dropDuplicates(["toxic", "like"]).select("text", "toxic"))
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model([], ())
    counted = stable(train.mapInArrow(forms, "form string, toxic bigint, clean bigint").groupBy("form").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 1"))
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    gain = F.col("toxic") * F.log(share / (toxic / (toxic + clean)))
    best = (counted.where((share > 0.9) & (gain > float(np.log(max(counted.count(), 2)) + 3)))
            .orderBy(gain.desc(), "form").limit(TERMS).collect())
    terms = select_terms([(r["form"], r["toxic"], r["clean"]) for r in best], toxic, clean)
    if not terms:
        return Model([], ())
    rows = [(r["toxic"], [(h["word"], h["term"], h["edits"], h["quoted"]) for h in r["hits"]])
            for r in train.mapInArrow(hitter(terms), "toxic int, hits array<struct<word:int,term:int,edits:int,"
                                                     "quoted:boolean>>").collect()]  # train_rows at most
    seen = np.zeros(len(terms))
    for is_toxic, hits in rows:
        if not is_toxic:
            seen[list({t for _, t, e, _ in hits if e})] += 1
    for term, n in zip(terms, seen.tolist(), strict=True):
        term.near = NEAR * term.weight * 2 / (2 + n)
    return Model(terms, fit_curve(np.array([features_of(hits, terms) for _, hits in rows]),
                                  np.array([is_toxic for is_toxic, _ in rows])))


def hitter(terms: list[Term]):
    kind = pa.list_(pa.struct([("word", pa.int32()), ("term", pa.int32()), ("edits", pa.int32()),
                               ("quoted", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in batches:
            found = [[dict(zip(("word", "term", "edits", "quoted"), h, strict=True)) for h in hits_of(t.as_py(), lexicon)]
                     for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, kind)], names=["toxic", "hits"])
    return run


HITS = "array<struct<word:bigint,term:string,edits:int,quoted:boolean>>"


def scored(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all), with score and hits; columns of these names are replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "hits")]
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), whole_row(keep).alias("row"))
    hit_type = pa.list_(pa.struct([("word", pa.int64()), ("term", pa.string()), ("edits", pa.int32()),
                                   ("quoted", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            scores, found = [], []
            for value in batch.column(0):
                hits = hits_of(value.as_py(), lexicon) if model.terms else []
                scores.append(model.score(features_of(hits, model.terms)))
                found.append([{"word": a, "term": model.terms[t].text, "edits": e, "quoted": q}
                              for a, t, e, q in hits])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(scores, pa.float64()),
                                              pa.array(found, hit_type)], names=["row", "score", "hits"])

    return rows.mapInArrow(run, rows_and(rows, "row", f"score double, hits {HITS}")).select("row.*", "score", "hits")


@query("op1_toxicity")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
