"""Toxicity by Levenshtein automata over a lexicon trie.

The lexicon is learned from labelled rows: words, and openings of words (4 or
5 letters, any ending), that go with the label, by log-likelihood ratio. Its
trie is run together with a Levenshtein automaton: a state is the set of (trie
node, edits so far) that a word's letters can have led to, states are made
when first reached, and a word is a lexicon term or a misspelling of one if it
ends in a state that accepts. Short terms allow no edit, longer ones one or
two. Forms within reach that training rows without the label use are ordinary
words and do not count.

Each match has a context window of ``CONTEXT`` words on either side: quotation
marks around it, or a reporting word before it, make it a quotation. Exact and
misspelled, direct and quoted matches are features of their own in a logistic
model, so quoting and abuse get scores of their own.

Fitting takes a bounded sample of labelled rows (``PER_CLASS`` of each label,
by hash of doc_id). Lexicon and model are small whatever the input. Texts are
never shuffled but those of the sample.

Results for odd input: null and empty texts have no match and the score of
that; without labelled rows of both kinds every score is the share of label 1
(0 if there is none); of several labels for one doc_id the largest counts;
null labels and doc_ids are not learned from; repeated rows get equal results;
extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import fold, hold, written

FOLDS = 5
#: Labelled rows of each label that lexicon and model are learned from (two thirds and one third).
PER_CLASS = 3000
#: Terms in the lexicon; least rows and log odds of a term.
TERMS, LEAST_ROWS, LEAST_ODDS = 600, 4, 2.5
CONTEXT = 6
#: Words of a worker's cache.
CACHE = 600_000

# Marks of quotation and words that report speech.
QUOTES = "\"“”„«»‹›"
REPORTING = ("said", "says", "wrote", "called", "quoted", "quote", "word", "term", "sagte", "schrieb", "wort", "zitat", "dit", "mot", "citation", "dijo", "palabra", "cita")

_STRIP = ".,;:!?\"'“”„«»‹›()[]{}*#$%&…-_"


def edits_of(term: str) -> int:
    """Edits that a term allows."""
    n = len(term.rstrip("*"))
    return 0 if n < 5 or term.endswith("*") else 1 if n < 9 else 2


class Automaton:
    """Trie of the terms (a final ``*``: any ending) run with a Levenshtein automaton, made deterministic as it goes."""

    LIMIT = 300_000

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.kids, self.ends, self.open, self.most = [{}], [None], [None], [0]
        for term in terms:
            at, allowed = 0, edits_of(term)
            for c in term.rstrip("*"):
                self.most[at] = max(self.most[at], allowed)
                if c not in self.kids[at]:
                    self.kids[at][c] = len(self.kids)
                    for x, v in ((self.kids, {}), (self.ends, None), (self.open, None), (self.most, 0)):
                        x.append(v)
                at = self.kids[at][c]
            self.most[at] = max(self.most[at], allowed)
            (self.open if term.endswith("*") else self.ends)[at] = term
        self._fresh()

    def _fresh(self) -> None:
        self.names: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[str, int] | None] = []
        self.first = self._state({(0, 0): None})

    def _state(self, places: dict) -> int:
        todo = list(places)
        best: dict[int, int] = {}
        while todo:  # leaving out a letter of the term costs an edit
            node, e = todo.pop()
            if e > self.most[node] or best.get(node, 9) <= e:
                continue
            best[node] = e
            todo.extend((k, e + 1) for k in self.kids[node].values())
        key = frozenset(best.items())
        if key not in self.names:
            self.names[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            ends = [(e, self.ends[n]) for n, e in key if self.ends[n] and e <= edits_of(self.ends[n])]
            self.accepts.append(min(((t, e) for e, t in ends), key=lambda x: (x[1], -self.terms[x[0]], x[0])) if ends else None)
        return self.names[key]

    def _move(self, state: int, c: str) -> int:
        to: dict = {}
        for node, e in self.sets[state]:
            for k, kid in self.kids[node].items():
                to[kid, e + (k != c)] = None
            to[node, e + 1] = None
        new = self._state(to)
        self.moves[state][c] = new
        return new

    def match(self, word: str) -> tuple[str, int] | None:
        """The term that the word is or is nearest to, and the edits."""
        at, state = 0, self.first
        opened = None
        for c in word:
            if at is not None:
                at = self.kids[at].get(c)
                if at is not None and self.open[at]:
                    opened = self.open[at], 0
            nxt = self.moves[state].get(c)
            if nxt is None:
                nxt = self._move(state, c)
            state = nxt
            if not self.sets[state]:
                if at is None:
                    break
        got = self.accepts[state]
        if got and got[1] == 0:
            return got
        if len(self.sets) > self.LIMIT:
            self._fresh()
        return opened or got


class Model:
    """Lexicon, ordinary words within its reach, and weights of the features."""

    def __init__(self, terms: dict[str, float], ordinary: set[str], weights: np.ndarray):
        self.terms, self.ordinary, self.weights = terms, ordinary, weights
        self._start()

    def _start(self) -> None:
        self.automaton, self.seen, self.hits = Automaton(self.terms), set(), {}

    def __getstate__(self):
        return self.terms, self.ordinary, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def matches(self, text: str | None) -> list[tuple[int, str, int, bool]]:
        """(word number, term, edits, quoted) of every match in the text."""
        words = (text or "").lower().split()
        kinds = set(words)
        if len(self.seen) > CACHE:
            self._start()
        for w in kinds - self.seen:
            bare = w.strip(_STRIP)
            got = self.automaton.match(bare) if bare else None
            if got and (got[1] == 0 or bare not in self.ordinary):
                self.hits[w] = got
        self.seen |= kinds
        if kinds.isdisjoint(self.hits.keys()):
            return []
        return [(i, *self.hits[w], quoted(words, i)) for i, w in enumerate(words) if w in self.hits]

    def features(self, matches: list[tuple[int, str, int, bool]]) -> list[float]:
        out = [1.0, 0, 0, 0, 0, 0, 0]
        for _, term, e, q in matches:
            k = 3 if q else 1 if e == 0 else 2
            out[k] = max(out[k], self.terms[term])
            out[k + 3] += 1
        return [*out[:4], *(math.log1p(x) for x in out[4:])]

    def scores(self, marks: list[list[tuple[int, str, int, bool]]]) -> np.ndarray:
        z = np.array([self.features(m) for m in marks]).reshape(-1, 7) @ self.weights
        return 1 / (1 + np.exp(-z))


def quoted(words: list[str], i: int) -> bool:
    """Whether the words around word i make it a quotation: marks on both sides, or a reporting word before it."""
    before, after = words[max(0, i - CONTEXT):i], words[i + 1:i + 1 + CONTEXT]
    own = words[i]
    opening = own[0] in QUOTES or sum(c in QUOTES for w in before for c in w) % 2 == 1
    closing = own.rstrip(".,;:!?")[-1:] in QUOTES or any(c in QUOTES for w in after for c in w)
    return opening and closing or any(w.strip(_STRIP) in REPORTING for w in before[-2:])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps (no ridge on the constant)."""
    w, r = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    r[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - r * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(r) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = FOLDS) -> Model:
    """Learn from a sample of the labelled rows whose fold is not 0."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null") \
        .where(fold(F.col("doc_id"), folds) != 0).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    # the least of each label, found in every partition first
    least = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    picked = least[0].unionByName(least[1])
    # at most 2 * per_class ids; copies of one text count once
    sample = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                     .join(F.broadcast(picked), "doc_id").dropDuplicates(["text"]), "toxicity-sample")
    # the weights are fitted on other rows than the lexicon, so chance terms get no trust
    weigh = F.pmod(F.xxhash64(F.lit("weigh"), F.col("doc_id")), F.lit(3)) == 0
    sample, other = sample.where(~weigh), sample.where(weigh)
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        share = min(max(totals.get(1, 0) / max(1, sum(totals.values())), 1e-9), 1 - 1e-9)
        return Model({}, set(), np.array([math.log(share / (1 - share)), 0, 0, 0, 0, 0, 0]))
    bare = F.transform(F.split(F.lower("text"), "\\s+"), lambda w: F.btrim(w, F.lit(_STRIP)))
    words = sample.select("toxic", F.explode(F.array_distinct(F.filter(bare, lambda w: F.char_length(w) >= 3))).alias("w"))
    rows = sample.select("doc_id", "toxic", F.explode(F.array_distinct(F.flatten(F.transform(F.array_distinct(F.filter(bare, lambda w: F.char_length(w) >= 3)), lambda w: F.array_compact(F.array(
        w, *[F.when(F.char_length(w) > k, F.concat(F.substring(w, 1, k), F.lit("*"))) for k in (4, 5)])))))).alias("term"))
    counts = rows.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    terms = {r["term"]: float(r["odds"]) for r in counts.where(F.col("a") >= LEAST_ROWS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
             .orderBy(F.desc(F.col("odds") * F.col("a")), "term").limit(TERMS).collect()}
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(terms)

    @F.pandas_udf("boolean")
    def misspelled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Automaton(sent.value)
        for some in batches:
            yield pd.Series([bool((m := own.match(w)) and m[1] > 0) for w in some])

    used = words.where("toxic = 0").groupBy("w").agg(F.count("*").alias("b")).where(misspelled("w"))
    ordinary = {r["w"] for r in used.collect()} if terms else set()  # forms within two edits of the lexicon only
    model = Model(terms, ordinary, np.zeros(7))
    unfitted = spark.sparkContext.broadcast(model)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = unfitted.value
        for some in batches:
            x = np.array([own.features(own.matches(t)) for t in some["text"]], float).reshape(-1, 7)
            yield pd.DataFrame({"y": some["toxic"].astype("float64"), **{f"x{i}": x[:, i] for i in range(7)}})

    # the texts stay in the workers; at most 2 * per_class rows of eight numbers come back
    got = np.array(other.select("text", "toxic").mapInPandas(measured, "y double, " + ", ".join(f"x{i} double" for i in range(7))).collect(), float).reshape(-1, 8)
    x, y = got[:, 1:], got[:, 0]
    # a class weighs as much as it has rows in all, so the scores have the true share of label 1
    of = np.array([totals.get(k, 0) / max(1, (y == k).sum()) for k in (0, 1)])
    model.weights = logistic(x, y, of[y.astype(int)] * len(y) / max(1, sum(totals.values())))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted, n_matches, n_quoted) of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    key = zlib.crc32(sent.value)

    @F.pandas_udf("score double, n_matches long, n_quoted long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = hold(("toxicity", key), lambda: pickle.loads(sent.value))
        for texts in batches:
            texts = list(texts)
            marks = [own.matches(t) for t in texts]
            yield pd.DataFrame({"score": own.scores(marks), "n_matches": [len(m) for m in marks], "n_quoted": [sum(q for *_, q in m) for m in marks]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), run(F.col("text").cast("string")).alias("p"))
    return rows.select("doc_id", "p.score", (F.col("p.score") >= 0.5).cast("int").alias("predicted"), "p.n_matches", "p.n_quoted")


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Scores of all rows of ``docs`` with held_out: whether the row is kept from learning."""
    return score(docs, train(docs, labels, per_class)).withColumn("held_out", fold(F.col("doc_id"), FOLDS) == 0)
