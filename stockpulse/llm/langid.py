"""Language identification with a linear-chain conditional random field.

Each word of a line gets a language label. A word's scores come from its
affixes (of 1 to 3 letters), its letter n-grams (2 and 3, with word ends) and
the word itself if the learned lexicon has it; learned transitions join the
labels of neighbours, so a switch of language within a line is found. Forward
and backward sums give each word's marginal probabilities; a document's
language is the one with the largest mean over all its words.

Fitting takes a bounded sample of labelled rows (``PER_LANG`` for each
language that occurs, by hash of doc_id) to the driver. It starts from the document's
language as the label of all of its words, then labels the words anew with the
model so found (text switches languages within documents) and fits again. The
model is a table of 2^17 features by language: its size does not depend on
the input.

Results for odd input: null, empty and letterless texts are ``und`` with score
0; without any labelled row so is every text; repeated rows get equal
results; extra columns are left out (``predict``) or kept
(``keep_identified``); an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.common import bound_batches, fold, free_name, hold

FOLDS = 5
#: Labelled rows of each language that the model is fitted on.
PER_LANG = 250
DIM = 1 << 17
LEXICON = 20_000
STEPS, RATE, DECAY = 30, 0.1, 1e-4
UNKNOWN = "und"
#: Words in the cache of a worker, and cells of a padded block.
CACHE, CELLS = 300_000, 1 << 18
#: New words whose features are in memory at a time.
LEARNED = 8_000


def normal(token: str) -> str:
    """A token's letters in lower case."""
    return "".join(c for c in token.lower() if c.isalpha())


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, one after the other, and where each word's begin."""
    text = np.frombuffer("".join("\2" + w + "\3" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    size = np.array([len(w) + 2 for w in words])
    start = np.cumsum(size) - size
    owner, left = np.repeat(np.arange(len(words)), size), np.repeat(start + size, size) - np.arange(len(text))
    found, own = [], []
    mix, h = np.uint64(0x9E3779B97F4A7C15), np.zeros(len(text), "u8")
    for n in range(1, 5):
        h = (h + np.concatenate([text[n - 1:], np.zeros(n - 1, "u8")]) + np.uint64(n)) * mix
        h ^= h >> np.uint64(29)
        fits = left >= n
        if n == 4:  # affixes of three letters: with the mark of the word's start or end
            fits &= (np.arange(len(text)) == np.repeat(start, size)) | (left == 4)
        if n > 1:
            found.append((h[fits] >> np.uint64(20)) % np.uint64(DIM))
            own.append(owner[fits])
    known = [(i, lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    found.append(np.array([DIM + k for _, k in known], "u8"))
    own.append(np.array([i for i, _ in known], "i8"))
    own, found = np.concatenate(own), np.concatenate(found).astype("i8")
    order = np.argsort(own, kind="stable")
    counts = np.bincount(own, minlength=len(words))
    return found[order], np.cumsum(counts) - counts


def blocks(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Lines of like length together: their numbers, in blocks of bounded padded size."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        n = max(1, CELLS // max(1, int(lengths[order[at]])))
        yield order[at:at + n]
        at += n


def forward_backward(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, first: np.ndarray, pairs: bool = False):
    """Marginals of padded lines (time, line, label), longest line first; with ``pairs`` also expected transitions and the log sum."""
    T, B, L = scores.shape
    top = scores.max(axis=2, keepdims=True)
    e = np.exp(scores - top)
    A = np.exp(trans)
    live = np.searchsorted(-lengths, -np.arange(T), side="left")  # lines longer than t
    alpha, norm = np.zeros_like(e), np.ones((T, B), e.dtype)
    for t in range(T):
        n = live[t]
        a = e[t, :n] * np.exp(first) if t == 0 else (alpha[t - 1, :n] @ A) * e[t, :n]
        norm[t, :n] = a.sum(axis=1)
        alpha[t, :n] = a / norm[t, :n, None]
    beta = np.ones_like(e)
    expected = np.zeros((L, L))
    for t in range(T - 2, -1, -1):
        n = live[t + 1]
        r = e[t + 1, :n] * beta[t + 1, :n] / norm[t + 1, :n, None]
        beta[t, :n] = r @ A.T
        if pairs:
            expected += (alpha[t, :n].T @ r) * A
    marginal = alpha * beta
    marginal /= np.maximum(marginal.sum(axis=2, keepdims=True), 1e-30)
    if not pairs:
        return marginal
    inside = np.arange(T)[:, None] < lengths[None, :]
    return marginal, expected, float((np.log(norm) + top[:, :, 0])[inside].sum())


def padded(lines: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (time, line) of the lines' words in the flat sequence, and which of the cells are words."""
    t = np.arange(int(lengths[lines[0]]))[:, None]
    inside = t < lengths[lines][None, :]
    return np.where(inside, start[lines][None, :] + t, 0), inside


def split_text(text: str | None) -> list[list[str]]:
    """Lines with words."""
    return [w for w in (x.split() for x in (text or "").split("\n")) if w]


class Model:
    def __init__(self, langs: list[str], lexicon: dict[str, int], weights: np.ndarray, trans: np.ndarray, first: np.ndarray):
        self.langs, self.lexicon, self.weights, self.trans, self.first = langs, lexicon, weights, trans, first
        self._start()

    def _start(self) -> None:
        self.cache: dict[str, int] = {}
        self.table, self.used = np.zeros((1024, max(1, len(self.langs))), "f4"), 0

    def __getstate__(self):
        return self.langs, self.lexicon, self.weights, self.trans, self.first

    def __setstate__(self, state):
        self.__init__(*state)

    def _learn(self, tokens: set[str]) -> None:
        todo = [(t, n) for t in tokens if (n := normal(t))]
        self.cache.update(dict.fromkeys(tokens, -1))
        for at in range(0, len(todo), LEARNED):
            some = todo[at:at + LEARNED]
            f, start = features([n for _, n in some], self.lexicon)
            rows = np.add.reduceat(self.weights[f], start, axis=0)
            while self.used + len(rows) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[self.used:self.used + len(rows)] = rows
            self.cache.update(zip((t for t, _ in some), range(self.used, self.used + len(rows))))
            self.used += len(rows)

    def word_marginals(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its words' line numbers and marginals (word, label); words without letters are left out."""
        if len(self.cache) > CACHE:
            self._start()
        split = [split_text(t) for t in texts]
        self._learn({w for lines in split for line in lines for w in line} - self.cache.keys())
        get = self.cache.__getitem__
        flat = [np.fromiter(map(get, line), "i8", len(line)) for lines in split for line in lines]
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in split])
        flat = [x[x >= 0] for x in flat]
        lengths = np.array([len(x) for x in flat], "i8")
        rows = np.concatenate(flat) if flat else np.zeros(0, "i8")
        start = np.cumsum(lengths) - lengths
        out = np.zeros((len(rows), len(self.langs)), "f4")
        some = np.flatnonzero(lengths > 0)
        for block in blocks(lengths[some]):
            lines = some[block]
            place, inside = padded(lines, start, lengths)
            m = forward_backward(self.table[rows[place]], lengths[lines], self.trans, self.first)
            out[place[inside]] = m[inside]
        per_doc = np.bincount(doc, weights=lengths, minlength=len(texts)).astype("i8")
        ends = np.cumsum(per_doc)
        line_no = np.repeat(np.arange(len(lengths)), lengths)
        return [(line_no[z - n:z], out[z - n:z]) for z, n in zip(ends, per_doc)]

    def languages(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """Each text's language, its mean marginal, and the mean of each word's largest marginal (nothing learned: 1 with letters)."""
        if not self.langs:
            return [(UNKNOWN, 0.0, float(any(map(str.isalpha, t or "")))) for t in texts]
        out = []
        for _, m in self.word_marginals(texts):
            if len(m):
                mean = m.mean(axis=0, dtype="f8")
                out.append((self.langs[int(mean.argmax())], float(min(1.0, mean.max())), float(min(1.0, m.max(axis=1).mean(dtype="f8")))))
            else:
                out.append((UNKNOWN, 0.0, 0.0))
        return out


def fit(rows: list[tuple[str, str]]) -> Model:
    """Fit on (text, language) rows by full-batch Adam steps."""
    langs = sorted({lang for _, lang in rows})
    seqs, labels = [], []
    for text, lang in rows:
        for line in split_text(text):
            words = [n for n in map(normal, line) if n]
            if words:
                seqs.append(words)
                labels.append(langs.index(lang))
    L = max(1, len(langs))
    trans, first = np.zeros((L, L)), np.zeros(L)
    if not seqs:
        return Model([], {}, np.zeros((DIM + LEXICON, L), "f4"), trans, first)
    tokens: dict[str, int] = {}
    for s in seqs:
        for w in s:
            tokens[w] = tokens.get(w, 0) + 1
    lexicon = {w: i for i, w in enumerate(sorted((w for w, c in tokens.items() if c >= 3), key=lambda w: (-tokens[w], w))[:LEXICON])}
    types = {w: i for i, w in enumerate(tokens)}
    f, begin = features(list(types), lexicon)
    used, f = np.unique(f, return_inverse=True)  # the weights of all other features stay zero
    weights = np.zeros((len(used), L), "f4")
    per_type = np.diff(np.append(begin, len(f)))
    lengths = np.array([len(s) for s in seqs], "i8")
    start = np.cumsum(lengths) - lengths
    flat = np.fromiter((types[w] for s in seqs for w in s), "i8", int(lengths.sum()))
    gold = np.eye(L)[np.repeat(labels, lengths)]
    link = np.ones(len(flat), bool)
    link[start] = False
    at = [(lines, *padded(lines, start, lengths)) for lines in blocks(lengths)]
    moments = [[np.zeros_like(p, dtype="f8"), np.zeros_like(p, dtype="f8")] for p in (weights, trans, first)]
    step = 0
    for phase in range(2):
        for _ in range(STEPS):
            step += 1
            table = np.add.reduceat(weights[f], begin, axis=0).astype("f8")
            marginal, expected = np.zeros_like(gold), np.zeros((L, L))
            for lines, place, inside in at:
                m, e, _ = forward_backward(table[flat[place]], lengths[lines], trans, first, pairs=True)
                marginal[place[inside]] = m[inside]
                expected += e
            diff = gold - marginal
            by_type = np.stack([np.bincount(flat, weights=diff[:, k], minlength=len(types)) for k in range(L)], axis=1)
            spread = np.repeat(by_type, per_type, axis=0)
            g = np.stack([np.bincount(f, weights=spread[:, k], minlength=len(weights)) for k in range(L)], axis=1)
            pairs = gold[np.flatnonzero(link) - 1].T @ gold[link]
            grads = [g / len(flat) - DECAY * weights, (pairs - expected) / len(flat) if phase else np.zeros((L, L)), diff[start].mean(axis=0) if phase else np.zeros(L)]
            for p, gr, (m1, m2) in zip((weights, trans, first), grads, moments):
                m1 *= 0.9
                m1 += 0.1 * gr
                m2 *= 0.999
                m2 += 0.001 * gr * gr
                p += RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
        if phase == 0:  # label words anew: what the words say, with neighbours that mostly agree
            sticky, table = np.log(np.full((L, L), 0.05 / max(1, L - 1)) + np.eye(L) * 0.95), np.add.reduceat(weights[f], begin, axis=0).astype("f8")
            prior = np.log(0.7 * gold + 0.3 / L)
            for lines, place, inside in at:
                m = forward_backward(table[flat[place]] + prior[place], lengths[lines], sticky, np.zeros(L))
                gold[place[inside]] = np.eye(L)[m.argmax(axis=2)][inside]
    learned = np.zeros((DIM + LEXICON, L), "f4")
    learned[used] = weights
    return Model(langs, lexicon, learned, trans, first)


def train(docs: DataFrame, per_lang: int = PER_LANG, folds: int = FOLDS) -> Model:
    """Fit on a sample of the rows with a language whose fold is not 0."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")) \
        .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = slim.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_lang).select("doc_id", "lang")
    names = F.broadcast(picked)  # at most per_lang ids of each language
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null") \
        .join(names, ["doc_id", "lang"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "lang")
    return fit([(r["text"], r["lang"]) for r in sorted(got.collect(), key=lambda r: r["doc_id"])])


def predict(model: Model, spark, text: Column) -> Column:
    """Struct (lang, score, sure) of each text."""
    bound_batches(spark)
    sent = spark.sparkContext.broadcast(pickle.dumps(model))
    key = zlib.crc32(sent.value)

    @F.pandas_udf("lang string, score double, sure double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = hold(("langid", key), lambda: pickle.loads(sent.value))
        for texts in batches:
            out, some, size = [], [], 0
            for t in texts:
                some.append(t)
                size += len(t or "")
                if size > 2_000_000:
                    out += own.languages(some)
                    some, size = [], 0
            out += own.languages(some)
            yield pd.DataFrame(out, columns=["lang", "score", "sure"])

    return run(text)


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``."""
    model = train(docs, per_lang)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), predict(model, docs.sparkSession, F.col("text").cast("string")).alias("p"))
    return rows.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_identified(docs: DataFrame, least: float = 0.5, per_lang: int = PER_LANG) -> DataFrame:
    """The rows of ``docs`` whose text has letters, and words with a largest marginal of ``least`` or more in the mean.

    So text of several languages stays if each of its words has a clear one,
    and without any labelled row every text with letters does.
    """
    p = free_name(docs, "language")
    model = train(docs, per_lang)
    scored = docs.withColumn(p, predict(model, docs.sparkSession, F.col("text").cast("string")))
    return scored.where((F.col(f"{p}.sure") > 0) & (F.col(f"{p}.sure") >= least)).drop(p)
