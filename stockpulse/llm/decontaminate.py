"""Benchmark decontamination with an FM-index for each training shard.

A shard is a run of documents of one partition, of a bounded number of words.
Its text is the documents' words as numbers. Words that no benchmark item has
cannot be part of an occurrence, so they only separate runs of words, and
runs shorter than the shortest window are left out of the index: neither can
lose an occurrence. The index is the Burrows-Wheeler transform of the runs in
a wavelet matrix with counts of set bits, symbol starts and suffix positions
sampled at every eighth place. All windows of the benchmark are searched
backwards together; occurrences are located by walking to a sampled place;
their spans are merged for each document.

The benchmark meets the shards in blocks of about ``BLOCK_WORDS`` window
words: pairs of window and item, dealt by hash, so a window of very many items
is spread over blocks too. Each block is a pass of its own over the documents
with one Python step; what it found is written before the next block is sent,
so driver and workers hold one block at a time however large the benchmark is.
Documents are never shuffled.

Results for odd input: a null or empty text has no words; an item without
words has no windows; windows that several items share count for each; items
with one item_id count as one item, a null item_id as ''; repeated rows get
equal results; extra columns are left out; empty tables are fine.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import free_name, hold, written

WINDOW = 10
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 2_000_000
SAMPLE = 8
_MARK = (b"",)

#: Lower-cases A-Z and turns every byte that is no part of a word into a space.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class WaveletMatrix:
    """Symbols of a sequence, level by level, with ranks."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        for k in range(self.levels - 1, -1, -1):
            b = (seq >> k) & 1
            packed = np.packbits(b.astype("u1"), bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, "u1")]).view("<u8")
            before = np.zeros(len(packed) + 1, "i4")
            np.cumsum(np.bitwise_count(packed), out=before[1:])
            self.bits.append(packed)
            self.before.append(before)
            self.zeros.append(int(len(seq) - b.sum()))
            seq = np.concatenate([seq[b == 0], seq[b == 1]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype("u8")) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.bits[level][word] & mask).astype("i8")

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place, plus the symbol's start in the last level."""
        for level in range(self.levels):
            one = (symbol >> (self.levels - 1 - level)) & 1
            ones = self._ones(level, at)
            at = np.where(one == 1, self.zeros[level] + ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its rank there."""
        symbol = np.zeros(len(at), "i8")
        for level in range(self.levels):
            bit = (self.bits[level][at >> 6] >> (at & 63).astype("u8")).astype("i8") & 1
            ones = self._ones(level, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            symbol = symbol << 1 | bit
        return symbol, at


class FMIndex:
    """Self-index of runs of symbols (1 .. sigma-1), each closed by a 0."""

    def __init__(self, seq: np.ndarray, sigma: int):
        n = len(seq)
        ends = seq == 0
        rank = np.where(ends, np.cumsum(ends) - 1, seq + int(ends.sum())).astype("i8")
        step = 1
        while True:  # prefix doubling; the closing marks differ, so this ends within the longest run
            nxt = np.zeros(n, "i8")
            nxt[:-step] = rank[step:] + 1
            key = rank * (int(rank.max()) + 2) + nxt
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(n, "i8")
            rank[order] = fresh
            if fresh[-1] == n - 1:
                break
            step *= 2
            if step >= n:
                break
        bwt = seq[order - 1]  # before the first place stands the last mark
        self.wavelet = WaveletMatrix(bwt, sigma)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=sigma))])
        self.base = self.wavelet.rank(np.arange(sigma), np.zeros(sigma, "i8"))
        keep = (order % SAMPLE == 0) | np.concatenate([[True], ends[:-1]])[order]  # every eighth place and each run's first
        packed = np.packbits(keep, bitorder="little")
        self.marked = np.concatenate([packed, np.zeros(16 - len(packed) % 8, "u1")]).view("<u8")
        self.marked_before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marked), dtype="i8")])
        self.sampled = order[keep]
        self.n = n

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.starts[symbol] + self.wavelet.rank(symbol, at) - self.base[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of patterns (rows; 0 pads the left side)."""
        lo, hi = np.zeros(len(patterns), "i8"), np.full(len(patterns), self.n, "i8")
        for k in range(patterns.shape[1] - 1, -1, -1):
            live = np.flatnonzero((patterns[:, k] > 0) & (lo < hi))
            if len(live):
                c = patterns[live, k]
                lo[live], hi[live] = self._step(c, lo[live]), self._step(c, hi[live])
        return lo, hi

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of places in the suffix order."""
        found, steps, todo = np.zeros(len(at), "i8"), np.zeros(len(at), "i8"), np.arange(len(at))
        at = at.copy()
        while len(todo):
            a = at[todo]
            hit = (self.marked[a >> 6] >> (a & 63).astype("u8")).astype("u1") & 1 == 1
            done, x = todo[hit], a[hit]
            mask = (np.uint64(1) << (x & 63).astype("u8")) - np.uint64(1)
            place = self.marked_before[x >> 6] + np.bitwise_count(self.marked[x >> 6] & mask).astype("i8")
            found[done] = self.sampled[place] + steps[done]
            todo = todo[~hit]
            if len(todo):
                c, r = self.wavelet.access(at[todo])
                at[todo] = self.starts[c] + r - self.base[c]
                steps[todo] += 1
        return found


class Windows:
    """A block of benchmark windows as numbers, with the items that have each."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        of: dict[bytes, list[str]] = {}
        for words, item in rows:
            of.setdefault(words, []).append(item)
        split = [w.split(b" ") for w in of]
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({x for s in split for x in s}))}
        self.items = list(of.values())
        self.lengths = np.array([len(s) for s in split], "i8")
        width = int(self.lengths.max())
        self.shortest = int(self.lengths.min())
        self.patterns = np.zeros((len(split), width), "i8")
        for i, s in enumerate(split):
            self.patterns[i, width - len(s):] = [self.vocab[x] for x in s]

    def hits(self, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """For each document of a shard its merged spans (word numbers) and the items found."""
        ids = np.fromiter(map(self.vocab.get, chain.from_iterable(chain(d, _MARK) for d in docs), repeat(0)), "i8", sum(map(len, docs)) + len(docs))
        doc_start = np.concatenate([[0], np.cumsum([len(d) + 1 for d in docs])])
        cuts = np.flatnonzero(ids == 0)  # the last id is the last document's closing mark
        run_start = np.concatenate([[0], cuts[:-1] + 1])
        long = cuts - run_start >= self.shortest
        out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in docs]
        if not long.any():
            return out
        a, z = run_start[long], cuts[long] + 1
        size = z - a
        seq_start = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(seq_start[-1]) + np.repeat(a - seq_start[:-1], size)
        index = FMIndex(ids[place], len(self.vocab) + 1)
        lo, hi = index.search(self.patterns)
        got = np.flatnonzero(hi > lo)
        if not len(got):
            return out
        count = hi[got] - lo[got]
        for at in range(0, len(got), 4096):  # bounded steps: occurrences of some windows at a time
            c = count[at:at + 4096]
            which = np.repeat(got[at:at + 4096], c)
            first = np.cumsum(c) - c
            begin = place[index.locate(np.arange(c.sum()) + np.repeat(lo[got[at:at + 4096]] - first, c))]
            doc = np.searchsorted(doc_start, begin, side="right") - 1
            begin = begin - doc_start[doc]
            for d, b, w in zip(doc.tolist(), begin.tolist(), which.tolist()):
                out[d][0].append((b, b + int(self.lengths[w])))
                out[d][1].update(self.items[w])
        return [(merge(s), i) for s, i in out]


def merge(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap made one."""
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, item): every different window (words joined by spaces) of each item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, out = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(t)
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    names.append(i)
                    out.append(b" ".join(words[at:at + window]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(out, pa.binary())], ["item", "words"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string"))
    return items.mapInArrow(run, "item string, words binary").select("words", "item").distinct()


def _blocks(windows: DataFrame, words: int) -> Iterator[tuple[list, bool]]:
    """The windows in blocks of about ``words`` words, dealt by hash and read one after the other, each with whether it is the last.

    There is always one, of no rows if there are no windows.
    """
    windows = written(windows, "benchmark-windows")
    total = windows.agg(F.sum(F.size(F.split(F.col("words").cast("string"), " ")) + 1)).first()[0] or 0
    n = max(1, -(-total // words))
    for k in range(n):
        own = windows.where(F.pmod(F.xxhash64("words", "item"), F.lit(n)) == k)
        yield [(bytes(r["words"]), r["item"]) for r in own.collect()], k == n - 1


def with_leaks(docs: DataFrame, benchmark: DataFrame, name: str, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with a struct ``name`` (n_words, spans, items) of each text.

    spans: array of (start, end) word numbers, merged, in order; items: the
    ids, as strings, of benchmark items with a window in the text. Each block
    of the benchmark is a pass over the texts that adds to what the passes
    before have found; passes but the last are written.
    """
    spark, text = docs.sparkSession, F.col("text").cast("string")
    kind = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"

    def step(rows: list, before: Column | None) -> tuple:
        sent, key = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

        def search(texts: pd.Series, old: pd.DataFrame | None = None) -> pd.DataFrame:
            block = hold(("windows", key), lambda: Windows(sent.value) if sent.value else None)
            n_words, spans, items, words, size = [], [], [], [], 0

            def shard() -> None:
                hits = block.hits(words) if block else [([], set())] * len(words)
                at = len(n_words)
                for k, (new, more) in enumerate(hits):
                    n_words.append(len(words[k]))
                    seen = [(s["start"], s["end"]) for s in old["spans"].iloc[at + k]] if old is not None else []
                    spans.append([{"start": a, "end": z} for a, z in merge([*seen, *new])])
                    items.append(sorted({*(old["items"].iloc[at + k] if old is not None else ()), *more}))

            for t in texts:
                words.append(words_of(t))
                size += len(words[-1])
                if size >= shard_words:
                    shard()
                    words, size = [], 0
            if words:
                shard()
            return pd.DataFrame({"n_words": pd.Series(n_words, dtype="int64"), "spans": pd.Series(spans, dtype=object), "items": pd.Series(items, dtype=object)})

        if before is None:
            def alone(texts: pd.Series) -> pd.DataFrame:
                return search(texts)
            return F.pandas_udf(alone, kind)(text), sent

        def more(texts: pd.Series, old: pd.DataFrame) -> pd.DataFrame:
            return search(texts, old)
        return F.pandas_udf(more, kind)(text, before), sent

    before = None
    for rows, last in _blocks(benchmark_windows(benchmark, window), block_words):
        found, sent = step(rows, before)
        docs, before = docs.withColumn(name, found), F.col(name)
        if not last:
            docs = written(docs, "leaks")
            sent.unpersist()
    return docs


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, spans, items) of every row of ``docs``: see ``with_leaks``."""
    found = with_leaks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, "f", **options)
    return found.select("doc_id", "f.n_words", "f.spans", "f.items")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with every occurrence of a benchmark window cut out of ``text``."""
    name = free_name(docs, "leaks")
    found = with_leaks(docs, benchmark, name, **options)
    cut = F.when(F.size(F.col(f"{name}.spans")) > 0, removed(F.col("text"), F.col(f"{name}.spans"))).otherwise(F.col("text"))
    return found.withColumn("text", cut).drop(name)


def removed(text: Column, spans: Column) -> Column:
    """The text without the words of the spans (and the marks between them). Other text is kept as it is."""

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

        def one(t, s):
            if t is None or s is None or not len(s):
                return t
            low = t.translate({c: c + 32 for c in range(0x41, 0x5B)})
            at = [m.span() for m in word.finditer(low)]
            out, done = [], 0
            for x in s:
                out.append(t[done:at[x["start"]][0]])
                done = at[x["end"] - 1][1]
            return "".join([*out, t[done:]])

        return pd.Series([one(t, s) for t, s in zip(texts, spans)], dtype=object)

    return F.pandas_udf(cut, "string")(text, spans)


def items_digest(items: Column) -> Column:
    """Lowercase hex SHA-256 of the ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.sort_array(items), ","), 256)


def brute_force(text: str | None, items: list[tuple[str, str | None]], window: int = WINDOW) -> tuple[int, int, int, str]:
    """(n_words, n_hit, n_items, items_sha256) by direct comparison, for tests."""
    words = words_of(text)
    hit, got = set(), set()
    for name, t in items:
        own = words_of(t)
        for at in range(max(1, len(own) - window + 1) if own else 0):
            w = own[at:at + window]
            for k in range(len(words) - len(w) + 1):
                if words[k:k + len(w)] == w:
                    hit.update(range(k, k + len(w)))
                    got.add(name)
    return len(words), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest()
