"""N-gram language model in an Elias-Fano trie.

Level one has the words (by 64-bit hash, in order) and their exact counts, as
the differences of a monotone list of pointers into all training tokens. Level
two has, for each word as context, the words that follow it, as values
``context * V + word`` of one monotone list, their counts as pointers like
level one's, and their smoothed probabilities in 8 bits. Each further level up
to ``ORDER`` has the same lists, its contexts being places in the level
before, so a search goes from child range to child range; its probabilities
are worked out from the counts. All levels are cut into shards, files in the shared folder that
workers memory-map; a query is a successor search within its context.

Shards of level two are cut on the axis of training tokens: the bigram (a, b)
lies at cum(a) + c(a) * cum(b) / N, where cum(x) is the number of tokens of
words before x. So shards are even, and the followers of a word that is a
twentieth of all tokens spread over a twentieth of the shards. Further levels
are cut alike, on the axis of the level before. Counting passes
send each shard one packed record of different n-grams from each few million
tokens: what is shuffled follows the input, and hot n-grams are one entry in
each record.

    p(w)     = c(w) / N * (1 - u), u = share of tokens whose word occurs once;
               a word that training lacks: u (all such words are one class)
    p(w | a) = (c(a w) + K p(w)) / (c(a) + K); the class of unknown words as
               context says nothing
    p(w | .. a b) = (c(.. a b w) + K p(w | a b)) / (c(.. a b) + K), and so on
               for each longer context seen in training; else as the shorter

The first word of a document follows the end of one; no context reaches
further back than that end. ``score`` is that of the bigrams, ``order_score``
that of the longest contexts. Results for odd input: a
null or empty text is its end token alone; repeated rows get equal results
(and count as often as they come); a null doc_id is held out; extra columns
are left out; without training documents every probability is 1.
"""

from __future__ import annotations

import functools
import math
import mmap
import struct
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import fold, scratch_path
from stockpulse.llm.elias_fano import EliasFano

FOLDS = 10
#: Words of the longest n-grams (2 or more).
ORDER = 3
#: Weight of the lower order, in tokens.
K = 5.0
#: Tokens that a task counts or looks up at a time; bounds a worker's memory, changes no result.
ROUND = 2_000_000
#: Bytes of text whose words are hashed at a time.
_BLOCK = 4_000_000
#: Bytes of a word that are hashed by steps over all words; a longer one is hashed by itself.
_LONG = 64
_U8 = struct.Struct("<QQ")
_STEP = 1 / 16

END = xxhash.xxh64_intdigest(b"")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], "u8")


def _mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit integers."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``data`` begin, and a 64-bit hash of each, A-Z as a-z; eight bytes of every word at a step."""
    data = data.lower()
    buf = np.frombuffer(data + b" " * 8, "u1")
    gap = _SPACE[buf[:len(data) + 1]]
    edges = np.flatnonzero(np.diff(gap, prepend=True))
    starts, size = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return starts, np.zeros(0, "u8")
    eights = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    h = _mix(size.astype("u8"))
    some = np.flatnonzero(size <= _LONG)
    for at in range(0, _LONG, 8):
        some = some[size[some] > at] if at else some
        if not len(some):
            break
        h[some] = _mix(h[some] ^ (eights[starts[some] + at] & _MASKS[np.minimum(size[some] - at, 8)]))
    for k in np.flatnonzero(size > _LONG).tolist():
        h[k] = xxhash.xxh64_intdigest(data[starts[k]:starts[k] + size[k]])
    return starts, h


def _rounds(batches: Iterable[pa.RecordBatch], texts_at: int, keep=None) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Runs of documents: (their batch and row), word hashes of all with an end after each, lengths with the end."""
    rows, parts, lengths, size = [], [], [], 0
    block: list[bytes] = []

    def hashed() -> int:
        """Hash the documents that wait in ``block``; the tokens they have."""
        # every text has a line end behind it, which belongs to no word
        ends = np.cumsum([len(t) + 1 for t in block])
        starts, h = word_hashes(b"\n".join(block))
        doc = np.searchsorted(ends, starts, side="right")
        out = np.full(len(h) + len(block), END, "u8")
        out[np.arange(len(h)) + doc] = h
        parts.append(out)
        lengths.append(np.bincount(doc, minlength=len(block)) + 1)
        block.clear()
        return len(out)

    waiting = 0
    for k, b in enumerate(batches):
        for i, t in enumerate(b.column(texts_at).cast(pa.binary())):
            block.append(t.as_py() or b"")
            rows.append((k, i))
            if keep is not None:
                keep.append(tuple(c[i].as_py() for n, c in enumerate(b.columns) if n != texts_at))
            waiting += len(block[-1]) + 1
            if waiting >= _BLOCK:
                size, waiting = size + hashed(), 0
            if size >= ROUND:
                yield rows, np.concatenate(parts), np.concatenate(lengths)
                rows, size = [], 0
                parts.clear()
                lengths.clear()
    if block:
        hashed()
    if rows:
        yield rows, np.concatenate(parts), np.concatenate(lengths)


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    ef = EliasFano.encode(keys - keys[0])
    return _U8.pack(int(keys[0]), len(ef)) + ef + pa.compress(counts.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    base, size = _U8.unpack_from(data)
    keys = EliasFano(data[_U8.size:_U8.size + size]).all() + np.uint64(base)
    return keys, np.frombuffer(pa.decompress(data[_U8.size + size:], decompressed_size=4 * len(keys), codec="zstd", asbytes=True), "<u4").astype("i8")


def _records(shards: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packed record for each shard."""
    if len(shards) and (np.diff(shards) < 0).any():
        order = np.argsort(shards, kind="stable")
        shards, keys, counts = shards[order], keys[order], counts[order]
    cut = np.flatnonzero(np.diff(shards, prepend=-1, append=-1) != 0)
    some = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
    for at in range(0, len(some), 64):
        part = some[at:at + 64]
        yield pa.RecordBatch.from_arrays([pa.array([int(shards[a]) for a, _ in part], pa.int32()), pa.array([_pack(keys[a:z], counts[a:z]) for a, z in part], pa.binary())], ["shard", "record"])


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _save(path: str, data: bytes) -> None:
    """Write under a name of this attempt's own, then move: a second attempt or a lost executor leaves no half a file."""
    import uuid
    store, at = _open(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    own = f"{at}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, at)


def _map(path: str) -> np.ndarray:
    """The file's bytes, memory-mapped (a file of a remote store by way of an unnamed local one)."""
    from pyarrow import fs
    store, at = _open(path)
    if isinstance(store, fs.LocalFileSystem):
        with open(at, "rb") as f:
            return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), "u1")
    with tempfile.TemporaryFile() as f, store.open_input_stream(at) as src:
        while chunk := src.read(1 << 22):
            f.write(chunk)
        f.flush()
        return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), "u1")


def _lists(path: str, n: int) -> list:
    """The first ``n`` parts of a shard file, and the bytes that follow."""
    data = _map(path)
    sizes = np.frombuffer(bytes(data[:8 * n]), "<u8").tolist()
    out, at = [], 8 * n
    for s in sizes:
        out.append(data[at:at + s])
        at += s
    return out


def _file(parts: list[bytes]) -> bytes:
    parts = [p + b"\0" * (-len(p) % 8) for p in parts]
    return np.array([len(p) for p in parts], "<u8").tobytes() + b"".join(parts)


class Words:
    """Level one: ranks, counts and cumulative counts of words by hash."""

    def __init__(self, shards: int, manifest: list[tuple[int, str, int, int, int]]):
        self.shards = shards
        by = {m[0]: m for m in manifest}
        self.paths = [by[s][1] if s in by else None for s in range(shards)]
        self.base = np.concatenate([[0], np.cumsum([by[s][2] if s in by else 0 for s in range(shards)])]).astype("i8")
        self.tokens = np.concatenate([[0], np.cumsum([by[s][3] if s in by else 0 for s in range(shards)])]).astype("i8")
        self.V, self.N, self.once = int(self.base[-1]), int(self.tokens[-1]), sum(m[4] for m in manifest)
        self.unknown = min(0.5, max(self.once, 0.1) / self.N) if self.N else 1.0
        self.opened: dict[int, tuple[EliasFano, EliasFano]] = {}

    def _shard(self, s: int) -> tuple[EliasFano, EliasFano]:
        if s not in self.opened:
            self.opened[s] = tuple(map(EliasFano, _lists(self.paths[s], 2)))
        return self.opened[s]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of sorted hashes: rank (-1: unknown), count, tokens before."""
        rank = np.full(len(h), -1, "i8")
        at = np.searchsorted(shard_of(h, self.shards), np.arange(self.shards + 1))
        for s, (a, z) in enumerate(zip(at, at[1:])):
            if a < z and self.paths[s]:
                got = self._shard(s)[0].find(h[a:z])
                rank[a:z] = np.where(got >= 0, got + self.base[s], -1)
        return rank, *self.counts(rank)

    def counts(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and tokens before, for ranks (-1: nothing)."""
        count, before = np.zeros(len(rank), "i8"), np.zeros(len(rank), "i8")
        shard = np.searchsorted(self.base, rank, side="right") - 1
        for s in np.unique(shard[rank >= 0]).tolist():
            w = np.flatnonzero((shard == s) & (rank >= 0))
            ends, i = self._shard(s)[1], rank[w] - self.base[s]
            hi = ends.select(i).astype("i8")
            lo = np.where(i > 0, ends.select(np.maximum(i - 1, 0)).astype("i8"), 0)
            count[w], before[w] = hi - lo, lo + self.tokens[s]
        return count, before

    def prob(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, count / max(self.N, 1) * (1 - self.unknown), self.unknown)


def spread(before: np.ndarray, count: np.ndarray, word_before: np.ndarray, words: Words, total: int, shards: int) -> np.ndarray:
    """Shards of n-grams: those of a context lie in its stretch of the level's tokens, in order of their last word."""
    x = (before + count * (word_before / words.N)) / total
    return np.minimum((x * shards).astype("i8"), shards - 1)


class Level:
    """Level two or further: words that follow a context, a place in the level before."""

    def __init__(self, words: Words, manifest: list[tuple[int, str, int, int]], shards: int):
        self.words, self.paths = words, {m[0]: m[1] for m in manifest}
        by = {m[0]: m for m in manifest}
        self.base, self.tokens = (np.concatenate([[0], np.cumsum([by[s][k] if s in by else 0 for s in range(shards)])]).astype("i8") for k in (2, 3))

    def _shard(self, s: int) -> tuple[EliasFano, EliasFano, EliasFano, np.ndarray]:
        """Opened for one search; only the file's pages stay in the system's cache."""
        contexts, follow, ends, probs = _lists(self.paths[s], 4)
        return EliasFano(contexts), EliasFano(follow), EliasFano(ends), probs

    def find(self, shard: np.ndarray, context: np.ndarray, word: np.ndarray, probs: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
        """Place (-1: not seen in training), count, tokens before and, with ``probs``, log10 p(word | context) or nan; sorted by (context, word)."""
        place, count, before = np.full(len(context), -1, "i8"), np.zeros(len(context), "i8"), np.zeros(len(context), "i8")
        out = np.full(len(context), np.nan) if probs else None
        # shards rise with (context, word): one run for each
        cut = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)).tolist()
        for a, z in zip(cut, cut[1:]):
            if (s := int(shard[a])) in self.paths:
                w = np.arange(a, z)
                contexts, follow, ends, codes = self._shard(s)
                first = np.flatnonzero(np.diff(context[w], prepend=-1))
                c = np.repeat(contexts.find(context[w[first]]), np.diff(first, append=len(w)))
                w, c = w[c >= 0], c[c >= 0]
                at = follow.find(joined(c, word[w], self.words.V))
                w, at = w[at >= 0], at[at >= 0]
                lo = np.where(at > 0, ends.select(np.maximum(at - 1, 0)).astype("i8"), 0)
                place[w], count[w], before[w] = at + self.base[s], ends.select(at).astype("i8") - lo, lo + self.tokens[s]
                if probs:
                    out[w] = struct.unpack("<d", bytes(codes[:8]))[0] + _STEP * codes[8:][at]
        return place, count, before, out


def joined(context: np.ndarray, word: np.ndarray, V: int) -> np.ndarray:
    """``context * V + word``, or an error where that is beyond 63 bits (it would wrap without one)."""
    if len(context) and int(context.max()) * V + V > 2 ** 63:
        raise OverflowError(f"place {int(context.max())} with {V} words is beyond 63 bits")
    return context * V + word


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype("i8")


def _merge(records: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in records])
    counts = np.concatenate([c for _, c in records])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _reduced(records: DataFrame, shards: int, build, schema: str) -> list:
    """Merge the records of each shard and build its file; one row of the manifest for each shard."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, got = None, []

        def close() -> pa.RecordBatch:
            row = build(now, *_merge(got))
            return pa.RecordBatch.from_arrays([pa.array([v], pa.string() if isinstance(v, str) else pa.int64()) for v in row], names)

        for b in batches:
            for s, x in zip(b.column(0).to_pylist(), b.column(1)):
                if s != now:
                    if got:
                        yield close()
                    now, got = s, []
                got.append(_unpack(x.as_py()))
                if len(got) > 64:
                    got = [_merge(got)]
        if got:
            yield close()

    dealt = records.repartition(shards, "shard").sortWithinPartitions("shard")
    return [tuple(r) for r in dealt.mapInArrow(run, schema).collect()]


class Model:
    """All levels, as the paths of their shard files: small, and sent to the workers as it is."""

    def __init__(self, shards: int, words: list, levels: list[list], k: float):
        self.shards, self.word_files, self.level_files, self.k = shards, words, levels, k

    def __getstate__(self):
        return {x: v for x, v in self.__dict__.items() if x in ("shards", "word_files", "level_files", "k")}

    @functools.cached_property
    def words(self) -> Words:
        return Words(self.shards, self.word_files)

    @functools.cached_property
    def levels(self) -> list[Level]:
        """From level two on."""
        return [Level(self.words, m, self.shards) for m in self.level_files]

    def coded(self, stream: np.ndarray):
        """Of a stream of hashes: sorted different hashes' (rank, count, before), and each token's place among them."""
        codes, u = pd.factorize(stream)
        order = np.argsort(u)
        place = np.empty(len(u), "i8")
        place[order] = np.arange(len(u))
        return *self.words.find(u[order]), place[codes]

    def pairs(self, stream: np.ndarray):
        """Bigrams of the stream: key and place of those with both words known, and a function from keys to (shard, rank of each word)."""
        rank, count, before, inv = self.coded(stream)
        a, b = inv[:-1], inv[1:]
        known = np.flatnonzero((rank[a] >= 0) & (rank[b] >= 0))

        def places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            u1, u2 = key // len(rank), key % len(rank)
            shard = spread(before[u1], count[u1], before[u2], self.words, self.words.N, self.shards) if len(key) else key
            return shard, rank[u1], rank[u2]

        return a[known] * len(rank) + b[known], known, places, (rank, count, before, inv)

    def longer(self, stream: np.ndarray, level: Level, held: tuple, coded: tuple):
        """Like ``pairs``, for the n-grams whose contexts ``held`` (place, count, before of each token's n-gram in ``level``) has."""
        (place, count, begun), (rank, _, before, inv) = held, coded
        # no context reaches over the end of a document
        known = np.flatnonzero((place[:-1] >= 0) & (stream[1:-1] != END) & (rank[inv[2:]] >= 0)) + 1
        some, first, own = np.unique(place[known - 1], return_index=True, return_inverse=True)
        count, begun, total = count[known[first] - 1], begun[known[first] - 1], int(level.tokens[-1])

        def places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            u, w = key // len(rank), key % len(rank)
            shard = spread(begun[u], count[u], before[w], self.words, total, self.shards) if len(key) else key
            return shard, some[u], rank[w]

        return own * len(rank) + inv[known + 1], known, places

    def held(self, level: Level, n: int, keys: np.ndarray, known: np.ndarray, places, probs: bool = False):
        """Place, count, tokens before (and log10 probability) in ``level`` of each of ``n`` tokens' n-grams."""
        keys, back = np.unique(keys, return_inverse=True)
        found, out = level.find(*places(keys), probs), []
        for x, none in zip(found, (-1, 0, 0, np.nan)):
            if x is not None:
                full = np.full(n, none, x.dtype)
                full[known] = x[back]
                out.append(full)
        return out

    def scores(self, stream: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per document: known tokens, base score, score of the bigrams, score of all levels. ``stream``: an end, then all documents, each with its end."""
        words, n = self.words, len(stream) - 1
        keys, known, places, coded = self.pairs(stream)
        _, count, _, inv = coded
        *held, got = self.held(self.levels[0], n, keys, known, places, probs=True) if self.levels else (*np.zeros((3, n), "i8"), np.full(n, np.nan))
        c1, c2 = count[inv[:-1]], count[inv[1:]]
        low = np.log10(words.prob(c2)) + np.where(c1 > 0, np.log10(self.k / (c1 + self.k)), 0.0)
        token = np.where(np.isnan(got), low, got)
        best = 10.0 ** token
        for shorter, level in zip(self.levels, self.levels[1:]):
            # what follows a context that training has: all places but the first, where the context does not reach over an end
            there = np.flatnonzero((held[0][:-1] >= 0) & (stream[1:-1] != END)) + 1
            seen = held[1][there - 1]
            keys, known, places = self.longer(stream, shorter, held, coded)
            held = self.held(level, n, keys, known, places)
            best[there] = (held[1][there] + self.k * best[there]) / (seen + self.k)
        base = np.log10((c2 + 0.1) / (words.N + 0.1 * (words.V + 1)))
        first = np.cumsum(lengths) - lengths
        return tuple(np.add.reduceat(x, first) for x in ((c2 > 0).astype("i8"), base, token, np.log10(best)))


def _stream(h: np.ndarray) -> np.ndarray:
    return np.concatenate([np.array([END], "u8"), h])


def train(docs: DataFrame, k: float = K, order: int = ORDER) -> Model:
    """Count all rows of ``docs`` (text) and write the trie to the shared folder."""
    spark = docs.sparkSession
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = scratch_path(spark, "ngrams")
    texts = docs.select(F.col("text").cast("string").alias("text"))

    def count_words(batches):
        for _, h, _ in _rounds(batches, 0):
            keys, counts = np.unique(h, return_counts=True)
            yield from _records(shard_of(keys, shards), keys, counts)

    def build_words(s: int, keys: np.ndarray, counts: np.ndarray) -> tuple:
        at = f"{path}/words-{s:06d}"
        _save(at, _file([EliasFano.encode(keys), EliasFano.encode(np.cumsum(counts))]))
        return s, at, len(keys), int(counts.sum()), int((counts == 1).sum())

    words = _reduced(texts.mapInArrow(count_words, "shard int, record binary"), shards, build_words, "shard long, path string, n long, tokens long, once long")
    model = Model(shards, words, [], k)
    if not words:
        return model

    def count_level(batches):
        for _, h, _ in _rounds(batches, 0):
            stream = _stream(h)
            keys, known, places, coded = model.pairs(stream)
            for level in model.levels:
                held = model.held(level, len(h), keys, known, places)
                keys, known, places = model.longer(stream, level, held, coded)
            keys = np.sort(keys)
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            counts = np.diff(first, append=len(keys))
            shard, context, word = places(keys[first])
            yield from _records(shard, joined(context, word, model.words.V).astype("u8"), counts)

    def build_level(s: int, keys: np.ndarray, counts: np.ndarray) -> tuple:
        keys = keys.astype("i8")
        r1, r2 = keys // model.words.V, keys % model.words.V
        contexts, own = np.unique(r1, return_inverse=True)
        codes = b""
        if not model.levels:
            follow, which = np.unique(r2, return_inverse=True)
            c1 = model.words.counts(contexts)[0][own]
            p1 = model.words.prob(model.words.counts(follow)[0])[which]
            logs = np.log10((counts + k * p1) / (c1 + k))
            low = float(logs.min())
            codes = struct.pack("<d", low) + np.minimum(np.round((logs - low) / _STEP), 255).astype("u1").tobytes()
        at = f"{path}/level-{len(model.levels) + 2}-{s:06d}"
        _save(at, _file([EliasFano.encode(contexts), EliasFano.encode(joined(own, r2, model.words.V)), EliasFano.encode(np.cumsum(counts)), codes]))
        return s, at, len(keys), int(counts.sum())

    for _ in range(2, max(2, order) + 1):
        files = _reduced(texts.mapInArrow(count_level, "shard int, record binary"), shards, build_level, "shard long, path string, n long, tokens long")
        if not files:
            break
        model = Model(shards, words, [*model.level_files, files], k)
    return model


def score(model: Model, docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, order_score) of every row of ``docs``."""
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "order_score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        for rows, h, lengths in _rounds(batches, 1, ids):
            known, base, own, longest = model.scores(_stream(h), lengths)
            done, ids[:] = [x[0] for x in ids[:len(rows)]], ids[len(rows):]
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64()), pa.array(lengths.astype("i8")), pa.array(known), pa.array(np.full(len(rows), model.words.N)),
                                              pa.array(base), pa.array(own), pa.array(longest)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, order_score double")


def held_out_scores(docs: DataFrame, folds: int = FOLDS, order: int = ORDER) -> DataFrame:
    """Train on the rows whose fold is not 0 and score all rows."""
    model = train(docs.where(fold(F.col("doc_id"), folds) != 0), order=order)
    return score(model, docs)


def unigram_base(counts: dict[bytes, int], tokens: list[bytes]) -> float:
    """The base score by direct counting, for tests."""
    n, v = sum(counts.values()), len(counts)
    return sum(math.log10((counts.get(t, 0) + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
