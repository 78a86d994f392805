"""Encoding of whole texts with a public byte-level BPE tokenizer."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import bound_batches, hold, written

#: Entries of an encoder's word cache: beyond them only the half used last stays.
CACHE_WORDS = 800_000

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Where a space may stand at another white space or at an end.
_ODD = r"  | \n|\n |\A | \z|[\t\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_SOLID = re.compile(r"\S+").fullmatch
_LINES = re.compile(r"\S+(?:\n\S+)+").fullmatch
_ENDED = re.compile(r"(\S*[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F])([!-&(-/:-@\[-`{-~]+)").fullmatch
#: How a byte-level vocabulary writes a space.
_SPACE = "\u0120"


def _parts(piece: str) -> tuple[str, ...]:
    """A piece cut at its line ends and before the punctuation that ends a line."""
    if "\n" not in piece:
        m = _ENDED(piece)
        return m.groups() if m else (piece,)
    if not _LINES(piece):
        return (piece,)
    out: list[str] = []
    for line in piece.split("\n"):
        m = _ENDED(line)
        out += m.groups() if m else (line,)
        out.append("\n")
    return tuple(out[:-1])


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts as bytes of little-endian unsigned 32-bit integers.

    A byte-level BPE pre-tokenizer never joins a character with a space after
    it, so a text may be cut before any lone space between two other
    characters: the ids of the pieces, joined, are the ids of the text. A
    piece is cut further at a single line end between two other characters,
    and between a letter and the punctuation that ends a line or the piece
    (apostrophes aside). Each different part is encoded once by the
    tokenizers library and kept. Strings of special tokens in a text are
    ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.line_end, = self.tokenizer.encode("\n", add_special_tokens=False).ids
        vocab = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        self.spaced[[i for t, i in vocab.items() if t[:1] == _SPACE]] = True
        #: Pieces behind a space, their ids, and the call that last used each; parts behind something else.
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used, self.now = np.zeros(0, "i8"), 0
        self.first: dict[str, bytes] = {}

    def _learn(self, parts: set[str], cache: dict[str, bytes], lead: str) -> None:
        plain = list(filter(_SOLID, parts))
        for at in range(0, len(plain), 10_000):
            runs = [plain[k:k + 500] for k in range(at, min(at + 10_000, len(plain)), 500)]
            # one call for many parts: those behind a space begin with a token that does, others follow a line end, a token of its own
            texts = [lead + lead.join(run) if lead else "\n".join(run) for run in runs]
            for run, e in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                if lead:
                    begins = np.flatnonzero(self.spaced[ids])
                    ends = np.append(begins[1:], len(ids))
                else:
                    ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
                    begins = np.append(0, ends[:-1] + 1)
                if len(begins) != len(run) or begins[0] != 0:
                    raise ValueError("the tokenizer joins spaces or line ends with other text")
                data = ids.tobytes()
                cache.update(zip(run, [data[a:z] for a, z in zip((4 * begins).tolist(), (4 * ends).tolist())]))
        todo = list(parts - cache.keys())
        for at in range(0, len(todo), 20_000):
            some = todo[at:at + 20_000]
            for w, e in zip(some, self.tokenizer.encode_batch_fast([lead + w for w in some], add_special_tokens=False)):
                cache[w] = np.array(e.ids, "<u4").tobytes()

    def _rows(self, pieces: pa.Array) -> np.ndarray:
        """Each piece's row in the cache (-1: none); rows found count as used now."""
        at = pc.index_in(pieces, self.words).fill_null(-1).to_numpy()
        self.used[at[at >= 0]] = self.now
        return at

    def _add(self, new: pa.Array) -> None:
        """Put different pieces, each behind a space, into the cache."""
        # most pieces are letters alone and have no parts
        alone = pc.utf8_is_alpha(new)
        words, pieces = new.filter(alone).to_pylist(), new.filter(pc.invert(alone)).to_pylist()
        cut = list(map(_parts, pieces))
        begins = pa.array({c[0] for c in cut}.difference(words), pa.large_string())
        rows = self._rows(begins)
        got: dict[str, bytes] = {}
        self._learn({*words, *begins.filter(pa.array(rows < 0)).to_pylist()}, got, " ")
        self._learn({x for c in cut for x in c[1:]} - self.first.keys(), self.first, "")
        known = dict(zip(begins.filter(pa.array(rows >= 0)).to_pylist(), self.ids.take(pa.array(rows[rows >= 0])).to_pylist()))
        get = self.first.__getitem__
        longer = {p: (got[c[0]] if c[0] in got else known[c[0]]) + b"".join(map(get, c[1:])) for p, c in zip(pieces, cut) if len(c) > 1}
        self.words = pa.concat_arrays([self.words, pa.array([*got, *longer], pa.large_string())])
        self.ids = pa.concat_arrays([self.ids, pa.array([*got.values(), *longer.values()], pa.large_binary())])
        self.used = np.append(self.used, np.full(len(self.words) - len(self.used), self.now, "i8"))

    def _heads(self, heads: list[str]) -> list[bytes]:
        """Ids of pieces that no space comes before."""
        cut = list(map(_parts, heads))
        self._learn(set().union(*cut) - self.first.keys(), self.first, "")
        return [b"".join([self.first[x] for x in c]) for c in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        self.now += 1
        if len(self.words) > CACHE_WORDS:
            keep = pa.array(np.sort(np.argpartition(-self.used, CACHE_WORDS // 2)[:CACHE_WORDS // 2]))
            self.words, self.ids, self.used = self.words.take(keep), self.ids.take(keep), self.used[keep]
        if len(self.first) > CACHE_WORDS // 4:
            self.first.clear()
        plain = pa.array([t if t else "" for t in texts], pa.large_string())
        odd = np.flatnonzero(pc.match_substring_regex(plain, _ODD).to_numpy(zero_copy_only=False)).tolist()
        lists = pc.split_pattern(plain, " ")
        if odd:
            mask = np.zeros(len(texts), bool)
            mask[odd] = True
            order = np.empty(len(texts), "i8")
            order[~mask] = np.arange(len(texts) - len(odd))
            order[mask] = np.arange(len(texts) - len(odd), len(texts))
            lists = pa.concat_arrays([lists.filter(pa.array(~mask)), pa.array([_LONE_SPACE.split(texts[i]) for i in odd], lists.type)]).take(pa.array(order))
        bounds = lists.offsets.to_numpy().astype("i8")
        bounds -= bounds[0]
        pieces = lists.flatten()
        behind = np.ones(len(pieces), bool)
        behind[bounds[:-1]] = False
        heads = pieces.filter(pa.array(~behind)).dictionary_encode()
        at = self._rows(pieces).astype("i4")
        late = np.flatnonzero((at < 0) & behind)
        if len(late):
            some, known = pieces.take(pa.array(late)), len(self.words)
            self._add(some.unique())
            at[late] = pc.index_in(some, self.words[known:]).to_numpy() + known
        at[bounds[:-1]] = heads.indices.to_numpy() + len(self.ids)
        every = pa.concat_arrays([self.ids, pa.array(self._heads(heads.dictionary.to_pylist()), pa.large_binary())])
        ids = every.take(pa.array(at))
        data, ends = memoryview(ids.buffers()[2] or b""), np.frombuffer(ids.buffers()[1], "i8", len(ids) + 1)[bounds].tolist()
        return [bytes(data[a:z]) for a, z in zip(ends, ends[1:])]


def encoder(path: str | None) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    path = path or default_tokenizer()
    return hold(("encoder", path), lambda: Encoder(path))


def slices(texts: pa.Array, limit: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """Cut a column of texts (null: empty) into runs of about ``limit`` characters: (first row, texts)."""
    at, size, run = 0, 0, []
    for i, t in enumerate(texts):
        t = t.as_py() or ""
        run.append(t)
        size += len(t)
        if size >= limit:
            yield at, run
            at, size, run = i + 1, 0, []
    if run:
        yield at, run


def token_batches(batches: Iterable[pa.RecordBatch], end_id: int, tokenizer: str | None) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, text) of a partition as (doc_id, part, local_start, n_tokens, ids)."""
    end, enc, part, start = np.array([end_id], "<u4").tobytes(), encoder(tokenizer), TaskContext.get().partitionId(), 0
    for b in batches:
        for at, texts in slices(b.column(1), 8_000_000):
            ids = [x + end for x in enc.encode(texts)]
            n = np.array([len(x) // 4 for x in ids], "int64")
            before = start + np.cumsum(n) - n
            start += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(at, len(texts)), pa.array(np.full(len(n), part, "int32")), pa.array(before), pa.array(n), pa.array(ids, pa.binary())],
                ["doc_id", "part", "local_start", "n_tokens", "ids"])
        pa.default_memory_pool().release_unused()


def token_table(docs: DataFrame, end_id: int, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, part, local_start, n_tokens, ids) of every document, each text encoded once.

    ``ids``: little-endian unsigned 32-bit ids of the whole text (null:
    empty), then ``end_id``. ``local_start``: the ids that this partition has
    before the document. The rows are written to the shared folder, so part
    and local_start are fixed from then on.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lambda batches: token_batches(batches, end_id, tokenizer), "doc_id long, part int, local_start long, n_tokens long, ids binary")
    return written(rows, "tokens", compression="zstd")
