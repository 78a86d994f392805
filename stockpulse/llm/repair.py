"""Conversation structure repair with Four-Russians block tables.

A conversation is a word over ten symbols: a row's role initial (s, u, a or
another) with or without a truncated text, a row that has to go (blank or
duplicate), and padding. It is edited into the language ``(s?(ua)+)?`` at
least cost. The dynamic programme keeps, between two rows, a vector of the
costs still to come from each of the automaton's four states. Since a row can
be inserted anywhere, the entries of a vector differ by a small constant at
most, so vectors less their minimum (normalised ones) are finitely many. For
every one of them and every block of ``BLOCK`` symbols a table has the vector
before the block and what the minimum grew by. A conversation is processed
block by block from its end by lookup, keeping one vector number for each
block; then it is traced from its start: each block is expanded backward from
the vector behind it, and of the edits on a cheapest way the ASCII-least
letter is taken each time, which gives the least of all cheapest audits.

Spark deals the work: duplicates are found by a grouped minimum over hashes
and a join (both split within a conversation); rows of one symbol each then
meet by conversation, streamed in order of turn, and the texts meet the audit
in a second stream. A task holds one conversation's symbols and audit, a byte
for each row (an audit is one cell of the result), never its texts.

Results for odd input: a null role or text is one space (so is a null conv_id
or turn in the string that decides the damage); turns go in order, nulls
first, ties by role, then by hash of the text; repeated rows are rows of their
own and, but for the first, duplicates; rows with a null conv_id are one
conversation with that id; extra columns are left out; a conversation that
the damage leaves without rows has zeros, an empty audit and the digest of
the empty string; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import hold, written

BLOCK = 4
RETYPE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a. The u or a that may follow leads to:
_AFTER = (2, 2, 3, 2)
#: What is still to be inserted at the end, from each state.
_TAIL = (0, 2, 1, 0)
_ROLE_OF = {2: "user", 3: "assistant"}
#: Symbols: initial x 2 + (1 if truncated); GONE has to be deleted, PAD is no row.
_INITIAL = {"s": 0, "u": 1, "a": 2}
GONE, PAD, SYMBOLS = 8, 9, 10
_BLANKS = "[^\\x20\\x09-\\x0D]"


def _edits(symbol: int, q: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of every edit of a row with this symbol in state q, insertions left out, in ASCII order."""
    out = [("D", DELETE, q)]
    if symbol != GONE:
        initial, late = symbol >> 1, CUT_SHORT * (symbol & 1)
        if initial == 0 and q == 0:
            out.append(("K", late, 1))
        elif initial == _AFTER[q] - 1:
            out.append(("K", late, _AFTER[q]))
        out.append(("R", RETYPE + late, _AFTER[q]))
    return out


def _before(symbol: int, later: tuple) -> tuple:
    """Costs to come before a row from those after it."""
    if symbol == PAD:
        return later
    g = [min(c + later[z] for _, c, z in _edits(symbol, q)) for q in range(4)]
    u, a = min(g[2], g[3] + INSERT), min(g[3], g[2] + INSERT)
    return min(g[0], u + INSERT), min(g[1], u + INSERT), u, a


class BlockTables:
    """Transitions of all normalised vectors by all blocks of symbols."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = tuple(INSERT * k for k in _TAIL)
        number, self.vectors, one, grown = {end: 0}, [end], [], []
        for v in self.vectors:
            row = []
            for s in range(SYMBOLS):
                w = _before(s, v)
                low = min(w)
                w = tuple(x - low for x in w)
                if w not in number:
                    number[w] = len(self.vectors)
                    self.vectors.append(w)
                row.append((number[w], low))
            one.append([x for x, _ in row])
            grown.append([x for _, x in row])
        step, cost = np.array(one, "i4"), np.array(grown, "i4")
        # a block's symbols are digits, the first one leading; the last one acts first
        self.to, self.cost = step, cost
        for _ in range(block - 1):
            far, dear = step[self.to], cost[self.to]
            self.cost = (self.cost[:, :, None] + dear).transpose(0, 2, 1).reshape(len(step), -1)
            self.to = far.transpose(0, 2, 1).reshape(len(step), -1)
        self._traced: dict = {}

    def codes(self, symbols: bytes | bytearray) -> np.ndarray:
        s = np.frombuffer(bytes(symbols), "u1").astype("i8")
        s = np.concatenate([s, np.full(-len(s) % self.block, PAD)]).reshape(-1, self.block)
        return s @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))

    def trace(self, code: int, after: int, q: int) -> tuple[str, int]:
        """The least audit of a block from state q, given the vector behind it, and the state it ends in."""
        if (got := self._traced.get((code, after, q))) is not None:
            return got
        start = q
        symbols = [code // SYMBOLS ** k % SYMBOLS for k in range(self.block - 1, -1, -1)]
        costs = [self.vectors[after]]
        for s in reversed(symbols):
            costs.append(_before(s, costs[-1]))
        costs.reverse()
        audit = ""
        for s, now, later in zip(symbols, costs, costs[1:]):
            while s != PAD:
                ways = [(letter, c + later[z], z) for letter, c, z in _edits(s, q)] + [("I", INSERT + now[_AFTER[q]], _AFTER[q])]
                letter, _, q = min(w for w in ways if w[1] == now[q])
                audit += letter
                if letter != "I":
                    break
        self._traced[code, after, start] = audit, q
        return audit, q

    def repair(self, symbols: bytes | bytearray) -> tuple[int, str]:
        """Least cost and least cheapest audit of a conversation."""
        codes, at, cost = self.codes(symbols).tolist(), 0, 0
        behind = np.zeros(len(codes), "i4")
        to, dear = self.to, self.cost
        for k in range(len(codes) - 1, -1, -1):
            behind[k] = at
            cost += int(dear[at, codes[k]])
            at = int(to[at, codes[k]])
        cost += self.vectors[at][0]
        parts, q = [], 0
        for code, v in zip(codes, behind.tolist()):
            letters, q = self.trace(code, v, q)
            parts.append(letters)
        return cost, "".join(parts) + "I" * _TAIL[q]


def tables(block: int = BLOCK) -> BlockTables:
    return hold(("repair", block), lambda: BlockTables(block))


def _plain(turns: DataFrame) -> DataFrame:
    space = F.lit(" ")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after damage by the crc32 of ``conv_id:turn``; a dropped row has 0 copies."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return _plain(turns).withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("kind") == 0, F.lit(0)).when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"))


def undamaged(turns: DataFrame) -> DataFrame:
    """Rows as they are, in the form of ``damage``."""
    return _plain(turns).withColumn("copies", F.lit(1).cast("long"))


def _hashes() -> list[Column]:
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.col("text")).alias("h2")]


def symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h1, h2, symbol, copies): equal rows of a turn once, with the symbol of the first of them.

    All further copies have to go. A row is first if no earlier turn of its
    conversation has its role and text.
    """
    there = F.col("copies") > 0
    blank = ~F.col("text").rlike(_BLANKS)
    cut_short = ~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    slim = rows.select("conv_id", F.when(there, F.col("turn")).alias("turn"), F.when(there, F.col("role")).otherwise(F.lit("")).alias("role"),
                       *[F.when(there, h).otherwise(F.lit(0)).alias(n) for n, h in zip(("h1", "h2"), _hashes())],
                       F.when(~there, F.lit(0)).when(blank, F.lit(2)).when(cut_short, F.lit(1)).otherwise(F.lit(0)).alias("state"), "copies")
    slim = slim.groupBy("conv_id", "turn", "role", "h1", "h2", "state").agg(F.sum("copies").alias("copies"))
    slim = written(slim, "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = slim.where("copies > 0").groupBy("conv_id", "role", "h1", "h2").agg(F.min(place).alias("first")) \
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h1").alias("f1"), F.col("h2").alias("f2"), "first")
    met = slim.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")), "left")
    initial = F.substring("role", 1, 1)
    number = F.lit(3)
    for letter, k in _INITIAL.items():
        number = F.when(initial == letter, F.lit(k)).otherwise(number)
    first = place.eqNullSafe(F.col("first"))
    # state 2: blank rows, all of them; else the first row has its own symbol and the rest have to go
    return met.select("conv_id", "turn", "role", "h1", "h2", "state", "copies", initial.alias("initial"),
                      F.when((F.col("state") < 2) & first, number * 2 + F.col("state")).otherwise(F.lit(GONE)).alias("symbol"))


_AUDITS = "conv_id long, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Faults, least cost and audit of every conversation of ``damage``'s rows."""
    kinds = [pa.int64()] * 8 + [pa.string()]
    names = [c.split()[0] for c in _AUDITS.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, done, now, s = tables(block), [], object(), None

        def close() -> None:
            if s is None:
                return
            cost, audit = table.repair(s["word"])
            span = 0 if s["least"] is None else s["most"] - s["least"] + 1 - s["turns"]
            done.append((now, len(s["word"]), span, s["blank"], s["duplicate"], s["truncated"], s["illegal"], cost, audit))

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names)

        for b in batches:
            for conv, turn, initial, state, symbol, copies in zip(*(x.to_pylist() for x in b.columns)):
                if s is None or conv != now:
                    close()
                    now, s = conv, {"word": bytearray(), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "least": None, "most": None, "turns": 0, "last": None}
                if not copies:
                    continue
                if s["last"] is not None and s["last"] + initial not in ("su", "ua", "au"):
                    s["illegal"] += 1
                s["illegal"] += copies - 1
                s["last"] = initial
                if turn is not None:
                    s["turns"] += turn != s["most"]
                    s["least"], s["most"] = turn if s["least"] is None else s["least"], turn
                s["word"].append(symbol)
                s["word"].extend(bytes([GONE]) * (copies - 1))
                if state == 2:
                    s["blank"] += copies
                else:
                    s["duplicate"] += copies - (symbol != GONE)
                    s["truncated"] += symbol != GONE and state == 1
            if len(done) >= 2000:
                yield batch()
                done = []
        close()
        if done:
            yield batch()

    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return symbols(rows).repartition(n, "conv_id") \
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "h1", "h2") \
        .select("conv_id", "turn", "initial", "state", "symbol", "copies").mapInArrow(run, _AUDITS)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the rows that the audits leave or insert, in order.

    Texts stream past the audit of their conversation, which comes first.
    """
    return _streamed(rows, found).mapInArrow(_rows, "conv_id long, position long, edit string, role string, text string")


def _streamed(rows: DataFrame, found: DataFrame) -> DataFrame:
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = rows.where("copies > 0").select("conv_id", F.lit(1).alias("part"), "turn", "role", *_hashes(), "text", "copies")
    heads = found.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    return heads.union(texts).repartition(n, "conv_id") \
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", F.col("turn").asc_nulls_first(), "role", "h1", "h2") \
        .select("conv_id", "part", "role", "text", "copies")


def _applied(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, edit, role, text) of all rows that stay or come in, and (conv_id, None, None, None) where a conversation starts."""
    now, audit, at, q = None, "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, q
        while at < len(audit) and audit[at] == "I":
            q, at = _AFTER[q], at + 1
            yield now, "I", _ROLE_OF[q], ""

    for b in batches:
        for conv, part, role, text, copies in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), b.column(4).to_pylist()):
            if not part:
                yield from inserted()
                now, audit, at, q = conv, text.as_py(), 0, 0
                yield now, None, None, None
            for _ in range(copies):
                yield from inserted()
                edit, at = audit[at], at + 1
                if edit == "K":
                    q = 1 if role[:1] == "s" else _AFTER[q]
                    yield now, edit, role, text.as_py()
                elif edit == "R":
                    q = _AFTER[q]
                    yield now, edit, _ROLE_OF[q], text.as_py()
    yield from inserted()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, names = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()], ["conv_id", "position", "edit", "role", "text"]
    done, size, at = [], 0, 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names)

    for conv, edit, role, text in _applied(batches):
        if edit is None:
            at = 0
            continue
        done.append((conv, at, edit, role, text))
        at, size = at + 1, size + len(text) + 64
        if size > 4_000_000:
            yield batch()
            done, size = [], 0
    if done:
        yield batch()


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, n_repaired, repaired_sha256) of each conversation: digest of its repaired ``role:text``, newline-joined."""
    kinds, names = [pa.int64(), pa.int64(), pa.string()], ["conv_id", "n_repaired", "repaired_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, state = [], None, None

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names)

        for conv, edit, role, text in _applied(batches):
            if edit is None:
                if state:
                    done.append((now, state[0], state[1].hexdigest()))
                if len(done) >= 2000:
                    yield batch()
                    done = []
                now, state = conv, [0, hashlib.sha256()]
                continue
            state[1].update(f"{chr(10) if state[0] else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            state[0] += 1
        if state:
            done.append((now, state[0], state[1].hexdigest()))
        if done:
            yield batch()

    return _streamed(rows, found).mapInArrow(run, "conv_id long, n_repaired long, repaired_sha256 string")


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Faults, cost, audit and digest of the repaired rows for each conversation of ``rows`` (as ``damage`` gives them)."""
    found = written(audits(rows, block), "repair-audits")
    made = repaired_digests(rows, found).select(F.col("conv_id").alias("c"), "n_repaired", "repaired_sha256")
    return found.join(made, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
