"""Chat formatting by token-level assembly.

A turn becomes ``<start> role <sep> text <end>``. Role and text are encoded
as segments of their own and the three marks are spliced in as reserved ids
past the tokenizer's vocabulary, so no text can spell a mark. In the written
form the marks are control strings; inside a role or text, every ``<|`` (with
any number of backslashes between the two) gets one backslash more, which is
undone when reading. Offsets of turns in their conversation and the spans
under the loss mask (the texts of assistant turns, without marks) come from
prefix sums over the segment lengths.

The work is one row per turn from end to end: a conversation is never held
in memory, however many turns it has.

Results for odd input: a null text or role is empty; turns go in order of
turn (nulls first; ties by role, then text); repeated rows are turns of their
own; rows with a null conv_id are one conversation with that id; extra columns
are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.tokens import encoder, slices

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: The marks' places after the tokenizer's vocabulary.
MARKS = (START, SEP, END)
LOSS_ROLE = "assistant"

_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def format_chats(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The formatted turns of all conversations.

    conv_id, position (in the conversation, from 0), ids (little-endian
    unsigned 32-bit, with the marks), start (ids of the conversation before
    this turn), loss_start and loss_end (ids of the conversation under the
    loss mask; equal where the turn has none), formatted (the written form).
    """
    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        mark = [np.array([enc.tokenizer.get_vocab_size() + k], "<u4").tobytes() for k in range(len(MARKS))]
        for b in batches:
            for at, texts in slices(b.column(3)):
                rows = b.slice(at, len(texts))
                roles = [escape(x) for x in rows.column(2).to_pylist()]
                texts = [escape(x) for x in texts]
                heads = [mark[0] + x + mark[1] for x in enc.encode(roles)]
                bodies = enc.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([h + x + mark[2] for h, x in zip(heads, bodies)], pa.binary()),
                     pa.array([len(h) // 4 for h in heads], pa.int64()), pa.array([len(x) // 4 for x in bodies], pa.int64()),
                     pa.array([START + r + SEP + t + END for r, t in zip(roles, texts)], pa.string())],
                    [*rows.schema.names, "ids", "head_len", "body_len", "formatted"])

    coded = plain.mapInArrow(encode, "conv_id long, turn long, role string, text string, ids binary, head_len long, body_len long, formatted string")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    n = F.col("head_len") + F.col("body_len") + 1
    before = F.coalesce(F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = coded.withColumn("start", before).withColumn("position", (F.row_number().over(order) - 1).cast("long"))
    loss = F.when(F.col("role") == LOSS_ROLE, F.col("body_len")).otherwise(F.lit(0))
    return placed.select("conv_id", "position", "ids", "start", (F.col("start") + F.col("head_len")).alias("loss_start"),
                         (F.col("start") + F.col("head_len") + loss).alias("loss_end"), "formatted")


def read_chats(formatted: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Read role, text and the text under the loss mask back from the ids.

    conv_id, position, role, text, loss_text (null where the turn has none),
    formatted_chars.
    """

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = encoder(tokenizer).tokenizer
        vocab = tok.get_vocab_size()
        for b in batches:
            roles, texts, losses = [], [], []
            for raw, start, a, z in zip(b.column(2), *(b.column(k).to_pylist() for k in (3, 4, 5))):
                ids = np.frombuffer(raw.as_py(), "<u4")
                marks = np.flatnonzero(ids >= vocab)
                if ids[marks].tolist() != [vocab, vocab + 1, vocab + 2] or marks[0] or marks[2] != len(ids) - 1:
                    raise ValueError("a turn is not start, role, sep, text, end")
                role, text = (unescape(tok.decode(ids[x + 1:y].tolist(), skip_special_tokens=False)) for x, y in zip(marks, marks[1:]))
                roles.append(role)
                texts.append(text)
                lost = ids[a - start:z - start]
                losses.append(unescape(tok.decode(lost.tolist(), skip_special_tokens=False)) if role == LOSS_ROLE else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(roles, pa.string()), pa.array(texts, pa.string()), pa.array(losses, pa.string()), b.column(6)],
                ["conv_id", "position", "role", "text", "loss_text", "formatted_chars"])

    return formatted.select("conv_id", "position", "ids", "start", "loss_start", "loss_end", F.char_length("formatted").cast("long").alias("formatted_chars")) \
        .mapInArrow(decode, "conv_id long, position long, role string, text string, loss_text string, formatted_chars long")


def chat_digests(read: DataFrame) -> DataFrame:
    """Digests of each conversation, from its turns in order.

    The rows of a conversation stream through one task in order, as a running
    hash needs; only the hash states are held.
    """

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, state, done = object(), None, []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names)

        def close() -> None:
            if state:
                done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for b in batches:
            for conv, role, text, loss, chars in zip(*(b.column(k).to_pylist() for k in (0, 2, 3, 4, 5))):
                if state is None or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss or "")
                state[3].update((loss or "").encode())
                state[4] += chars
            if len(done) >= 1000:
                yield batch()
                done = []
        close()
        if done:
            yield batch()

    n = max(1, int(read.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return read.repartition(n, "conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "position").mapInArrow(
        digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
