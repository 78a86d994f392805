"""Packing by concatenate and cut.

Pass one encodes every document once, writes the ids with their place in
their partition, and adds up the ids of each partition. Pass two turns the
partition totals into global offsets by a prefix sum and cuts the one long
stream at multiples of the window. A document that crosses a cut gets a
piece (a boundary record) on either side of it. Nothing but the partition
totals meets in one place, and a document's length changes nothing.

Results for odd input: a null or empty text is its end id alone; repeated
rows are documents of their own; extra columns are left out; an empty table
gives no rows. A null doc_id stays null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import with_bases
from stockpulse.llm.tokens import token_table

WINDOW = 2048
END_ID = 1


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents in windows of ``window`` ids.

    doc_id, doc_tokens, start (the document's ids before the piece), length,
    sequence_id, offset (in the sequence), ids (little-endian unsigned 32-bit),
    crosses (the document goes on in another sequence).
    """
    rows = token_table(docs, end_id, tokenizer)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    placed = with_bases(rows, totals, "part", "n", "base").withColumn("at", F.col("base") + F.col("local_start"))
    w = F.lit(window).cast("long")
    first, last = F.floor(F.col("at") / w), F.floor((F.col("at") + F.col("n_tokens") - 1) / w)
    cut = placed.select("doc_id", "n_tokens", "at", "ids", first.alias("first"), last.alias("last"),
                        F.explode(F.sequence(first, last)).alias("sequence_id"))
    lo = F.greatest(F.col("sequence_id") * w - F.col("at"), F.lit(0))
    hi = F.least((F.col("sequence_id") + 1) * w - F.col("at"), F.col("n_tokens"))
    return cut.select(
        "doc_id", F.col("n_tokens").alias("doc_tokens"), lo.cast("long").alias("start"), (hi - lo).cast("long").alias("length"),
        F.col("sequence_id").cast("long").alias("sequence_id"),
        (F.col("at") + lo - F.col("sequence_id") * w).cast("long").alias("offset"),
        F.substring("ids", (lo * 4 + 1).cast("int"), ((hi - lo) * 4).cast("int")).alias("ids"),
        (F.col("first") < F.col("last")).alias("crosses"))


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Whole sequences (sequence_id, n_tokens, ids) from the pieces.

    A sequence has at most ``window`` ids, so no group is larger than that.
    Sequences are padded to ``window``, except at a power of two.
    """
    got = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    n = F.col("n_tokens").cast("int")
    whole = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    pad = F.when(F.bit_count(n) == 1, F.lit(0)).otherwise(F.lit(window) - n)
    zero = F.unhex(F.repeat(F.hex(F.unhex(F.lit(pad_id.to_bytes(4, "little").hex()))), pad))
    return got.select("sequence_id", "n_tokens", F.concat(whole, zero).alias("ids"))
