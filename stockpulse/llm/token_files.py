"""Token ids in binary segments with Elias-Fano coded document boundaries.

Documents are sorted by doc_id over the whole corpus (range partitions, then
a sort in each). Each partition is written as a chain of segments, binary
records of a bounded number of ids. A segment is:

    magic "TID1", bytes of an id (u4), flags of null ids (u4: leading rows with a null doc_id), documents (u8), ids (u8),
    least doc_id (i8), bytes of the two lists (u8 each),
    Elias-Fano list of the document ends, Elias-Fano list of the doc_ids
    less the least, then the ids (little-endian, 2 or 4 bytes each).

Segments are the rows of a Parquet folder, which gives them Spark's commit
protocol on any file system: a lost executor or a second attempt leaves no
half-written segment. A document's place is found by two selects; there is
no table of 64-bit offsets.

Results for odd input: a null or empty text has its end id alone; a null
doc_id sorts first and stays null; repeated rows are documents of their own
(ties of doc_id in order of text); extra columns are left out; an empty table
gives no rows. A document larger than a segment's bound has a segment alone.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.llm.common import bound_batches, scratch_path, with_bases
from stockpulse.llm.elias_fano import EliasFano
from stockpulse.llm.tokens import token_batches

END_ID = 2
SEGMENT_IDS = 1 << 18
MAGIC = b"TID1"
_HEAD = struct.Struct("<4sIIQQqQQ")
SCHEMA = "part int, local_start long, n_docs long, n_ids long, first_id long, segment binary"


def pack_segment(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """One segment of documents in ascending doc_id order; ``ids`` are 32-bit."""
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], "i8")
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(x) // 4 for x in ids])
    bounds = EliasFano.encode(ends.astype("u8"))
    names = EliasFano.encode((known - least).view("u8"))
    body = np.frombuffer(b"".join(ids), "<u4")
    return _HEAD.pack(MAGIC, width, nulls, len(ids), len(body), least, len(bounds), len(names)) + bounds + names + body.astype(f"<u{width}").tobytes()


class Segment:
    """Reads one segment."""

    def __init__(self, data: bytes):
        magic, self.width, self.nulls, self.n_docs, self.n_ids, self.least, b, d = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = _HEAD.size
        self.bounds = EliasFano(data[at:at + b])
        self.names = EliasFano(data[at + b:at + b + d])
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, at + b + d)

    def span(self, i: int) -> tuple[int, int]:
        """First id and end of the i-th document."""
        ends = self.bounds.select(np.array([i - 1, i] if i else [0, 0]))
        return (int(ends[0]) if i else 0), int(ends[1])

    def spans(self) -> np.ndarray:
        return np.concatenate([[0], self.bounds.select(np.arange(self.n_docs)).astype("i8")])

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.names.select(np.arange(self.names.n)).view("i8") + self.least).tolist()


def write_token_files(docs: DataFrame, path: str, end_id: int = END_ID, tokenizer: str | None = None, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode all documents and write the segments below ``path``."""
    spark = docs.sparkSession
    bound_batches(spark)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = plain.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list = []
        ids: list[bytes] = []
        size, part, start = 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal names, ids, size, start
            wide = max(int(np.frombuffer(x, "<u4").max()) for x in ids) >= 1 << 16
            row = [part, start, len(ids), size, next((x for x in names if x is not None), None), pack_segment(names, ids, 4 if wide else 2)]
            names, ids, start, size = [], [], start + size, 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], [c.split()[0] for c in SCHEMA.split(", ")])

        for b in token_batches(batches, end_id, tokenizer):
            for d, p, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4)):
                x = x.as_py()
                if ids and size + len(x) // 4 > segment_ids:
                    yield flush()
                names.append(d)
                ids.append(x)
                size, part = size + len(x) // 4, p
        if ids:
            yield flush()

    placed.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the written segments: doc_id, start (ids of all
    documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    files = spark.read.schema(SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    placed = with_bases(files.select("part", "local_start", "segment"), totals, "part", "n", "base")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, data in zip(b.column(0).to_pylist(), b.column(1)):
                s = Segment(data.as_py())
                spans, names = s.spans(), s.doc_ids()
                wide = s.ids.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(start + spans[:-1]), pa.array(np.diff(spans)),
                     pa.array([wide[a:z].tobytes() for a, z in zip(spans[:-1].tolist(), spans[1:].tolist())], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return placed.select((F.col("base") + F.col("local_start")).alias("start"), "segment").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, **options) -> DataFrame:
    """Write the files of ``docs`` to a new shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, **options)
    return read_token_files(docs.sparkSession, path)
