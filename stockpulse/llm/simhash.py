"""SimHash near-duplicates linked through sharded BK-trees.

Fingerprints are 64-bit SimHashes over word shingles. Two fingerprints link
at ``radius`` or fewer differing bits. By the pigeonhole principle two such
fingerprints agree in at least ``bands - radius`` of ``bands`` bit fields, so
every different fingerprint goes to one cell for each choice of that many
fields, keyed by its bits there: no link is lost, and cells are small. In each
cell a BK-tree is built (children keyed by their distance to the parent) and
asked for every member; only edges within the radius are followed. A cell of
more than ``CELL`` fingerprints is cut into shards, and each pair of shards is
a task of its own: the tree of the one is asked for the members of the other.
A task passes on the links that join its members (a spanning forest), not all
pairs. Groups are the connected components of the links.

The trees' total size grows with the corpus, so they are not broadcast:
queries meet each shard's tree through a shuffle.

Results for odd input: null and empty texts have fingerprint zero and link
like any other; repeated rows get equal results; a null doc_id keeps its row
(component_id: the least doc_id that is not null, else null); extra columns
are left out (kept in ``keep_one``, which keeps a row of every component, with
an id or without); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import connected_components, free_name, written

SHINGLE, RADIUS, BANDS = 3, 3, 5
#: Fingerprints in a shard of a cell.
CELL = 2048


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a whole text: bit set if set in over half the hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    k = min(shingle, len(words))
    last = end[k - 1:].tolist()
    first = [0, *(end[:len(words) - k] + 1).tolist()]
    h = xxhash.xxh64_intdigest
    total, n = np.zeros(64, "i8"), len(first)
    for at in range(0, n, 1 << 16):
        part = np.array([h(joined[a:z], 42) for a, z in zip(first[at:at + (1 << 16)], last[at:at + (1 << 16)])], "<u8")
        total += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    bits = (2 * total > n).astype("u1")
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp) of every row; h is a hash of the text, fp the fingerprint's bits as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([simhash(t.as_py(), shingle) for t in b.column(2)], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], ["doc_id", "h", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("h"), text).mapInArrow(run, "doc_id long, h long, fp long")


class BKTree:
    """Fingerprints by Hamming distance to their parents."""

    def __init__(self, radius: int):
        self.radius, self.values, self.children = radius, [], []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        at = 0
        while new:
            d = (self.values[at] ^ value).bit_count()
            if (nxt := self.children[at].get(d)) is None:
                self.children[at][d] = new
                return
            at = nxt

    def near(self, value: int) -> list[int]:
        """Places of all values within the radius."""
        found, todo, r = [], [0] if self.values else [], self.radius
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= r:
                found.append(at)
            kids = self.children[at]
            if kids:
                for k in range(d - r, d + r + 1):
                    if k in kids:
                        todo.append(kids[k])
        return found


def _links(tree_of: list[int], asked: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``tree_of`` and ``asked`` (or within, if they are one list)."""
    same = asked is tree_of
    up = list(range(len(tree_of) + (0 if same else len(asked))))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out, tree = [], BKTree(radius)
    if not same:
        for v in tree_of:
            tree.add(v)
    for i, v in enumerate(asked):
        me = i if same else len(tree_of) + i
        for j in tree.near(v):
            a, z = root(j), root(me)
            if a != z:
                up[a] = z
                out.append((v, tree_of[j]))
        if same:
            tree.add(v)
    return out


def links(fps: DataFrame, radius: int = RADIUS, bands: int = BANDS, cell: int = CELL) -> DataFrame:
    """Edges (u, v) that join all linked fingerprints of a column ``fp`` without repeats."""
    width = [64 // bands + (k < 64 % bands) for k in range(bands)]
    starts = np.cumsum([0, *width])
    picks = list(combinations(range(bands), bands - radius))

    def key(pick) -> F.Column:
        mask = sum(((1 << width[k]) - 1) << int(starts[k]) for k in pick)
        return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))

    cells = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("pick"), key(p).alias("key")) for i, p in enumerate(picks)])).alias("c")) \
        .select("fp", "c.pick", "c.key")
    sizes = cells.groupBy("pick", "key").agg(F.count("*").alias("n")).where("n > 1")
    shards = F.ceil(F.col("n") / F.lit(cell)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("shards").cast("long")).cast("int")
    dealt = cells.join(sizes, ["pick", "key"]).withColumn("shards", shards).withColumn("own", own) \
        .select("fp", "pick", "key", "own", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other")) \
        .select("fp", "pick", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("first"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trees, asks, out = None, [], [], []

        def close() -> None:
            if now and now[2] == now[3]:
                out.extend(_links(trees, trees, radius))
            elif now and trees and asks:
                out.extend(_links(trees, asks, radius))

        def batch() -> pa.RecordBatch:
            e = np.array(out, "u8").view("i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["u", "v"])

        for b in batches:
            fp = b.column(0).to_numpy().view("u8").tolist()
            for v, *at, first in zip(fp, *(b.column(k).to_pylist() for k in (1, 2, 3, 4, 5))):
                if at != now:
                    close()
                    now, trees, asks = at, [], []
                (trees if first else asks).append(v)
            if len(out) >= 10_000:
                yield batch()
                out = []
        close()
        if out:
            yield batch()

    n = max(1, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = ["pick", "key", "i", "j"]
    return dealt.repartition(n, *at).sortWithinPartitions(*at).select("fp", *at, "first").mapInArrow(run, "u long, v long").distinct()


def rooted(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fps`` (a column ``fp`` without repeats, and others) with the ``root`` of each one's component."""
    roots = connected_components(links(fps.select("fp"), radius))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select(*fps.columns, F.coalesce("root", "fp").alias("root"))


def components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    rows = written(fingerprints(docs, shingle), "fingerprints")
    labelled = rooted(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), radius)
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of = labelled.join(least, "root").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def hex_of(fp: F.Column) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one row of each component: that with the least doc_id (nulls last) and, of that, the least text hash.

    Rows are told apart by doc_id and text, so rows without an id and
    different texts under one id each count in their own component.
    """
    rows = written(fingerprints(docs, shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")
    labelled = rooted(rows.groupBy("fp").agg(F.min(row).alias("least")), radius)
    keep = labelled.groupBy("root").agg(F.min("least").alias("least"))
    own = [free_name(docs, x) for x in ("kept_id", "kept_h", "row_id", "row_h")]
    keep = keep.select(F.col("least.doc_id").alias(own[0]), F.col("least.h").alias(own[1]))
    told = docs.withColumns({own[2]: F.col("doc_id").cast("long"), own[3]: F.xxhash64(F.col("text").cast("string"))})
    kept = told.join(keep, F.col(own[2]).eqNullSafe(F.col(own[0])) & (F.col(own[3]) == F.col(own[1])), "left_semi")
    return kept.dropDuplicates(own[2:]).drop(*own[2:])
