"""MinHash near-duplicates: bands of minima under many hash functions.

A document's set has a 64-bit hash of each different shingle of ``SHINGLE``
words. Equal sets are one node. A node has ``BANDS`` keys, each made of the
set's minima under ``ROWS`` hash functions; nodes with the same key are a list,
and of lists with the same nodes one stays. Two sets of likeness J have a key
in common with probability J ** ``ROWS``, so sets that only share frequent
phrases rarely meet, and rows of lists grow in proportion to the nodes.

``STARS`` times every node is compared with one centre, a node that leads most
of its lists and is not in its component yet; so groups of near copies join
with a few comparisons a node. Lists that still hold several components are
gone through whole, save pairs within one component: the nodes outside a list's
largest component are dealt into blocks of at most ``CELL``; a block is held,
and those nodes of the list that it has to meet pass by it, so each goes to as
many places as there are blocks (one, unless more than ``CELL`` nodes are
outside). More than ``STRIPE`` of them are dealt into stripes, each with
the block of its own. Within, ``SQUARE`` nodes at a time are set against each
of the others by their ``marks``, 16 bits of each of a set's ``SKETCH`` least
hashes in order. Where both sketches hold their sets whole, the common marks
tell the likeness (from above, as marks can collide), and pairs below the
threshold stay; else the estimate by the union's sketch does, the values that
both have among the ``SKETCH`` least of both: a common value's place in the union
follows from its places in both. Only pairs past this filter leave a block, and
in the first pass of them only the likeliest of each two components.

Pairs that leave are verified on the full sets, which are written once for the
nodes in lists. In the second pass, over what is still apart, the likeliest
partner of each node comes first, then sixteen, then all; pairs that have come
into one component meanwhile are linked already and fall away, all others are
verified. Groups are the connected components of the verified links.

A pair at 0.8 or more fails to have one of the keys in common, or ``LIKELY`` of
the union's sketch, with a probability below 1e-12 (72 bands of 5 draws, and
512 draws; marks that collide add to what is in common, never take from it). The
check on full sets is exact.

Results for odd input: texts without words (null, empty) have an empty set and
are linked with nothing; repeated rows get equal results; a null doc_id keeps
its row (component_id: the least doc_id that is not null, else null; kept if
that is null too); extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.common import connected_components, written
from stockpulse.llm.ngram_lm import word_hashes

SHINGLE, THRESHOLD = 2, 80
SKETCH, BANDS, ROWS = 512, 72, 5
#: Of the least values of two sets' union, the part that both must have.
LIKELY = 0.65
#: Nodes that are held of a list, and nodes that pass by them, in one place.
CELL, STRIPE = 4096, 65536
#: Nodes on each side that are compared at a time.
SQUARE = 256
STARS = 2


#: Bytes of text that are hashed at a time.
_BLOCK = 1 << 20


def _shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` consecutive words, given the words' hashes."""
    x = np.full(len(h) - k + 1, k, "u8")
    for j in range(k):
        x = (x ^ h[j:len(h) - k + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: Iterable[str | None], shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted 64-bit hashes of each whole text's different shingles (fewer words: the one whole sequence; none: empty)."""
    block, size = [], 0

    def hashed() -> Iterator[np.ndarray]:
        # every text has a line end behind it, which belongs to no word
        starts, h = word_hashes(b"\n".join(block))
        ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in block])).tolist()
        every = _shingle_hashes(h, shingle) if len(h) >= shingle else h[:0]
        begin = 0
        for end in ends:
            x = every[begin:end - shingle + 1] if end - begin >= shingle else _shingle_hashes(h[begin:end], end - begin) if end > begin else h[:0]
            x = np.sort(x)
            yield x[np.append(True, x[1:] != x[:-1])] if len(x) > 1 else x
            begin = end

    for t in texts:
        block.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(block[-1])
        if size >= _BLOCK:
            yield from hashed()
            block, size = [], 0
    if block:
        yield from hashed()


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """``shingle_sets`` of one text."""
    return next(shingle_sets([text], shingle))


_MIXED = (_shingle_hashes(np.arange(1, 2 * BANDS * ROWS + 1, dtype="u8"), 1) >> np.uint64(32)).astype("u4")
#: The hash functions: a factor and a shift each, modulo 2 ** 32.
_FACTORS, _SHIFTS = _MIXED[:BANDS * ROWS] | np.uint32(1), _MIXED[BANDS * ROWS:]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The ``BANDS`` keys of each set (sets by bands, 64 bits)."""
    least = np.full((len(sets), BANDS * ROWS), 0xFFFFFFFF, "u4")
    part = np.empty((128, BANDS * ROWS), "u4")
    for at, s in zip(least, sets):
        x = (s >> np.uint64(32)).astype("u4")[:, None]
        for i in range(0, len(x), len(part)):
            now = part[:min(len(part), len(x) - i)]
            np.multiply(x[i:i + len(part)], _FACTORS, out=now)
            now += _SHIFTS
            np.minimum(at, now.min(axis=0), out=at)
    key = np.repeat(np.arange(1, BANDS + 1, dtype="u8")[None], len(sets), axis=0)
    for j in range(ROWS):
        key = (key ^ least[:, j::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(32))


def sketches(docs: DataFrame, shingle: int = SHINGLE, keys: bool = True) -> DataFrame:
    """(doc_id, h1, h2, n, digest, keys) of every row; without ``keys``, if not asked for.

    ``n``: the set's size; ``digest``: that of the whole set (null: no set); ``keys``: those of its bands.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(shingle_sets(b.column(3).to_pylist(), shingle))
            out = {**dict(zip(("doc_id", "h1", "h2"), b.columns)), "n": pa.array([len(s) for s in sets], pa.int64()),
                   "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary())}
            if keys:
                out["keys"] = pa.ListArray.from_arrays(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype="i4"), band_keys(sets).view("i8").ravel())
            yield pa.RecordBatch.from_pydict(out)

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_hashes(text), text.alias("text")) \
        .mapInArrow(run, "doc_id long, h1 long, h2 long, n long, digest binary" + (", keys array<long>" if keys else ""))


def _text_hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def key_lists(nodes: DataFrame) -> DataFrame:
    """(value, node): every node under its keys; keys of one node alone are left out, and of keys with the same nodes all but one."""
    entries = nodes.select(F.explode("keys").alias("value"), "node").repartition("value")
    several = entries.groupBy("value").agg(F.count("*").alias("m"), F.expr("bit_xor(xxhash64(node))").alias("x1"), F.expr("bit_xor(xxhash64(7, node))").alias("x2")).where("m > 1")
    return entries.join(several.groupBy("m", "x1", "x2").agg(F.min("value").alias("value")).select("value"), "value")


def _mixed(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(value, node, root) of the lists that still hold several components; the others never will again."""
    rooted = lists.select("value", "node").join(roots, "node")
    several = rooted.groupBy("value").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("value")
    return written(rooted.join(several, "value"), "minhash-mixed")


def _centres(mixed: DataFrame, turn: int) -> DataFrame:
    """(u, v): every node with the node that leads most of its lists, if in another component; the leaders change from turn to turn."""
    order = F.col("node") if not turn else F.xxhash64("node", F.lit(turn))
    lead = mixed.groupBy("value").agg(F.min(F.struct(order.alias("o"), "node", "root")).alias("lead")) \
        .select("value", F.col("lead.node").alias("centre"), F.col("lead.root").alias("led"))
    met = mixed.join(lead, "value").where("root <> led").groupBy("node", "centre").agg(F.count("*").alias("k"))
    return met.groupBy(F.col("node").alias("u")).agg(F.max(F.struct("k", (-F.col("centre")).alias("c"))).alias("best")).select("u", (-F.col("best.c")).alias("v"))


def _estimates(table: np.ndarray, own: np.ndarray, n: int, every: np.ndarray, starts: np.ndarray, ns: np.ndarray) -> np.ndarray:
    """Likeness of a set of ``n`` with these marks to each of the sets of ``ns`` whose marks are ``every`` from ``starts`` on; 0: not past the filter.

    ``table``: a zero for each mark, and again afterwards.
    """
    table[own[::-1]] = np.arange(len(own), 0, -1)
    rank = table[every]
    table[own] = 0
    shared = rank > 0
    common = np.minimum(np.add.reduceat(shared, starts, dtype="i8"), np.minimum(n, ns))
    union = n + ns - common
    e = np.where(common * 100 >= union * THRESHOLD, common / union, 0)
    whole = np.maximum(n, ns) <= SKETCH
    if not whole.all():
        sizes = np.diff(np.append(starts, len(every)))
        seen = np.cumsum(shared)
        place = rank + np.arange(1, len(every) + 1) - seen - np.repeat(starts - (seen - shared)[starts], sizes)
        part = np.add.reduceat(shared & (place <= SKETCH), starts, dtype="i8") / SKETCH
        e = np.where(whole, e, np.where(part >= LIKELY, part, 0))
    return e


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(u, v, estimate) of the pairs that pass the filter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, start = np.zeros(1 << 16, "i4"), np.zeros(1, "i8")
        for b in batches:
            e = np.array([_estimates(table, np.frombuffer(x, "<u2"), n, np.frombuffer(y, "<u2"), start, np.array([m]))[0]
                          for n, m, x, y in zip(*(c.to_pylist() for c in b.columns[2:]))], "f8")
            keep = pa.array(e > 0)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep), pa.array(e).filter(keep)], ["u", "v", "estimate"])

    s = nodes.select("node", "n", "marks")
    met = pairs.join(s.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("marks").alias("s_u")), "u") \
        .join(s.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("marks").alias("s_v")), "v")
    return met.where(_sizes_fit(F.col("n_u"), F.col("n_v"))).select("u", "v", "n_u", "n_v", "s_u", "s_v").mapInArrow(run, "u long, v long, estimate double")


def _sizes_fit(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * THRESHOLD


def _block_pairs(table: np.ndarray, a: list, b: list, best: bool) -> np.ndarray:
    """Pairs past the filter between two blocks of (node, root, n, marks), of different roots; within one, if they are the same.

    Rows (u, v, estimate in millionths); ``best``: only the likeliest pair of each two roots.
    """
    sets = [np.frombuffer(x[3], "<u2") for x in b]
    sizes = np.array([len(x) for x in sets])
    every, starts = np.concatenate(sets), np.cumsum(sizes) - sizes
    node, root, n = (np.array([x[k] for x in b]) for k in range(3))
    out = []
    for i, (own, own_root, own_n, marks) in enumerate(a):
        fit = (root != own_root) & (np.minimum(n, own_n) * 100 >= np.maximum(n, own_n) * THRESHOLD)
        if a is b:
            fit[:i + 1] = False
        others = np.flatnonzero(fit)
        if not len(others):
            continue
        marks = np.frombuffer(marks, "<u2")
        if 2 * len(others) < len(b):
            e = _estimates(table, marks, own_n, np.concatenate([sets[j] for j in others]), np.cumsum(sizes[others]) - sizes[others], n[others])
        else:
            e = _estimates(table, marks, own_n, every, starts, n)[others]
        others, e = others[e > 0], e[e > 0]
        if len(others):
            out.append(np.stack([np.minimum(own, node[others]), np.maximum(own, node[others]), (e * 1_000_000).astype("i8"),
                                 np.full(len(others), own_root), root[others]], axis=1))
    found = np.concatenate(out) if out else np.empty((0, 5), "i8")
    if best and len(found):
        r0, r1 = np.minimum(found[:, 3], found[:, 4]), np.maximum(found[:, 3], found[:, 4])
        order = np.lexsort((found[:, 1], found[:, 0], -found[:, 2], r1, r0))
        r0, r1 = r0[order], r1[order]
        first = np.append(True, (r0[1:] != r0[:-1]) | (r1[1:] != r1[:-1]))
        found = found[order[first]]
    return found[:, :3]


def _open_pairs(lists: DataFrame, nodes: DataFrame, cell: int, best: bool) -> DataFrame:
    """(u, v, estimate): pairs past the filter that meet in a list of ``_mixed`` and are in different components; ``best``: as in ``_block_pairs``."""
    of_root = lists.groupBy("value", "root").agg(F.count("*").alias("c"))
    sizes = of_root.groupBy("value").agg(F.max(F.struct("c", "root")).alias("most"), F.sum("c").alias("m")).select(
        "value", F.col("most.root").alias("main"), F.ceil((F.col("m") - F.col("most.c")) / F.lit(cell)).cast("int").alias("blocks"),
        F.ceil(F.col("m") / F.lit(cell * STRIPE // CELL)).cast("int").alias("stripes"))
    dealt = lists.join(sizes, "value")
    by = F.xxhash64("node")
    # a node outside the largest component is held in its block, once for each stripe, and passes by the blocks before; the others pass by all
    own = F.when(F.col("root") == F.col("main"), F.col("blocks")).otherwise(F.pmod(by, F.col("blocks").cast("long")).cast("int"))
    held = F.when(F.col("root") == F.col("main"), F.array().cast("array<struct<i:int,s:int,passes:boolean>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("stripes") - 1), lambda s: F.struct(own.alias("i"), s.alias("s"), F.lit(False).alias("passes"))))
    stripe = F.pmod(F.xxhash64(F.lit(1), "node"), F.col("stripes").cast("long")).cast("int")
    passes = F.when(own == 0, F.array().cast("array<struct<i:int,s:int,passes:boolean>>")).otherwise(
        F.transform(F.sequence(F.lit(0), own - 1), lambda i: F.struct(i.alias("i"), stripe.alias("s"), F.lit(True).alias("passes"))))
    dealt = dealt.select("value", "node", "root", F.explode(F.concat(held, passes)).alias("at")).select("value", "at.*", "node", "root")

    square = min(SQUARE, cell)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, left, right, out, size, table = None, [], [], [], 0, np.zeros(1 << 16, "i4")

        def meet(a: list, b: list) -> None:
            nonlocal size
            got = _block_pairs(table, a, b, best)
            if len(got):
                out.append(got)
                size += len(got)

        def batch() -> pa.RecordBatch:
            nonlocal out, size
            e = np.concatenate(out)
            out, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1]), pa.array(e[:, 2] / 1_000_000)], ["u", "v", "estimate"])

        def squares(held_too: bool) -> Iterator[pa.RecordBatch]:
            """What passes by meets what is held; what is held meets itself, if asked for."""
            parts = [left[i:i + square] for i in range(0, len(left), square)]
            for i, a in enumerate(parts):
                for b in ([right] if right else []) + (parts[i:] if held_too else []):
                    meet(a, b)
                    if size > 50_000:
                        yield batch()

        for b in batches:
            for *at, passing, node, root, n, marks in zip(*(x.to_pylist() for x in b.columns)):
                if at != now:
                    # the held nodes of a block are in all its stripes, and meet one another in the first
                    yield from squares(now is not None and now[2] == 0)
                    now, left, right = at, [], []
                (right if passing else left).append((node, root, n, marks))
                if len(right) == square:
                    yield from squares(False)
                    right = []
        yield from squares(now is not None and now[2] == 0)
        if out:
            yield batch()

    n = max(1, int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = ["value", "i", "s"]
    return dealt.join(nodes.select("node", "n", "marks"), "node").repartition(n, *at).sortWithinPartitions(*at, "passes").select(*at, "passes", "node", "root", "n", "marks") \
        .mapInArrow(run, "u long, v long, estimate double").groupBy("u", "v").agg(F.max("estimate").alias("estimate"))


def full_sets(nodes: DataFrame, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, n, marks, full, short): the hashes of each node's whole set, 16 bits of each, sorted, and its marks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(shingle_sets(b.column(1).to_pylist(), shingle))
            low = [x.astype("<u2") for x in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in sets], pa.int64()), *(
                pa.array([x.tobytes() for x in y], pa.binary()) for y in ([x[:SKETCH] for x in low], sets, [np.sort(x) for x in low]))], ["node", "n", "marks", "full", "short"])

    asked = nodes.select("node", F.col("rep.doc_id").alias("d"), F.col("rep.h1").alias("a"), F.col("rep.h2").alias("b"))
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_hashes(text), text.alias("text"))
    met = texts.join(asked, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")))
    return met.select("node", "text").dropDuplicates(["node"]).mapInArrow(run, "node long, n long, marks binary, full binary, short binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v) of the pairs whose full sets reach the threshold."""

    def common(x: np.ndarray, y: np.ndarray) -> int:
        """Values in both, as often as in the one that has fewer."""
        at, n = np.unique(x, return_counts=True)
        return int(np.minimum(n, np.searchsorted(y, at, "right") - np.searchsorted(y, at, "left")).sum())

    def check(kind: str):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = []
                for x, y in zip(b.column(2), b.column(3)):
                    x, y = np.frombuffer(x.as_py(), kind), np.frombuffer(y.as_py(), kind)
                    both = common(x, y)
                    keep.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["u", "v"])
        return run

    def checked(some: DataFrame, column: str, kind: str, name: str) -> DataFrame:
        of = [sets.join(some.select(F.col(x).alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias(x), F.col(column).alias(f"f_{x}")) for x in ("u", "v")]
        return written(some.select("u", "v").join(of[1], "v").join(of[0], "u").select("u", "v", "f_u", "f_v").mapInArrow(check(kind), "u long, v long"), name)

    # 16 bits of each hash never show too little in common, and are a quarter of the bytes; what they leave is checked in full
    return checked(checked(pairs, "short", "<u2", "minhash-near"), "full", "<u8", "minhash-links")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) with the components that the links join as one: the components of a graph of the roots alone."""
    of = [roots.select(F.col("node").alias(x), F.col("root").alias(f"r_{x}")) for x in ("u", "v")]
    joins = links.join(of[0], "u").join(of[1], "v").where("r_u <> r_v").select(F.col("r_u").alias("u"), F.col("r_v").alias("v"))
    new = connected_components(joins).select(F.col("node").alias("old"), F.col("root").alias("new"))
    return written(roots.join(new, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root")), "minhash-roots")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose nodes are still in different components."""
    of = [roots.select(F.col("node").alias(x), F.col("root").alias(f"r_{x}")) for x in ("u", "v")]
    return pairs.join(of[0], "u").join(of[1], "v").where("r_u <> r_v").drop("r_u", "r_v")


def components(docs: DataFrame, shingle: int = SHINGLE, cell: int = CELL) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    # hashing twice costs less than a written table of all sketches
    rows = written(sketches(docs, shingle, keys=False), "minhash-rows")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2")
    nodes = written(sketches(docs, shingle).where("n > 0").groupBy("digest", "n", "keys").agg(F.min(row).alias("rep"), F.min("doc_id").alias("least"))
                    .withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    lists = written(key_lists(nodes), "minhash-lists")
    listed = nodes.select("node", "rep").join(lists.select("node").distinct(), "node", "left_semi")
    sets = written(full_sets(listed, docs, shingle), "minhash-sets")
    roots = sets.select("node", F.col("node").alias("root"))
    lists = lists.withColumn("root", F.col("node"))
    for turn in range(STARS):
        lists = _mixed(lists, roots) if turn else lists
        star = written(_likely(_centres(lists, turn), sets), "minhash-star")
        roots = _joined(roots, _verified(star, sets))
    lists = _mixed(lists, roots)
    roots = _joined(roots, _verified(written(_open_pairs(lists, sets, cell, True), "minhash-best"), sets))
    open_ = written(_open_pairs(_mixed(lists, roots), sets, cell, False), "minhash-open")
    for width in (1, 16, None):
        if open_.isEmpty():
            break
        if width:
            likeliest = Window.partitionBy("u").orderBy(F.desc("estimate"), "v")
            ranked = written(open_.withColumn("r", F.row_number().over(likeliest)), "minhash-ranked")
            now, open_ = ranked.where(F.col("r") <= width).drop("r"), ranked.where(F.col("r") > width).drop("r")
        else:
            now = open_
        roots = _joined(roots, _verified(now, sets))
        open_ = written(_apart(open_, roots), "minhash-open")
    of = nodes.select("node", "digest", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = of.groupBy("root").agg(F.min("least").alias("component"))
    found = of.join(least, "root").select(F.col("digest").alias("d"), "component")
    whole = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n", "digest").join(found, F.col("digest") == F.col("d"), "left") \
        .select("doc_id", F.col("n").alias("n_shingles"), whole.alias("component_id"), F.col("doc_id").eqNullSafe(whole).alias("kept"))
