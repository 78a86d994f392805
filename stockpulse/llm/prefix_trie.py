"""Prefix trie over conversations: ternary search trees in range shards.

Turns are encoded by a dictionary: every different (role, text) has an id,
found through a 128-bit hash. A conversation is a sequence of ids, cut into
chunks of ``CHUNK`` turns, so no row grows with a conversation's length. A
chunk belongs to a story (its number in the conversation) and a root (the node
where it starts, named by a chained 128-bit hash of all ids before it). Equal
chunks of one root are counted first and become one row. Chunks are then dealt
to ranges in order of (story, root, ids); each range shard builds a ternary
search tree for each root, by inserting the median of its sorted sequences
first, then those of the halves. A pass over the nodes, last made first (a
node is made after its parent), adds up members, children, leaves and savings.

Two neighbour shards share the common prefix of the last sequence of the one
and the first of the other. Those boundary nodes alone are merged: their
numbers are added, and for each neighbour pair the shared prefix is taken off
once (children and words that both have counted, and a leaf that goes on in
the next shard). What stands below a chunk's last turn is added up by root:
each root's own sums are given to its least member, summed along each
conversation from the last story on, and added over a root's members; then the
shards are passed once more with these sums as weights. The number of jobs
does not depend on the conversations' lengths.

Results for odd input: turns go in order of turn, nulls first, ties in order
of the hash of role and text; a null role or text is empty; repeated rows are
turns of their own; rows with a null conv_id are one conversation, which
counts as a member, names a node only where no other conversation has it, and
is an empty text in ``ends_sha256``; a conversation without turns ends at the
root; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.common import written

#: Turns in a chunk of a conversation.
CHUNK = 256
ROOT = bytes(16)
_WORD = "[^\\x20\\x09-\\x0D]+"


def _next_key(key: bytes, turn_id: int) -> bytes:
    return hashlib.blake2b(key + turn_id.to_bytes(8, "little", signed=True), digest_size=16).digest()


def encode(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, h1, id, words): every turn with its dictionary id and the words of its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = written(turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), role, text).alias("h2"),
                                F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words")), "trie-turns")
    dictionary = written(slim.groupBy("h1", "h2").agg(F.max("words").alias("words")).withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    return slim.drop("words").join(dictionary, ["h1", "h2"]).select("conv_id", "turn", "h1", "id", "words")


def in_order(coded: DataFrame) -> DataFrame:
    """``coded`` with ``place``, the number of the turn in its conversation, from 0."""
    line = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "h1", "id")
    return coded.select("conv_id", (F.row_number().over(line) - 1).cast("long").alias("place"), "id", "words")


def rebuild(placed: DataFrame, group: int = 20, folds: int = 4) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation c - c % group, h = crc32(c) % folds.

    (conv_id, place, id, words), and for each conversation a row with place -1
    and no id, so that one without turns is not lost.
    """
    placed = written(placed, "trie-placed")
    h = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % folds
    own = placed.withColumn("h", h).where("place >= h").select("conv_id", "place", "id", "words")
    every = placed.select("conv_id").distinct().withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    heads = placed.where(f"place < {folds - 1} and conv_id % {group} = 0").withColumnRenamed("conv_id", "base")
    lent = every.join(heads, "base").where("place < h").select("conv_id", "place", "id", "words")
    nothing = F.lit(None).cast("long")
    return own.union(lent).union(every.select("conv_id", F.lit(-1).cast("long"), nothing, nothing))


def chunks(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, story, root, ids, words, key, last): each conversation's chunks; ``key`` is the node at the chunk's end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.bool_()]
        names = ["conv_id", "story", "root", "ids", "words", "key", "last"]
        now, open_, story, root, key, ids, words, done, size = None, False, 0, ROOT, ROOT, [], [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names)

        def close(last: bool) -> None:
            nonlocal story, root, ids, words, size
            done.append((now, story, root, ids, words, key, last))
            size += len(ids) + 8
            story, root, ids, words = story + 1, key, [], []

        for b in batches:
            for conv, i, w in zip(*(x.to_pylist() for x in b.columns)):
                if not open_ or conv != now:
                    if open_:
                        close(True)
                    if size > 200_000:
                        yield batch()
                        done, size = [], 0
                    now, open_, story, root, key, ids, words = conv, True, 0, ROOT, ROOT, [], []
                if i is None:
                    continue
                if len(ids) == chunk:
                    close(False)
                    if size > 200_000:
                        yield batch()
                        done, size = [], 0
                key = _next_key(key, i)
                ids.append(i)
                words.append(w)
        if open_:
            close(True)
        if done:
            yield batch()

    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(n, "conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place").select("conv_id", "id", "words") \
        .mapInArrow(run, "conv_id long, story int, root binary, ids array<long>, words array<long>, key binary, last boolean")


def _least(a: int | None, b: int | None) -> int | None:
    return a if b is None else b if a is None else min(a, b)


class TernaryTree:
    """A ternary search tree of sequences of ids; node 0 is the root.

    ``eq`` of a node leads to the search tree of its children, ``lo`` and
    ``hi`` to siblings with lesser and greater ids.
    """

    def __init__(self, root: bytes):
        self.ids, self.lo, self.eq, self.hi, self.parent = [0], [-1], [-1], [-1], [-1]
        self.key, self.depth, self.word = [root], [0], [0]
        self.n, self.least, self.kids, self.leaves, self.saved, self.goes_on = [0], [None], [0], [0], [0], [False]

    def _new(self, parent: int, turn_id: int, word: int) -> int:
        for values, x in ((self.ids, turn_id), (self.lo, -1), (self.eq, -1), (self.hi, -1), (self.parent, parent), (self.key, _next_key(self.key[parent], turn_id)),
                          (self.depth, self.depth[parent] + 1), (self.word, word), (self.n, 0), (self.least, None), (self.kids, 0), (self.leaves, 0), (self.saved, 0), (self.goes_on, False)):
            values.append(x)
        self.kids[parent] += 1
        return len(self.ids) - 1

    def insert(self, ids: list[int], words: list[int], n: int, least: int | None) -> list[int]:
        """The path of a sequence with ``n`` members, made where it lacks."""
        at, path = 0, [0]
        for i, w in zip(ids, words):
            j, links, above = self.eq[at], self.eq, at
            while j >= 0 and self.ids[j] != i:
                links, above = (self.lo if i < self.ids[j] else self.hi), j
                j = links[j]
            if j < 0:
                j = self._new(at, i, w)
                links[above] = j
            at = j
            path.append(at)
        for j in path:
            self.n[j] += n
            self.least[j] = _least(self.least[j], least)
        return path

    def add_up(self) -> tuple[list[int], list[int]]:
        """Words with and without members over each node's subtree; completes ``leaves``."""
        full, once = [n * w for n, w in zip(self.n, self.word)], list(self.word)
        for j in range(len(self.ids) - 1, -1, -1):
            full[j] += self.saved[j]
            if not self.kids[j] and not self.goes_on[j]:
                self.leaves[j] += 1
            if (p := self.parent[j]) >= 0:
                full[p] += full[j]
                once[p] += once[j]
                self.leaves[p] += self.leaves[j]
        return full, once


def _medians(n: int) -> Iterator[int]:
    todo = [(0, n)]
    while todo:
        a, z = todo.pop()
        if a < z:
            m = (a + z) // 2
            yield m
            todo += [(m + 1, z), (a, m)]


_NODES = ("shard int, side int, story int, key binary, parent_key binary, depth long, least long, parent_least long, n long, kids long, leaves long, full long, once long, "
          "edge boolean, far_parent boolean, ids array<long>, words array<long>, goes_on boolean")
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}


def _nodes_of(group: list[tuple], story: int, root: bytes, chunk: int, first: bool, last: bool) -> Iterator[tuple]:
    """Rows of a root's tree; ``first`` and ``last``: its first and last sequence are those of the shard."""
    tree, edge = TernaryTree(root), set()
    for m in _medians(len(group)):
        ids, words, n, least, goes_on, kids, leaves, saved = group[m]
        path = tree.insert(ids, words, n, least)
        if goes_on:
            end = path[-1]
            tree.goes_on[end] = True
            tree.leaves[end] += leaves
            tree.saved[end] += saved
            tree.kids[end] += kids
        if (first and not m) or (last and m == len(group) - 1):
            edge.update(path)
    full, once = tree.add_up()
    for j, p in enumerate(tree.parent):
        above = p >= 0
        yield (None, None, story, tree.key[j], tree.key[p] if above else None, story * chunk + tree.depth[j], tree.least[j], tree.least[p] if above else None,
               tree.n[j], tree.kids[j], tree.leaves[j], full[j], once[j], j in edge, above and (p in edge or (p == 0 and story > 0)), None, None, None)


def _shard_nodes(found: DataFrame, chunk: int) -> DataFrame:
    """Nodes of all range shards, and each shard's first and last sequence (``side`` 0 and 1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows, group, at, first, last = TaskContext.get().partitionId(), [], [], None, True, None
        fields = [f.split(" ") for f in _NODES.split(", ")]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _KINDS[t]) for k, (_, t) in enumerate(fields)], [c for c, _ in fields])

        def side(which: int, place: tuple, seq: tuple) -> tuple:
            return (shard, which, place[0], place[1], None, None, None, None, 0, 0, 0, 0, 0, True, False, seq[0], seq[1], seq[4])

        for b in batches:
            for story, root, *seq in zip(*(x.to_pylist() for x in b.columns)):
                if at != (story, root):
                    if group:
                        rows.extend(_nodes_of(group, *at, chunk, first, False))
                        first = False
                    else:
                        rows.append(side(0, (story, root), seq))
                    at, group = (story, root), []
                    if len(rows) > 20_000:
                        yield batch()
                        rows = []
                group.append(seq)
        if group:
            rows.extend(_nodes_of(group, *at, chunk, first, True))
            rows.append(side(1, at, group[-1]))
        if rows:
            yield batch()

    n = max(1, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["story", "root", "ids"]
    return written(found.repartitionByRange(n, *order).sortWithinPartitions(*order)
                   .select("story", "root", "ids", "words", "n", "least", "goes_on", "w_kids", "w_leaves", "w_saved").mapInArrow(run, _NODES), "trie-nodes")


def _taken_off(sides: DataFrame) -> DataFrame:
    """What neighbour shards count twice: rows (story, key, kids, leaves, once) to be added to the boundary nodes.

    ``sides`` has two rows for each shard, of ``CHUNK`` turns at most.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for story, root, ids, words, goes_on, next_ids in zip(*(x.to_pylist() for x in b.columns)):
                same = 0
                while same < min(len(ids), len(next_ids)) and ids[same] == next_ids[same]:
                    same += 1
                grown = same == len(ids) and not goes_on
                key, left = root, sum(words[:same])
                for d in range(same + 1):
                    out.append((story, key, -1 if d < same else 0, -1 if grown else 0, -left))
                    if d < same:
                        # below the node itself: its own words are shared, those of its parents are not below it
                        left -= words[d - 1] if d else 0
                        key = _next_key(key, ids[d])
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                                             ["story", "key", "kids", "leaves", "once"])

    line = Window.orderBy("shard", "side")
    near = sides.withColumn("next_ids", F.lead("ids").over(line)).withColumn("next_key", F.lead("key").over(line)).withColumn("next_story", F.lead("story").over(line))
    return near.where("side = 1 and next_story = story and next_key = key").select("story", "key", "ids", "words", "goes_on", "next_ids") \
        .mapInArrow(run, "story int, key binary, kids long, leaves long, once long")


def _merged(nodes: DataFrame) -> DataFrame:
    """The nodes with boundary nodes as one row each."""
    columns = ["story", "key", "parent_key", "depth", "least", "parent_least", "n", "kids", "leaves", "full", "once", "far_parent", "edge"]
    inner = nodes.where("side is null and not edge").select(columns)
    zero = F.lit(0).cast("long")
    off = _taken_off(nodes.where("side is not null").select("shard", "side", "story", "key", "ids", "words", "goes_on"))
    edge = nodes.where("side is null and edge").select(columns).unionByName(
        off.select("story", "key", F.lit(None).cast("binary").alias("parent_key"), F.lit(None).cast("long").alias("depth"), F.lit(None).cast("long").alias("least"),
                   F.lit(None).cast("long").alias("parent_least"), zero.alias("n"), "kids", "leaves", zero.alias("full"), "once", F.lit(False).alias("far_parent"), F.lit(True).alias("edge")))
    one = edge.groupBy("story", "key").agg(F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("least").alias("least"), F.lit(None).cast("long").alias("parent_least"),
                                           *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "full", "once")], F.max("far_parent").alias("far_parent"), F.lit(True).alias("edge"))
    return inner.unionByName(one.select(columns))


def _weights(cut: DataFrame, nodes: DataFrame) -> DataFrame:
    """Children, leaves and savings below each root past the first story: (root, w_kids, w_leaves, w_saved)."""
    roots = _merged(nodes).where("story > 0 and parent_key is null").select(
        F.col("story").alias("s"), F.col("key"), "least", "kids", "leaves", (F.col("full") - F.col("once")).alias("saved"))
    mine = F.col("conv_id").eqNullSafe(F.col("least"))
    met = cut.where("story > 0").select("conv_id", "story", "root").join(roots, (F.col("story") == F.col("s")) & (F.col("root") == F.col("key")))
    later = Window.partitionBy("conv_id").orderBy(F.desc("story"))
    below = met.select("story", "root", "kids", *[F.sum(F.when(mine, F.col(c)).otherwise(F.lit(0))).over(later).alias(c) for c in ("leaves", "saved")])
    return below.groupBy("root").agg(F.max("kids").alias("w_kids"), F.sum("leaves").alias("w_leaves"), F.sum("saved").alias("w_saved"))


def _ends(cut: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the conversations that end at a node, streamed in order of id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, state = [], None, None
        for b in batches:
            for key, conv in zip(*(x.to_pylist() for x in b.columns)):
                name = b"" if conv is None else str(conv).encode()
                if key == now:
                    state.update(b"," + name)
                    continue
                if state:
                    done.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256(name)
            if len(done) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in done], pa.binary()), pa.array([r[1] for r in done])], ["end", "ends_sha256"])
                done = []
        if state:
            done.append((now, state.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in done], pa.binary()), pa.array([r[1] for r in done])], ["end", "ends_sha256"])

    n = max(1, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return cut.where("last").select("key", "conv_id").repartition(n, "key").sortWithinPartitions("key", F.col("conv_id").asc_nulls_first()) \
        .mapInArrow(run, "end binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The trie of all conversations of ``rows`` (conv_id, place, id, words, as ``in_order`` or ``rebuild`` give them).

    A row for each node: conv_id (least member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    cut = written(chunks(rows, chunk), "trie-chunks")
    zero = F.lit(0).cast("long")
    found = written(cut.groupBy("story", "root", "ids", "words", "key").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max(~F.col("last")).alias("goes_on")), "trie-sequences")
    nodes = _shard_nodes(found.withColumns({"w_kids": zero, "w_leaves": zero, "w_saved": zero}), chunk)
    if not found.where("goes_on").isEmpty():
        weights = _weights(cut, nodes).withColumnRenamed("root", "below")
        weighed = found.join(weights, F.col("goes_on") & (F.col("key") == F.col("below")), "left").fillna(0, ["w_kids", "w_leaves", "w_saved"])
        nodes = _shard_nodes(weighed, chunk)
    # a chunk's root is a node of the story before
    whole = written(_merged(nodes).where("story = 0 or parent_key is not null"), "trie-merged")
    far = whole.where(F.col("edge") | ((F.col("depth") > 0) & (F.col("depth") % chunk == 0))).select(F.col("key").alias("above"), F.col("least").alias("above_least"))
    near = whole.where("not far_parent").withColumn("above_least", F.col("parent_least"))
    led = whole.where("far_parent").join(far, F.col("parent_key") == F.col("above"), "left").drop("above")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return near.unionByName(led).join(_ends(cut), F.col("key") == F.col("end"), "left").select(
        F.col("least").alias("conv_id"), "depth", F.col("above_least").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("full") - F.col("once")).alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
