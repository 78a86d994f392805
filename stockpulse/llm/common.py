"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only where ``spark.checkpoint.dir`` is unset (tests on one machine) a
    fresh scratch folder is made and set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, used by one run only."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor never makes later steps recompute what
    came before, and a recomputation cannot deal the rows out differently.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Let the Arrow batches that go to Python workers end at ``BATCH_BYTES``, unless the session says where.

    By default their rows are counted, and whole texts make batches of tens of
    MB, which lie beside an executor's heap and again in each of its workers.
    """
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)


def fold(id_col: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(k)


def free_name(df: DataFrame, base: str) -> str:
    """``base`` with underscores put before it until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


_held: dict = {}


def hold(key, make):
    """What a Python worker keeps from task to task: one object at a time.

    Workers serve one stage after the other, so a new object (a model or an
    encoder with its word cache) takes the place of the last stage's, and
    the memory of that one goes back to the machine.
    """
    if key not in _held:
        _held.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        _held[key] = make()
    return _held[key]


def with_length(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, if there is such a column, set to the text's length in code points."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def with_bases(df: DataFrame, totals: DataFrame, part: str, n: str, base: str) -> DataFrame:
    """Add the sum of ``n`` over all parts before each row's own part.

    ``totals`` has a row for each part of a written table: its total. The
    running sum over them is the second pass of a two-pass prefix sum. Its
    size, and that of the broadcast, is 16 bytes for each partition of the
    table, however many rows the partitions have.
    """
    before = F.coalesce(F.sum(n).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = totals.select(part, before.cast("long").alias(base))
    return df.join(F.broadcast(bases), part)


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an edge list (u, v: long) as rows (node, root).

    Alternates large-star and small-star steps until the edges are stars
    around the least node of each component. Each round is a grouped minimum
    (combined on the map side) and a join; rounds are checkpointed. Roots map
    to themselves. Nodes without an edge are not in the result.
    """
    spark = edges.sparkSession
    shared = shared_dir(spark)
    spark.sparkContext.setCheckpointDir(shared)

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        near = both.join(least, "u")
        if large:
            out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            low = near.where("v < u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            out = low.union(least.where("m < u").select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.coalesce(F.expr("bit_xor(xxhash64(u, v))"), F.lit(0))).first()
        return r[0], r[1]

    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct().checkpoint()
    seen = mark(now)
    if not seen[0]:
        return spark.createDataFrame([], "node long, root long")
    while True:
        now = star(star(now, True), False).checkpoint()
        if (new := mark(now)) == seen:
            break
        seen = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
