"""Quantiles of one column, over all rows or per group (used by E5-E7, H3/H4,
H10, H11, I8, I11, J3, K4, L6).

Modes
-----
``select``       the default at every size: values are counted, the distinct
                 values dealt to ranges and counted up by a prefix sum, and
                 the values at the wanted ranks picked out. Exact, with
                 Spark's (and NumPy's) linear interpolation; no task holds
                 more than one range of values, and nothing comes to the
                 driver however many groups there are.
``select_disc``  the same for order statistics (``percentile_disc``).
``exact``, ``disc``, ``approx``  Spark's own aggregates, on request only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.session import ensure_checkpoint_dir


def running_counts(df: DataFrame, col: str, by: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """(by..., col, _c, _cum, _n) of each distinct value that is not null: its
    rows, the rows up to it and the rows of its group.

    Rows are counted per value (combined on the map side), and the distinct
    values are dealt to ranges of (group, value). That table is written to
    the session's folder, so the range ids are fixed from then on. The totals
    of the ranges give each range its offset in the group. Runs a job."""
    by, spark = list(by), df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_c"))
    ranged = counts.repartitionByRange(n_parts, *by, col).withColumn("_pid", F.spark_partition_id())
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stockpulse/counts-{uuid.uuid4().hex}"
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    local = ranged.withColumn("_upto", F.sum("_c").over(
        Window.partitionBy("_pid", *by).orderBy(col).rowsBetween(Window.unboundedPreceding, 0)))
    totals = ranged.groupBy("_pid", *by).agg(F.sum("_c").alias("_t"))
    group = Window.partitionBy(*by)   # as many rows as ranges
    before = F.sum("_t").over(group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col("_pid").alias("_p"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
                            F.coalesce(before, F.lit(0)).alias("_off"), F.sum("_t").over(group).alias("_n"))
    on = F.col("_pid") == F.col("_p")
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return local.join(offsets, on).select(*by, col, "_c", (F.col("_off") + F.col("_upto")).alias("_cum"), "_n")


def _selected(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str], discrete: bool,
              partitions: int | None = None) -> DataFrame:
    """Quantiles by rank: (by..., q0..qk). A group without values has no row;
    without ``by`` there is always one row."""
    value = F.col(col).cast("double").alias("_v")
    return pick(running_counts(df.select(*by, value), "_v", by, partitions), probs, by, discrete)


def pick(counted: DataFrame, probs: Sequence[float], by: Sequence[str] = (), discrete: bool = False) -> DataFrame:
    """The values at the wanted ranks of a counted column ``_v`` (see
    ``running_counts``): (by..., q0..qk). One counted table serves any number
    of probabilities and callers."""
    by = list(by)
    grid, n = F.lit([float(p) for p in probs]), F.col("_n")

    def rank(p, up: bool):
        if discrete:
            return F.greatest(F.ceil(n * p), F.lit(1)) - 1
        return F.ceil((n - 1) * p) if up else F.floor((n - 1) * p)

    def found(i, up: bool):
        return F.try_element_at("_m", 2 * i + int(up))

    def between(p, i):
        x, lo, hi = (n - 1) * p, found(i, False), found(i, True)
        return F.when(lo == hi, lo).otherwise((F.ceil(x) - x) * lo + (x - F.floor(x)) * hi)

    def wanted(up: bool):
        return F.transform(grid, lambda p, i: F.struct((2 * i + int(up)).alias("i"), rank(p, up).cast("long").alias("r")))

    # the wanted ranks that fall on this value: each rank is on one value of its group
    here = F.filter(F.concat(wanted(False), wanted(True)), lambda x: (x["r"] >= F.col("_cum") - F.col("_c")) & (x["r"] < F.col("_cum")))
    hits = counted.select(*by, "_v", "_n", F.explode(here).alias("_h"))
    at = hits.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("_h.i"), F.col("_v")))).alias("_m"), F.max("_n").alias("_n"))
    at = at.select(*by, F.transform(grid, (lambda p, i: found(i, False)) if discrete else between).alias("_q"))
    return at.select(*by, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))])


def grouped_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str],
                      mode: str = "select", accuracy: int = 100_000) -> DataFrame:
    """Quantiles per group: (by..., q0..qk). In ``select`` mode a group without values has no row.
    Any number of groups."""
    by, probs = list(by), [float(p) for p in probs]
    v = F.col(col).cast("double")
    if mode in ("select", "select_disc"):
        return _selected(df, col, probs, by, mode == "select_disc")
    if mode == "exact":
        a = df.groupBy(*by).agg(F.percentile(v, probs).alias("_q"))
    elif mode == "approx":
        a = df.groupBy(*by).agg(F.percentile_approx(v, probs, accuracy).alias("_q"))
    elif mode == "disc":
        a = df.groupBy(*by).agg(F.array(*[
            F.expr(f"percentile_disc({p!r}) WITHIN GROUP (ORDER BY CAST(`{col}` AS DOUBLE))") for p in probs]).alias("_q"))
    else:
        raise ValueError(mode)
    return a.select(*by, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))])


def global_quantiles(df: DataFrame, col: str, probs: Sequence[float], mode: str = "select",
                     accuracy: int = 100_000) -> DataFrame:
    """One-row DataFrame with columns q0..q{k-1} for the requested probs."""
    return grouped_quantiles(df, col, probs, [], mode, accuracy)


def select_quantiles(df: DataFrame, col: str, probs: Sequence[float], partitions: int | None = None) -> list[float]:
    """The linearly interpolated quantiles as numbers."""
    return list(_selected(df, col, [float(p) for p in probs], [], False, partitions).first())


def quantile_columns(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str], mode: str = "select"):
    """Global quantiles as scalar-subquery columns named ``names``."""
    q = global_quantiles(df, col, probs, mode=mode)
    return [q.select(f"q{i}").scalar().alias(nm) for i, nm in enumerate(names)]
