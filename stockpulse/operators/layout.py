"""Physical layout and narrowing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INT_RANGES = (("byte", -128, 127), ("short", -32768, 32767), ("int", -2**31, 2**31 - 1))


def integer_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C4 input: min/max of every integer column in one aggregate."""
    return df.agg(*[x for c in columns for x in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))])


def narrow_plan(df: DataFrame, float_columns: Sequence[str] | None = None) -> dict[str, str]:
    """Target type per column - the smallest integer type holding
    the observed range (one aggregate pass) and float for doubles."""
    ints = [f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "short")]
    plan: dict[str, str] = {}
    if ints:
        r = integer_ranges(df, ints).first()
        for c in ints:
            lo, hi = r[f"{c}__min"], r[f"{c}__max"]
            if lo is None:
                continue
            for t, tlo, thi in INT_RANGES:
                if lo >= tlo and hi <= thi:
                    plan[c] = t
                    break
    doubles = float_columns if float_columns is not None else \
        [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    for c in doubles:
        plan[c] = "float"
    return plan


def narrow_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C4/C5 as a table: per integer column its observed range and the
    smallest safe integer type (one aggregate); doubles -> float."""
    r = integer_ranges(df, columns)
    rows = []
    for c in columns:
        mn, mx = F.col(f"{c}__min"), F.col(f"{c}__max")
        t = F.when((mn >= -128) & (mx <= 127), "byte").when((mn >= -32768) & (mx <= 32767), "short") \
             .when((mn >= -2**31) & (mx <= 2**31 - 1), "int").otherwise("long")
        rows.append(F.struct(F.lit(c).alias("column"), mn.cast("long").alias("min"), mx.cast("long").alias("max"),
                             t.alias("target_type")))
    return r.select(F.inline(F.array(*rows)))


def narrow_schema(df: DataFrame, plan: Mapping[str, str]) -> DataFrame:
    """One select of casts (ANSI casts raise on overflow, so a plan
    built from the observed ranges is safe)."""
    return df.select(*[F.col(c).cast(plan[c]).alias(c) if c in plan else F.col(c) for c in df.columns])


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                  mode: str = "overwrite", narrow: bool = False) -> None:
    """Snappy Parquet, optionally partitioned (e.g. split, store_id) and sorted within each file (e.g. item_id, day_index).

    Rows are rebalanced by the partition columns: Spark deals the rows of a
    value to one task each, and cuts those of a value that has more than the
    advisory partition size into several tasks (and files), so a value with
    most of the rows is never one task; small values share tasks. ``narrow``
    writes columns in the smallest safe types (C4, C5, C7).
    """
    out = narrow_schema(df, narrow_plan(df)) if narrow else df
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    if partition_by or sort_within:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    w = out.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON report (nested reports = struct columns)."""
    df.write.mode(mode).json(path)
