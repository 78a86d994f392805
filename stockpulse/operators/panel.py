"""Reshape, joins, set operations and cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.config import NO_EVENT
from stockpulse.functions.columns import named, quoted, series_window

EVENT_COLUMNS = ("event_name_1", "event_type_1", "event_name_2", "event_type_2")
CALENDAR_COLUMNS = ("d", "date", "wm_yr_wk", "weekday", "wday", "month", "year",
                    *EVENT_COLUMNS)


# ----------------------------------------------------------------- B1 melt
def day_columns(df: DataFrame, prefix: str = "d_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix) and c[len(prefix):].isdigit()]


#: Value columns of one block of ``melt``'s unpivot.
UNPIVOT_BLOCK = 32


def melt(wide: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str] | None = None,
         var_name: str = "d", value_name: str = "sales", method: str = "generate") -> DataFrame:
    """B1: wide -> long.

    ``generate`` builds one array of (name, value) structs and inlines it
    (a single Generate node, cheap to plan for ~2k columns); ``unpivot``
    uses Spark's Expand-based unpivot, block by block. Both give the same
    rows. The columns are written as one SQL expression: thousands of calls
    for single columns would take the driver a minute.
    """
    value_vars = list(value_vars or day_columns(wide))
    if method == "unpivot":
        return _unpivot(wide, list(id_vars), value_vars, var_name, value_name)
    pairs = ", ".join(f"struct({quoted(c)} AS {named(var_name)}, {named(c)} AS {named(value_name)})" for c in value_vars)
    return wide.select(*id_vars, F.expr(f"inline(array({pairs}))"))


def _unpivot(wide: DataFrame, id_vars: list[str], value_vars: list[str], var_name: str, value_name: str) -> DataFrame:
    """Unpivot of many columns of one type.

    An Expand compiles a projection for each column in every task, so a row
    first becomes one row for each block of columns, and those few columns are unpivoted.
    """
    types = {f.name: f.dataType for f in wide.schema.fields}
    if len(value_vars) <= UNPIVOT_BLOCK or any(types.get(c) != types.get(value_vars[0]) for c in value_vars) or value_vars[0] not in types:
        return wide.unpivot(id_vars, value_vars, var_name, value_name)
    kind, places = types[value_vars[0]].simpleString(), range(UNPIVOT_BLOCK)
    blocks = []
    for at in range(0, len(value_vars), UNPIVOT_BLOCK):
        cells = [named(c) for c in value_vars[at:at + UNPIVOT_BLOCK]]
        cells += [f"CAST(NULL AS {kind})"] * (UNPIVOT_BLOCK - len(cells))
        blocks.append(f"struct({at} AS _block, " + ", ".join(f"{c} AS _{k}" for k, c in zip(places, cells)) + ")")
    held = [f"_id{k}" for k in range(len(id_vars))]
    rows = wide.select(*[F.col(named(c)).alias(h) for c, h in zip(id_vars, held)], F.expr(f"inline(array({', '.join(blocks)}))"))
    cells = rows.unpivot([*held, "_block"], [f"_{k}" for k in places], "_place", "_value")
    at = F.col("_block") + F.substring("_place", 2, 10).cast("int")
    names = F.expr(f"array({', '.join(quoted(c) for c in value_vars)})")
    return cells.withColumn("_at", at).where(F.col("_at") < len(value_vars)).select(
        *[F.col(h).alias(c) for c, h in zip(id_vars, held)], F.get(names, F.col("_at")).alias(var_name), F.col("_value").alias(value_name))


def add_day_index(df: DataFrame, d: str = "d") -> DataFrame:
    """``d_123`` -> 123."""
    return df.withColumn("day_index", F.regexp_replace(F.col(d), "^d_", "").cast("int"))


# ------------------------------------------------------------ B2/B3 joins
def join_calendar(long: DataFrame, calendar: DataFrame,
                  columns: Iterable[str] = CALENDAR_COLUMNS, snap_prefix: str = "snap_") -> DataFrame:
    """B2: left join of the calendar on ``d``.

    The calendar holds one row per day (bounded by the length of the date
    range, ~2k rows for M5), so it is broadcast: the panel is not shuffled.
    """
    cols = [c for c in columns if c in calendar.columns]
    cols += [c for c in calendar.columns if c.startswith(snap_prefix) and c not in cols]
    return long.join(F.broadcast(calendar.select(*cols)), "d", "left")


def join_prices(long: DataFrame, prices: DataFrame,
                keys: Sequence[str] = ("store_id", "item_id", "wm_yr_wk")) -> DataFrame:
    """Left join of the weekly price fact.

    With ``spark.sql.requireAllClusterKeysForCoPartition=false`` a panel
    already hash-partitioned by (item_id, store_id) keeps its partitioning
    and only the price side is exchanged; the planner broadcasts the price
    side instead when its measured size is under the broadcast threshold.
    A larger price side is hashed in each partition (a row for each week of
    the partition's series), so the panel is not sorted for this join.
    """
    return long.join(prices.select(*keys, "sell_price").hint("shuffle_hash"), list(keys), "left")


# ------------------------------------------------------------ B4 / B5
def join_audit(left: DataFrame, right: DataFrame, keys: Sequence[str],
               probe_col: str, how: str = "left") -> DataFrame:
    """Row-count change, duplicate right keys, unmatched rows and %.

    Returns one row, from one pass over each table. Left rows are counted by
    key, so a hot key is one row; those counts meet the right side's counts
    by key, and the joined rows are their products. ``probe_col`` is a
    right-side column; its NULLs on matched rows count as unmatched.
    """
    keys = list(keys)
    have = [F.col(c).isNotNull() for c in keys]
    known = have[0]
    for h in have[1:]:
        known = known & h
    lefts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l"))
    rights = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r"), F.count_if(F.col(probe_col).isNull()).alias("_nulls"))
    met = lefts.join(rights.where(known), keys, "full")
    zero = F.lit(0).cast("long")
    n_left, n_right = F.coalesce("_l", zero), F.coalesce("_r", zero)
    outer = how in ("left", "leftouter", "left_outer")
    joined = n_left * (F.greatest(n_right, F.lit(1)) if outer else n_right)
    unmatched = F.when(n_right == 0, n_left if outer else zero).otherwise(n_left * F.coalesce("_nulls", zero))
    total = met.agg(F.coalesce(F.sum(n_left), zero).alias("rows_before"), F.coalesce(F.sum(joined), zero).alias("rows_after"),
                    F.count_if(n_right > 1).alias("duplicate_right_keys"), F.coalesce(F.sum(unmatched), zero).alias("unmatched_rows"))
    return total.select("rows_before", "rows_after", (F.col("rows_after") - F.col("rows_before")).alias("row_change"), "duplicate_right_keys", "unmatched_rows",
                        F.coalesce(F.try_divide(F.col("unmatched_rows") * 100.0, F.col("rows_after")), F.lit(0.0)).alias("unmatched_pct"))


def key_coverage(a: DataFrame, b: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """For each named key, its distinct values in A, in B, and in both.

    ``keys`` maps a name to the key's columns (in both tables). Each table is
    read once: its rows become flag bits (1: in A, 2: in B) of their distinct
    combinations, each combination becomes one row for each key, and the bits
    of a key's values are put together and counted.
    """
    every = list(dict.fromkeys(c for cs in keys.values() for c in cs))
    flagged = [t.groupBy(*every).agg(F.max(F.lit(bit)).alias("bit")) for t, bit in ((a, 1), (b, 2))]
    names = F.array(*[F.struct(F.lit(k).alias("key"), F.when(F.greatest(*[F.col(c).isNull().cast("int") for c in cs], F.lit(0)) == 0,
                                                             F.to_json(F.struct(*[F.col(c).cast("string") for c in cs]))).alias("value")) for k, cs in keys.items()])
    values = flagged[0].unionByName(flagged[1]).select("bit", F.inline(names)).where("value is not null") \
        .groupBy("key", "value").agg(F.bit_or("bit").alias("bits"))
    return values.groupBy("key").agg(F.count_if(F.col("bits").isin(1, 3)).alias("n_left"), F.count_if(F.col("bits") >= 2).alias("n_right"),
                                     F.count_if(F.col("bits") == 3).alias("n_common"))


# ------------------------------------------------------------ B7-B12
def map_join(df: DataFrame, dim: DataFrame, on: str | Sequence[str], value_col: str,
             default=0.0, alias: str | None = None) -> DataFrame:
    """Dimension map left join, missing -> ``default``.

    No hint: the planner broadcasts the dimension when its measured size is
    under the threshold, and falls back to a sort-merge join otherwise.
    """
    on = [on] if isinstance(on, str) else list(on)
    out = df.join(dim.select(*on, value_col), on, "left")
    return out.withColumn(alias or value_col, F.coalesce(F.col(value_col), F.lit(default)))


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def pivot_grid(df: DataFrame, row_key: str, col_key: str, value: str,
               col_values: Sequence | None = None) -> DataFrame:
    """Pivot (row_key x col_key -> value); listed values avoid a
    distinct-values job."""
    g = df.groupBy(row_key)
    g = g.pivot(col_key, list(col_values)) if col_values is not None else g.pivot(col_key)
    return g.agg(F.first(value)).orderBy(row_key)


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """Sorted distinct values (filter options)."""
    return df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c)


# ------------------------------------------------------------ C1-C3
def fill_events(df: DataFrame, value: str = NO_EVENT, columns=EVENT_COLUMNS) -> DataFrame:
    """NULL event columns -> 'no_event'."""
    return df.fillna({c: value for c in columns if c in df.columns})


def fill_prices(df: DataFrame, price: str = "sell_price", keys=("item_id", "store_id"),
                order: str = "day_index") -> DataFrame:
    """Forward-fill then back-fill the price inside each series, rest 0.

    Forward fill = last non-null over (unbounded preceding, current row);
    the only nulls left after it are the leading ones, which the back fill
    turns into the first non-null price of the series (whole-partition
    frame, evaluated once per series).  Same window spec as every other
    series feature, so it shares their exchange and sort.
    """
    w = series_window(keys, order)
    ffill = F.last(price, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    first_seen = F.first(price, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(price, F.coalesce(ffill, first_seen, F.lit(0.0)))


def zero_fill(df: DataFrame, columns: Iterable[str], value=0.0) -> DataFrame:
    """Lead-in NULLs of lag/rolling/diff columns -> 0."""
    return df.select(*[F.coalesce(F.col(c), F.lit(value)).alias(c) if c in set(columns) else F.col(c)
                       for c in df.columns])
