"""Profiling, data quality and validation.

Every report is one fused aggregate (or a GROUPING SETS pass) producing a
small DataFrame; nothing is looped over on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.config import ZERO_RATE_BOUNDS
from stockpulse.operators.quantiles import quantile_columns


def overview(df: DataFrame) -> DataFrame:
    """Row count, column count and the dtype histogram (one row per
    dtype); head(5) is ``df.limit(5)``."""
    types: dict[str, int] = {}
    for f in df.schema.fields:
        types[f.dataType.simpleString()] = types.get(f.dataType.simpleString(), 0) + 1
    rows = F.array(*[F.struct(F.lit(k).alias("dtype"), F.lit(v).alias("n_columns")) for k, v in sorted(types.items())])
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), F.inline(rows))


def missing_report(df: DataFrame) -> DataFrame:
    """Per column missing count and %, sorted desc (one aggregate +
    stack)."""
    cols = df.columns
    a = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = a.unpivot(["_n"], cols, "column", "missing")
    return (long.select("column", "missing",
                        F.coalesce(F.try_divide(F.col("missing") * 100.0, F.col("_n")), F.lit(0.0)).alias("missing_pct"),
                        (F.col("_n") * len(cols)).alias("total_cells"))
                .orderBy(F.desc("missing"), "column"))


def duplicate_rows(df: DataFrame, key_columns: Sequence[str] | None = None) -> DataFrame:
    """Full-row duplicates and id-column duplicates, from one pass: equal rows are counted, then the rows of equal keys."""
    each = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    zero = F.lit(0).cast("long")
    if not key_columns:
        return each.agg((F.coalesce(F.sum("_n"), zero) - F.count(F.lit(1))).alias("duplicate_rows"))
    keys = each.groupBy(*key_columns).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_d"))
    return keys.agg((F.coalesce(F.sum("_n"), zero) - F.coalesce(F.sum("_d"), zero)).alias("duplicate_rows"),
                    (F.coalesce(F.sum("_n"), zero) - F.count(F.lit(1))).alias("duplicate_keys"))


def distinct_counts(df: DataFrame, columns: Sequence[str], list_max: int = 15) -> DataFrame:
    """Exact distinct count per column, with the sorted value list when
    it has at most ``list_max`` values.

    One pass: every row gives a (column, value) for each column, combined on
    the map side; a list is gathered only for columns whose count allows it.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    counts = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    few = counts.where(F.col("n_distinct") <= list_max).select(F.col("column").alias("_c"))
    lists = values.join(few, F.col("column") == F.col("_c"), "left_semi").groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("values"))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return every.join(counts, "column", "left").join(lists, "column", "left") \
        .select("column", F.coalesce("n_distinct", F.lit(0).cast("long")).alias("n_distinct"), "values")


def approx_distinct_counts(df: DataFrame, columns: Sequence[str], rsd: float = 0.01) -> DataFrame:
    """E4 at scale: HyperLogLog++ distinct counts (bounded memory)."""
    a = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
    return a.unpivot([], list(columns), "column", "approx_distinct")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """E5: count/mean/std/min/25/50/75/max per numeric column (exact
    linear quartiles)."""
    rows = []
    for c in columns:
        x = F.col(c).cast("double")
        qc = quantile_columns(df, c, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
        rows.append(df.agg(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                           F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
                    .select("column", "count", "mean", "std", "min", *qc, "max"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def global_stats(long: DataFrame, value: str = "sales") -> DataFrame:
    """min/max/mean/median/population std, zero cells and % over all
    day cells (long form)."""
    x = F.col(value).cast("double")
    med = quantile_columns(long.select(x.alias("_x")), "_x", [0.5], ["median"])[0]
    return long.agg(F.count(F.lit(1)).alias("cells"), F.min(x).alias("min"), F.max(x).alias("max"),
                    F.avg(x).alias("mean"), F.stddev_pop(x).alias("std_pop"),
                    F.count_if(x == 0).alias("zero_cells"),
                    (F.avg((x == 0).cast("double")) * 100).alias("zero_pct")).select(
        "cells", "min", "max", "mean", med, "std_pop", "zero_cells", "zero_pct")


def series_mean_distribution(long: DataFrame, value: str = "sales",
                             keys: Sequence[str] = ("item_id", "store_id")) -> DataFrame:
    """Distribution (min/25/50/75/max) of per-series means."""
    m = long.groupBy(*keys).agg(F.avg(F.col(value).cast("double")).alias("m"))
    qc = quantile_columns(m, "m", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return m.agg(F.count(F.lit(1)).alias("series"), F.min("m").alias("min"), F.max("m").alias("max")) \
            .select("series", "min", *qc, "max")


def hierarchy_counts(series: DataFrame) -> DataFrame:
    """Distinct products per (cat, dept) and series per (state, store).

    Rows are reduced to the distinct series once (a table with one row for
    each series, such as the day maps, gives the same as the panel); products
    are those series that come first of their item."""
    one = series.groupBy("cat_id", "dept_id", "state_id", "store_id", "item_id").agg(F.count(F.lit(1)).alias("_n"))
    g = one.groupingSets([["cat_id", "dept_id", "item_id"], ["state_id", "store_id"]],
                         "cat_id", "dept_id", "item_id", "state_id", "store_id") \
        .agg(F.count(F.lit(1)).alias("series"), F.grouping("cat_id").alias("_gc"))
    products = F.when(F.col("_gc") == 0, F.lit(1)).otherwise(F.col("series"))
    return g.select(F.when(F.col("_gc") == 0, "cat_dept").otherwise("state_store").alias("level"),
                    F.coalesce("cat_id", "state_id").alias("parent"), F.coalesce("dept_id", "store_id").alias("child"), products.alias("_k")) \
        .groupBy("level", "parent", "child").agg(F.sum("_k").alias("count"))


def calendar_continuity(calendar: DataFrame, days: DataFrame) -> DataFrame:
    """The calendar's span, rows and gaps, and how the days with rows lie in it.

    ``days`` has a column ``date`` (any number of rows a day), taken from the
    data itself; both sides are counted by day and meet in one full join.
    ``missing_dates``: days of the calendar's span that it lacks;
    ``sales_gaps``: days between the first and the last one with rows that have none.
    """
    known = calendar.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    sold = days.where(F.col("date").isNotNull()).groupBy("date").agg(F.count(F.lit(1)).alias("_s"))
    listed, has = F.when(F.col("_n").isNotNull(), F.col("date")), F.when(F.col("_s").isNotNull(), F.col("date"))
    a = known.join(sold, "date", "full").agg(
        F.min(listed).alias("first_date"), F.max(listed).alias("last_date"), F.sum("_n").alias("rows"), F.count("_n").alias("_known"),
        F.count_if(F.col("_n") > 1).alias("repeated_dates"), F.count("_s").alias("sales_days"),
        F.count_if(F.col("_s").isNotNull() & F.col("_n").isNotNull()).alias("sales_days_in_calendar"), F.min(has).alias("_from"), F.max(has).alias("_to"))
    span = F.datediff("last_date", "first_date") + 1
    return a.select("first_date", "last_date", "rows", span.alias("expected_days"), (F.col("_known") == span).alias("continuous"),
                    (span - F.col("_known")).cast("long").alias("missing_dates"), "repeated_dates", "sales_days", "sales_days_in_calendar",
                    (F.datediff("_to", "_from") + 1 - F.col("sales_days")).cast("long").alias("sales_gaps"))


def price_coverage(prices: DataFrame) -> DataFrame:
    """Price rows / (items x stores x weeks)."""
    a = prices.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("item_id").alias("items"),
                   F.count_distinct("store_id").alias("stores"), F.count_distinct("wm_yr_wk").alias("weeks"),
                   F.min("sell_price").alias("min_price"), F.max("sell_price").alias("max_price"))
    dense = F.col("items") * F.col("stores") * F.col("weeks")
    return a.withColumn("coverage", F.try_divide(F.col("rows").cast("double"), dense))


def event_frequency(calendar: DataFrame, days: DataFrame, snap_prefix: str = "snap_") -> DataFrame:
    """Event days by type (both slots) and SNAP days per state, with the rows and units that fall on them.

    ``days`` has (date, units) of the data, any number of rows a day; the
    calendar's days meet the sums of theirs.
    """
    per_day = days.groupBy("date").agg(F.count(F.lit(1)).alias("_rows"), F.sum("units").alias("_units"))
    snaps = [c for c in calendar.columns if c.startswith(snap_prefix)]
    kinds = [F.struct(F.lit("event_type").alias("kind"), F.col(c).alias("name")) for c in ("event_type_1", "event_type_2")]
    kinds += [F.struct(F.lit("snap_days").alias("kind"), F.when(F.col(c) == 1, F.lit(c)).alias("name")) for c in snaps]
    zero = F.lit(0).cast("long")
    return calendar.join(per_day, "date", "left").select("_rows", "_units", F.inline(F.array(*kinds))).where("name is not null") \
        .groupBy("kind", "name").agg(F.count(F.lit(1)).alias("count"), F.count("_rows").alias("days_with_rows"),
                                     F.coalesce(F.sum("_rows"), zero).alias("rows"), F.coalesce(F.sum("_units").cast("long"), zero).alias("units"))


def lag_leaks(features: DataFrame, lags: Sequence[int] = (7, 14, 28), keys: Sequence[str] = ("item_id", "store_id"), day: str = "day_index",
              value: str = "sales") -> DataFrame:
    """Each lag column against the sales that it must hold, found by day and not by the feature's own window.

    One row for each lag: rows, ``matched`` (the series has the day before by
    that many), ``mismatched`` (another value, or none, there), ``lead_in``
    (no such day) and ``lead_in_set`` (a value that is not the fill, 0, all the
    same). Every row asks for its days ``day - n``; they meet the series' own
    rows in one join.
    """
    asked = features.select(*keys, F.inline(F.array(*[F.struct(F.lit(n).alias("lag"), (F.col(day) - n).alias("_day"), F.col(f"lag_{n}").cast("double").alias("_got")) for n in lags])))
    own = features.select(*keys, F.col(day).alias("_day"), F.col(value).cast("double").alias("_true"), F.lit(True).alias("_there"))
    met = asked.join(own, [*keys, "_day"], "left")
    there = F.col("_there").isNotNull()
    return met.groupBy("lag").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(there).alias("matched"), F.count_if(there & ~F.col("_got").eqNullSafe(F.col("_true"))).alias("mismatched"),
        F.count_if(~there).alias("lead_in"), F.count_if(~there & ~F.col("_got").eqNullSafe(F.lit(0.0))).alias("lead_in_set"))


def validation_checks(features: DataFrame, states: Sequence[str], expected_rows, zero_bounds: tuple = ZERO_RATE_BOUNDS,
                      lags: Sequence[int] = (7, 14, 28), tolerance: float = 0.01, keys: Sequence[str] = ("item_id", "store_id"),
                      critical: Sequence[str] = ("item_id", "store_id", "day_index", "sales", "split")) -> DataFrame:
    """Named checks (check, passed, measured, detail).

    What is expected comes from outside the checked table: ``expected_rows``
    (a number or a one-value column, e.g. series of the source times days)
    and ``states`` (those of the source's calendar). A check whose columns
    are missing fails and names them, as one that raises would. The scalar
    checks are one aggregate, temporal order a window over each series, lag
    leakage the join of ``lag_leaks``.
    """
    from stockpulse.operators.features import feature_catalogue
    have, lo, hi = set(features.columns), *zero_bounds
    expected = (expected_rows if isinstance(expected_rows, Column) else F.lit(expected_rows)).cast("double")
    missing = sorted(set(feature_catalogue(states)) - have)

    def lacks(*needed: str) -> list[str]:
        return [c for c in needed if c not in have]

    def row(name: str, measured: Column, passed: Column, said: str, needed: Sequence[str] = ()) -> Column:
        gone = lacks(*needed)
        if gone:
            measured, passed, detail = F.lit(None), F.lit(False), F.lit("missing columns: " + ", ".join(gone))
        else:
            detail = F.concat(F.lit(said + "="), measured.cast("string"))
        return F.struct(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"), measured.cast("double").alias("measured"), detail.alias("detail"))

    def safe(needed: Sequence[str], a: Column) -> Column:
        return F.lit(None).cast("double") if lacks(*needed) else a

    a = features.agg(
        F.count(F.lit(1)).alias("rows"),
        safe(critical, F.count_if(F.greatest(*[F.col(c).isNull() for c in critical]))).alias("nulls"),
        safe(["sales"], F.count_if(F.col("sales") < 0)).alias("negative"),
        safe(["split"], F.count_distinct("split")).alias("splits"),
        safe(["sales"], F.avg((F.col("sales") == 0).cast("double"))).alias("zero_rate"))
    n = F.col("rows").cast("double")
    parts = [a.select(F.inline(F.array(
        row("row_count", F.col("rows"), F.abs(n - expected) <= expected * tolerance, "rows"),
        row("no_nulls_critical", F.col("nulls"), F.col("nulls") == 0, "nulls", critical),
        row("no_negative_sales", F.col("negative"), F.col("negative") == 0, "negative", ["sales"]),
        row("all_splits_present", F.col("splits"), F.col("splits") == 3, "splits", ["split"]),
        row("catalogue_columns", F.lit(len(missing)), F.lit(not missing), "missing " + ",".join(missing)),
        row("zero_rate_in_bounds", F.col("zero_rate"), F.col("zero_rate").between(lo, hi), "zero_rate", ["sales"]))))]
    if lacks(*keys, "day_index"):
        order = features.limit(0).agg(F.count(F.lit(1)).alias("bad"))
    else:
        gap = F.col("day_index") - F.lag("day_index").over(Window.partitionBy(*keys).orderBy("day_index"))
        order = features.select(gap.alias("gap")).agg(F.count_if(F.col("gap") != 1).alias("bad"))
    parts.append(order.select(F.inline(F.array(row("temporal_order", F.col("bad"), F.col("bad") == 0, "violations", [*keys, "day_index"])))))
    needed = [*keys, "day_index", "sales", *[f"lag_{k}" for k in lags]]
    if lacks(*needed):
        leaks = features.limit(0).agg(F.count(F.lit(1)).alias("bad"))
    else:
        leaks = lag_leaks(features, lags, keys).agg(F.coalesce(F.sum(F.col("mismatched") + F.col("lead_in_set")), F.lit(0)).alias("bad"))
    parts.append(leaks.select(F.inline(F.array(row("no_lag_leakage", F.col("bad"), F.col("bad") == 0, "mismatches", needed)))))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def check_summary(checks: DataFrame) -> DataFrame:
    """Passed / total."""
    return checks.agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"))


def dataset_summary(features: DataFrame) -> DataFrame:
    """E1 + E19: rows, columns, split counts, target mean/std/max, zero %."""
    y = F.col("sales").cast("double")
    return features.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(features.columns)).alias("columns"),
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "val").alias("val_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
        F.avg(y).alias("sales_mean"), F.stddev_pop(y).alias("sales_std"), F.max(y).alias("sales_max"),
        (F.avg((y == 0).cast("double")) * 100).alias("zero_pct"))


def features_per_group(spark, states: Sequence[str]) -> DataFrame:
    """Catalogue features per group."""
    from stockpulse.operators.features import catalogue_frame
    return catalogue_frame(spark, states).groupBy("group").agg(F.count(F.lit(1)).alias("features"))


def zero_rate_grouping_sets(features: DataFrame) -> DataFrame:
    """Zero rate overall / by category / by store / by split in one
    GROUPING SETS pass."""
    g = features.groupingSets([[], ["cat_id"], ["store_id"], ["split"]], "cat_id", "store_id", "split") \
        .agg(F.count(F.lit(1)).alias("rows"), F.avg((F.col("sales") == 0).cast("double")).alias("zero_rate"),
             F.grouping_id("cat_id", "store_id", "split").alias("_gid"))
    level = (F.when(F.col("_gid") == 7, "overall").when(F.col("_gid") == 3, "cat_id")
              .when(F.col("_gid") == 5, "store_id").otherwise("split"))
    return g.select(level.alias("level"), F.coalesce("cat_id", "store_id", "split", F.lit("ALL")).alias("value"),
                    "rows", "zero_rate")


def split_index(features: DataFrame) -> DataFrame:
    """Per split min/max day, distinct days, rows, date range."""
    return features.groupBy("split").agg(
        F.min("day_index").alias("min_day"), F.max("day_index").alias("max_day"),
        F.count_distinct("day_index").alias("n_days"), F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("start_date"), F.max("date").alias("end_date"))


def validation_report(features: DataFrame, states: Sequence[str], expected_rows) -> DataFrame:
    """Checks + split index + target stats as one (section, name,
    value) long table."""
    c = validation_checks(features, states, expected_rows).select(
        F.lit("check").alias("section"), F.col("check").alias("name"),
        F.concat_ws(" ", F.col("passed").cast("string"), "detail").alias("value"))
    s = split_index(features).select(F.lit("split").alias("section"), F.col("split").alias("name"),
                                     F.format_string("days %d-%d rows %d", "min_day", "max_day", "rows").alias("value"))
    d = dataset_summary(features)
    t = d.select(F.lit("target").alias("section"), F.lit("sales").alias("name"),
                 F.format_string("mean=%.4f std=%.4f max=%.0f zero_pct=%.2f", "sales_mean", "sales_std",
                                 "sales_max", "zero_pct").alias("value"))
    return c.unionByName(s).unionByName(t)
