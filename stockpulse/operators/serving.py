"""Parameterised serving queries behind the dashboard.

Each query runs over the whole impact table; per-SKU views are grouped
aggregates over every SKU (filter afterwards), not driver loops.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.functions.columns import cat_of, col_

SKU = ("item_id", "store_id")


def filter_rows(df: DataFrame, store: str | None = None, category: str | None = None,
                level: str | None = None) -> DataFrame:
    """M1: conjunctive optional filters (None / 'All' = no filter)."""
    conds = []
    if store not in (None, "All"):
        conds.append(F.col("store_id") == store)
    if category not in (None, "All"):
        conds.append(cat_of() == category)
    if level not in (None, "All"):
        conds.append(F.col("Risk_Level") == level)
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def exposure_topn(df: DataFrame, n: int = 20, sort_by: str = "exposure", **filters) -> DataFrame:
    """M2 + M3: financial exposure = (baseline - proposed cost)+, top-n by
    exposure (or risk score), with the days-to-stockout estimate."""
    f = filter_rows(df, **filters)
    f = f.withColumn("financial_exposure",
                     F.greatest(F.col("Baseline_Total_Cost") - F.col("Proposed_Total_Cost"), F.lit(0.0)))
    f = f.withColumn("days_to_stockout",
                     F.greatest(F.lit(1), F.floor(15 - F.col("Risk_Score") / 100.0 * 10).cast("int")))
    key = "financial_exposure" if sort_by == "exposure" else "Risk_Score"
    return (f.select("item_id", "store_id", "day_index", "Risk_Level", "Risk_Score",
                     "financial_exposure", "days_to_stockout")
             .orderBy(F.desc(key), "item_id", "store_id", "day_index").limit(n))


def sku_search(df: DataFrame, term: str, store: str | None = None) -> DataFrame:
    """M4: case-insensitive literal substring search on item_id (in a store)."""
    f = df.where(F.upper(F.col("item_id")).contains(term.strip().upper()))
    if store is not None:
        f = f.where(F.col("store_id") == store)
    return f


def sku_card(df: DataFrame, keys: Sequence[str] = SKU) -> DataFrame:
    """M5 + M6: per SKU - modal level / cause / action / intervention
    (lowest value on ties, like pandas ``mode()[0]``), mean score, mean
    recommended stock, mean savings, mean risk components (%)."""
    return df.groupBy(*keys).agg(
        F.mode("Risk_Level", True).alias("risk_level"),
        F.mode("Root_Cause", True).alias("root_cause"),
        F.mode("Recommended_Action", True).alias("action"),
        F.mode("Intervention", True).alias("intervention"),
        F.avg("Risk_Score").alias("mean_risk_score"),
        F.avg("Recommended_Stock_Level").alias("mean_recommended_stock"),
        F.avg(F.col("Baseline_Total_Cost") - F.col("Proposed_Total_Cost")).alias("avg_savings"),
        *[(F.avg(c) * 100.0).alias(f"{c}_pct") for c in ("comp_width", "comp_error", "comp_volat", "comp_calib")])


def stock_proxies(df: DataFrame, keys: Sequence[str] = SKU) -> DataFrame:
    """M7: current stock proxy 0.8 x mean actual, reorder point 0.5 x mean
    actual, safety stock = mean upper bound; at-risk when stock < safety."""
    a = df.groupBy(*keys).agg(F.avg(F.col("actual").cast("double")).alias("mean_actual"),
                              F.avg("upper_sym").alias("safety_stock"),
                              F.avg("Recommended_Stock_Level").alias("recommended_qty"))
    return (a.withColumn("current_stock", F.col("mean_actual") * 0.8)
             .withColumn("reorder_point", F.col("mean_actual") * 0.5)
             .withColumn("at_risk", (F.col("current_stock") < F.col("safety_stock")).cast("int")))


def sku_stats(df: DataFrame, keys: Sequence[str] = SKU) -> DataFrame:
    """M8: mean demand and CV = sample std / max(mean, 1e-9)."""
    y = F.col("actual").cast("double")
    return df.groupBy(*keys).agg(F.avg(y).alias("mean_demand"),
                                 (F.stddev_samp(y) / F.greatest(F.avg(y), F.lit(1e-9))).alias("cv"))


def residual_histogram(df: DataFrame, bins: int = 20, keys: Sequence[str] = SKU) -> DataFrame:
    """M9: residual (actual - point) histogram per SKU, ``bins`` buckets
    over each SKU's own [min, max] (one grouped pass + one aggregate)."""
    r = (F.col("actual").cast("double") - F.col("point"))
    d = df.select(*keys, r.alias("residual"))
    # per-SKU bounds by a partially aggregated groupBy (a hot SKU never sits
    # in one window partition); joined back without a hint (size-checked
    # broadcast by the planner, skew-aware sort-merge join otherwise)
    bounds = d.groupBy(*keys).agg(F.min("residual").alias("_mn"), F.max("residual").alias("_mx"))
    d = d.join(bounds, list(keys))
    width = (F.col("_mx") - F.col("_mn")) / bins
    b = F.when(F.col("_mx") == F.col("_mn"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("residual") - F.col("_mn")) / width), F.lit(bins - 1))).cast("int")
    return (d.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"),
                                                  F.min("residual").alias("bin_min"),
                                                  F.max("residual").alias("bin_max")))


def rescaled_interval(df: DataFrame, curve: DataFrame, confidence: float = 80.0, base_level: float = 0.9) -> DataFrame:
    """Interval re-scaled to another confidence by the width ratio of
    the calibration curve (ratio 1 when the level is missing)."""
    target = confidence / 100.0
    conf = curve.where(F.col("method") == "Conformal")
    base_w = conf.where(F.abs(F.col("level") - base_level) < 1e-9).select("avg_interval_width").scalar()
    tgt_w = (conf.where(F.abs(F.col("level") - target) < 0.05).orderBy(F.abs(F.col("level") - target))
                 .select("avg_interval_width").limit(1).scalar())
    base = F.coalesce(base_w, df.agg(F.avg("width_sym")).scalar())
    scale = F.when(base > 0, F.coalesce(tgt_w, base) / base).otherwise(F.lit(1.0))
    return df.select("item_id", "store_id", "day_index", "point",
                     (F.col("point") - F.col("width_sym") / 2 * scale).alias("lower_conf"),
                     (F.col("point") + F.col("width_sym") / 2 * scale).alias("upper_conf"))


def headline_kpis(df: DataFrame) -> DataFrame:
    """Distinct products, High-risk rows, net savings, service-level
    delta (pp)."""
    return df.agg(
        F.count_distinct("item_id").alias("total_products"),
        F.count_if(F.col("Risk_Level") == "High").alias("high_risk_rows"),
        (F.sum("Baseline_Total_Cost") - F.sum("Proposed_Total_Cost")).alias("net_savings"),
        ((F.avg((F.col("Proposed_Stockout_Units") == 0).cast("double"))
          - F.avg((F.col("Baseline_Stockout_Units") == 0).cast("double"))) * 100).alias("service_level_delta_pp"))


def inspect_sample(df: DataFrame, fraction: float = 0.05, seed: int = 42, min_rows: int = 10_000) -> DataFrame:
    """Seeded Bernoulli row sample (sampling is the feature)."""
    return df.sample(fraction=fraction, seed=seed)


def sample_items(df: DataFrame, k: int = 5, seed: int = 42, key: str = "item_id") -> DataFrame:
    """K pseudo-random items (hash order with a seed) and all their rows
    (semi join; the k-row side is broadcast - k is a parameter)."""
    items = (df.select(key).distinct()
               .orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(k))
    return df.join(F.broadcast(items), key, "left_semi")
