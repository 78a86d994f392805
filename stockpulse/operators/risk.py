"""Risk triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.config import (DecisionConfig, ROOT_CAUSE_FACTORS, ROOT_CAUSE_LOW,
                               ROOT_CAUSE_TEMPLATE)
from stockpulse.functions.columns import cat_of, isclose, lookup
from stockpulse.operators.quantiles import global_quantiles


def round_half_even(x: Column, digits: int) -> Column:
    """NumPy/pandas ``round``: scale, round half to even, unscale."""
    s = float(10 ** digits)
    return F.rint(x * s) / s


def minmax(df: DataFrame, c: str, out: str) -> DataFrame:
    """K1: (x - min) / (max - min); all 0 when min ~= max (NumPy isclose).

    min and max come from one merged scalar-subquery aggregate, so the
    global statistic costs one extra scan, no join and no single-task
    window."""
    mm = df.agg(F.min(c).alias("mn"), F.max(c).alias("mx"))
    mn, mx = mm.select("mn").scalar(), mm.select("mx").scalar()
    norm = F.when(isclose(mn, mx), F.lit(0.0)).otherwise((F.col(c) - mn) / (mx - mn))
    return df.withColumn(out, norm)


def minmax_many(df: DataFrame, cols: dict) -> DataFrame:
    """K1 for several columns: every min/max comes from ONE aggregate over
    the same input (merged scalar subqueries), so the normalisations do not
    nest."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__mn"), F.max(c).alias(f"{c}__mx")]
    mm = df.agg(*aggs)
    out = []
    for c, o in cols.items():
        mn, mx = mm.select(f"{c}__mn").scalar(), mm.select(f"{c}__mx").scalar()
        out.append(F.when(isclose(mn, mx), F.lit(0.0)).otherwise((F.col(c) - mn) / (mx - mn)).alias(o))
    return df.select("*", *out)


def category_penalty(segments: DataFrame, method: str = "Conformal") -> DataFrame:
    """B7 input: category -> coverage error of the chosen method."""
    return (segments.where((F.col("Segment_Type") == "cat_id") & (F.col("Method") == method))
                    .select(F.col("Segment_Name").alias("cat_id"),
                            F.col("Coverage_Error").alias("cat_coverage_error")))


def risk_scores(test: DataFrame, segments: DataFrame, cfg: DecisionConfig = DecisionConfig()) -> DataFrame:
    """K1-K3: raw components, min-max normalised, weighted score (0-100,
    rounded half-even to 2 dp).

    ``test`` carries actual, point, width_sym and rolling_std_28 (keyed
    rows: the key equi-join B6 replaces positional alignment)."""
    w = cfg.weights
    df = test.withColumn("cat_id", cat_of())
    # Dimension map join, missing -> 0.0 (no hint: planner size check)
    df = df.join(category_penalty(segments, cfg.calibration_method), "cat_id", "left")
    df = (df.withColumn("raw_error", F.abs(F.col("actual").cast("double") - F.col("point")))
            .withColumn("raw_width", F.col("width_sym"))
            .withColumn("raw_volatility", F.col("rolling_std_28"))
            .withColumn("raw_calib_penalty", F.coalesce(F.col("cat_coverage_error"), F.lit(0.0)))
            .drop("cat_coverage_error"))
    df = minmax_many(df, {"raw_width": "comp_width", "raw_error": "comp_error",
                          "raw_volatility": "comp_volat", "raw_calib_penalty": "comp_calib"})
    score = (F.lit(w["interval_width"]) * F.col("comp_width") + F.lit(w["forecast_error"]) * F.col("comp_error")
             + F.lit(w["historical_volatility"]) * F.col("comp_volat")
             + F.lit(w["calibration_penalty"]) * F.col("comp_calib")) * 100.0
    return df.withColumn("Risk_Score", round_half_even(score, 2))


def risk_bounds(scored: DataFrame, cfg: DecisionConfig = DecisionConfig(), mode: str = "select") -> DataFrame:
    """K4/K5: absolute score boundaries at the configured percentiles."""
    q = global_quantiles(scored, "Risk_Score", [cfg.low_max_pct, cfg.medium_max_pct], mode=mode)
    return q.select(F.col("q0").alias("low_threshold"), F.col("q1").alias("medium_threshold"))


def risk_levels(scored: DataFrame, cfg: DecisionConfig = DecisionConfig(), mode: str = "select",
                bounds: DataFrame | None = None) -> DataFrame:
    """K4: <= low -> Low, <= medium -> Medium, else High. ``bounds``: the
    one-row ``risk_bounds`` of the same rows, if already there."""
    b = bounds if bounds is not None else risk_bounds(scored, cfg, mode)
    lo, md = b.select("low_threshold").scalar(), b.select("medium_threshold").scalar()
    s = F.col("Risk_Score")
    return scored.withColumn("Risk_Level", F.when(s <= lo, "Low").when(s <= md, "Medium").otherwise("High"))


def level_counts(leveled: DataFrame, cfg: DecisionConfig = DecisionConfig(), mode: str = "select",
                 bounds: DataFrame | None = None) -> DataFrame:
    """K5: count per level with the boundaries and weights alongside."""
    b = bounds if bounds is not None else risk_bounds(leveled, cfg, mode)
    w = cfg.weights
    return (leveled.groupBy("Risk_Level").agg(F.count(F.lit(1)).alias("count"))
                   .select("Risk_Level", "count",
                           b.select("low_threshold").scalar().alias("low_threshold"),
                           b.select("medium_threshold").scalar().alias("medium_threshold"),
                           *[F.lit(float(v)).alias(f"w_{k}") for k, v in w.items()]))


def root_cause(level="Risk_Level") -> Column:
    """K6: Low -> fixed text; else the dominant component (ties resolved in
    the order volatility, error, calibration, width)."""
    comps = [F.col(c) for c, _ in ROOT_CAUSE_FACTORS]
    top = F.greatest(*comps)
    expr = F.when(F.col(level) == "Low", F.lit(ROOT_CAUSE_LOW))
    for c, text in ROOT_CAUSE_FACTORS:
        expr = expr.when(F.col(c) == top, F.lit(ROOT_CAUSE_TEMPLATE.format(text)))
    return expr


def recommendations(leveled: DataFrame, cfg: DecisionConfig = DecisionConfig()) -> DataFrame:
    """K6-K9: root cause, action, intervention (B8 literal map lookups),
    recommended stock, inventory increase, confidence level."""
    pct = lookup(cfg.buffer_pct, "Risk_Level")
    p = F.col("point")
    stock = round_half_even(F.greatest(p, p + (F.col("upper_sym") - p) * pct), 2)
    return (leveled.withColumn("Root_Cause", root_cause())
                   .withColumn("Recommended_Action", lookup(cfg.actions, "Risk_Level"))
                   .withColumn("Intervention", lookup(cfg.interventions, "Risk_Level"))
                   .withColumn("Recommended_Stock_Level", stock)
                   .withColumn("Inventory_Increase", round_half_even(F.col("Recommended_Stock_Level") - p, 2))
                   .withColumn("Confidence_Level", round_half_even(100.0 - F.col("Risk_Score"), 1)))


RISK_OUTPUT = ("item_id", "store_id", "day_index", "actual", "point", "lower_sym", "upper_sym",
               "Risk_Score", "Risk_Level", "Root_Cause", "Recommended_Action", "Intervention",
               "Recommended_Stock_Level", "Inventory_Increase", "Confidence_Level",
               "comp_width", "comp_error", "comp_volat", "comp_calib")


def risk_table(recs: DataFrame) -> DataFrame:
    """Output projection (reference 14 columns + day_index + comp_*)."""
    return recs.select(*RISK_OUTPUT)


def top_risk_items(risk: DataFrame, k: int = 10) -> DataFrame:
    """Top-k items by mean risk score."""
    return (risk.groupBy("item_id").agg(F.avg("Risk_Score").alias("mean_risk"))
                .orderBy(F.desc("mean_risk"), "item_id").limit(k))


def risk_heatmap(risk: DataFrame) -> DataFrame:
    """Share of High rows per store x category."""
    return (risk.withColumn("cat_id", cat_of())
                .groupBy("store_id", "cat_id")
                .agg(F.avg((F.col("Risk_Level") == "High").cast("double")).alias("high_risk_share")))


def store_risk(risk: DataFrame) -> DataFrame:
    """Mean risk by store, ascending."""
    return (risk.groupBy("store_id").agg(F.avg("Risk_Score").alias("avg_risk_score"))
                .orderBy("avg_risk_score", "store_id"))
