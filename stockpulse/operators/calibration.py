"""Calibration and reliability.

All levels / methods / segment types are evaluated in one pass each: the
per-level intervals are generated with ``inline`` over a config-sized
array (no join), segments use GROUPING SETS.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.functions.columns import cat_of, dept_of, isclose, state_of
from stockpulse.operators.conformal import thresholds_for_alphas
from stockpulse.operators.metrics import covered, winkler
from stockpulse.operators.quantiles import global_quantiles

SEGMENT_TYPES = ("store_id", "state_id", "cat_id", "dept_id")


def level_metrics(alpha_col: str = "alpha") -> list:
    """J1 metric set (Stage-5 definitions: sharpness = pop. std of width,
    zero-demand coverage 0.0 when there is no zero row)."""
    w = F.col("upper") - F.col("lower")
    cov = covered().cast("double")
    zero = F.col("actual") == 0
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(cov).alias("empirical_coverage"),
        F.avg(w).alias("avg_interval_width"),
        F.stddev_pop(w).alias("sharpness_std"),
        F.avg(winkler(alpha=F.col(alpha_col))).alias("winkler_score"),
        F.coalesce(F.avg(F.when(zero, cov)), F.lit(0.0)).alias("zero_demand_coverage"),
    ]


def conformal_level_intervals(test: DataFrame, cal: DataFrame, levels: Sequence[float],
                              n_cal: int | None = None, mode: str = "select",
                              counts: DataFrame | None = None) -> DataFrame:
    """Stage-5 conformal intervals for every level ('higher' quantile, both
    bounds clipped at 0): test rows x levels via ``inline`` (levels are a
    config list, so the fan-out is bounded). The thresholds of all levels are
    one scalar subquery, a map by alpha."""
    alphas = [round(1.0 - lv, 10) for lv in levels]
    thr = thresholds_for_alphas(cal, alphas, method="higher", n=n_cal, mode=mode, counts=counts)
    by_alpha = thr.agg(F.map_from_entries(F.collect_set(F.struct("alpha", "q_hat")))).scalar()
    structs = []
    for lv, a in zip(levels, alphas):
        q, p = F.col("_q_hats")[F.lit(float(a))], F.col("point")
        structs.append(F.struct(F.lit(float(lv)).alias("level"), F.lit(float(a)).alias("alpha"),
                                F.greatest(p - q, F.lit(0.0)).alias("lower"),
                                F.greatest(p + q, F.lit(0.0)).alias("upper")))
    keep = [c for c in test.columns if c not in ("lower", "upper", "level", "alpha")]
    return test.withColumn("_q_hats", by_alpha).select(*keep, F.inline(F.array(*structs)))


def calibration_curve(test: DataFrame, cal: DataFrame, levels: Sequence[float],
                      quantile_test: DataFrame | None = None, native_level: float = 0.9,
                      n_cal: int | None = None, mode: str = "select",
                      counts: DataFrame | None = None) -> DataFrame:
    """J1 + J2: one row per (method, level).

    Conformal at every level, plus the quantile method at its native level
    when ``quantile_test`` (with lower/upper columns) is given."""
    ci = conformal_level_intervals(test, cal, levels, n_cal, mode, counts).withColumn("method", F.lit("Conformal"))
    frames = [ci.select("method", "level", "alpha", "actual", "lower", "upper")]
    if quantile_test is not None:
        frames.append(quantile_test.select(F.lit("Quantile").alias("method"),
                                           F.lit(float(native_level)).alias("level"),
                                           F.lit(round(1 - native_level, 10)).alias("alpha"),
                                           "actual", "lower", "upper"))
    long = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    out = long.groupBy("method", "level", "alpha").agg(*level_metrics())
    return (out.withColumn("target_coverage", F.col("level"))
               .withColumn("coverage_error", F.abs(F.col("empirical_coverage") - F.col("level")))
               .drop("alpha"))


def methods_at_level(test: DataFrame, cal: DataFrame, quantile_test: DataFrame, level: float = 0.9,
                     extra: Sequence[str] = ("rolling_std_28",), n_cal: int | None = None,
                     mode: str = "select", counts: DataFrame | None = None) -> DataFrame:
    """Long table (Method, keys, actual, lower, upper, extras) of both
    methods at one level (the frame the J3/J5 analyses group)."""
    keys = ["item_id", "store_id", "day_index"]
    ci = conformal_level_intervals(test, cal, [level], n_cal, mode, counts)
    cols = [*keys, "actual", "lower", "upper", *extra]
    return (ci.select(F.lit("Conformal").alias("Method"), *cols)
              .unionByName(quantile_test.select(F.lit("Quantile").alias("Method"), *cols)))


def volatility_regimes(long: DataFrame, feature: str = "rolling_std_28", pct: float = 0.75,
                       mode: str = "select") -> DataFrame:
    """cutoff = pct-quantile of the volatility feature over the frame;
    >= cutoff -> 'High Volatility' else 'Normal'; per method x regime."""
    cut = global_quantiles(long, feature, [pct], mode=mode).select("q0").scalar()
    reg = F.when(F.col(feature) >= cut, "High Volatility").otherwise("Normal")
    return (long.withColumn("Regime", reg).groupBy("Method", "Regime")
                .agg(F.count(F.lit(1)).alias("Count"),
                     F.avg(covered().cast("double")).alias("Coverage"),
                     F.avg(F.col("upper") - F.col("lower")).alias("Avg_Width")))


def with_hierarchy(df: DataFrame) -> DataFrame:
    """State / category / department from the id strings."""
    out = df
    if "state_id" not in df.columns:
        out = out.withColumn("state_id", state_of())
    if "cat_id" not in df.columns:
        out = out.withColumn("cat_id", cat_of())
    if "dept_id" not in df.columns:
        out = out.withColumn("dept_id", dept_of())
    return out


def segment_calibration(long: DataFrame, target: float = 0.90,
                        segment_types: Sequence[str] = SEGMENT_TYPES) -> DataFrame:
    """(Method, Segment_Type, Segment_Name, Count, Coverage,
    Coverage_Error, Avg_Width) for every segment type in one
    GROUPING SETS aggregation."""
    df = with_hierarchy(long)
    sets = [[F.col("Method"), F.col(s)] for s in segment_types]
    g = df.groupingSets(sets, "Method", *segment_types).agg(
        F.count(F.lit(1)).alias("Count"),
        F.avg(covered().cast("double")).alias("Coverage"),
        F.avg(F.col("upper") - F.col("lower")).alias("Avg_Width"),
        *[F.grouping(s).alias(f"_g_{s}") for s in segment_types])
    seg_type = None
    seg_name = None
    for s in segment_types:
        cond = F.col(f"_g_{s}") == 0
        seg_type = F.when(cond, F.lit(s)) if seg_type is None else seg_type.when(cond, F.lit(s))
        seg_name = F.when(cond, F.col(s)) if seg_name is None else seg_name.when(cond, F.col(s))
    return g.select("Method", seg_type.alias("Segment_Type"), seg_name.alias("Segment_Name"),
                    "Count", "Coverage", F.abs(F.col("Coverage") - F.lit(target)).alias("Coverage_Error"),
                    "Avg_Width")


def worst_segments(segments: DataFrame, k: int = 15) -> DataFrame:
    """The k worst-calibrated segments (top-k is the feature)."""
    return segments.orderBy(F.desc("Coverage_Error"), "Method", "Segment_Type", "Segment_Name").limit(k)


def method_comparison_at(curve: DataFrame, level: float = 0.9, tol: float = 1e-9) -> DataFrame:
    """Both methods' rows at one level, picked by tolerance."""
    return curve.where(isclose("level", F.lit(level), rtol=0.0, atol=tol)).select(
        "method", "level", "empirical_coverage", "avg_interval_width", "winkler_score", "coverage_error")


def segment_view(segments: DataFrame, segment_type: str = "store_id") -> DataFrame:
    """One segment type, coverage in % (1 dp), methods side by side."""
    s = segments.where(F.col("Segment_Type") == segment_type)
    return (s.groupBy("Segment_Name").pivot("Method", ["Conformal", "Quantile"])
              .agg(F.first(F.round(F.col("Coverage") * 100.0, 1)))
              .withColumnRenamed("Conformal", "conformal_coverage_pct")
              .withColumnRenamed("Quantile", "quantile_coverage_pct"))
