"""Split-conformal prediction.

Calibration scores stay a distributed column: thresholds are aggregates
over it (never an array shipped through the driver).  The only driver
work is the finite-sample level arithmetic on the calibration count n.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.functions.columns import col_
from stockpulse.operators.quantiles import global_quantiles, grouped_quantiles, pick, running_counts


# ------------------------------------------------------------------ H1/H2
def conformity_scores(cal: DataFrame, actual="actual", point="point") -> DataFrame:
    """H1: absolute and signed residuals on the calibration split."""
    y = col_(actual).cast("double")
    p = col_(point)
    return cal.select("*", F.abs(y - p).alias("abs_score"), (y - p).alias("signed_score"))


def long_scores(cal: DataFrame, actual="actual", point="point") -> DataFrame:
    """Both scores of each row under one another: (score: abs / signed, _v)."""
    kinds = [F.struct(F.lit(k).alias("score"), F.col(f"{k}_score").alias("_v")) for k in ("abs", "signed")]
    return conformity_scores(cal, actual, point).select(F.inline(F.array(*kinds)))


def score_counts(cal: DataFrame, actual="actual", point="point") -> DataFrame:
    """Both scores counted by value in one shuffle: (score, _v, _c, _cum, _n).

    Every threshold and score statistic (H3-H5, H8, H10, H11, J1) picks its
    ranks from this table; ``Pipeline`` writes it once. Runs a job."""
    return running_counts(long_scores(cal, actual, point), "_v", ["score"])


def corrected_level(n: int, alpha: float) -> float:
    """H2: min(ceil((n+1)(1-alpha))/n, 1)."""
    return min(math.ceil((n + 1) * (1.0 - alpha)) / n, 1.0)


def asymmetric_levels(n: int, alpha: float, correction: bool = True) -> tuple[float, float]:
    """H4: (lo, hi) levels for the signed scores."""
    if not correction:
        return alpha / 2, 1 - alpha / 2
    return min(math.ceil((n + 1) * (alpha / 2)) / n, 1.0), corrected_level(n, alpha / 2)


def higher_rank(n: int, level: float) -> int:
    """0-based order statistic NumPy's ``method='higher'`` picks."""
    return min(int(math.ceil((n - 1) * level)), n - 1)


# ------------------------------------------------------------------ H3-H5
def calibrate(cal: DataFrame, alpha: float = 0.1, correction: bool = True,
              actual="actual", point="point", n: int | None = None,
              mode: str = "select", counts: DataFrame | None = None) -> DataFrame:
    """H3-H5: one-row threshold table. ``counts``: ``score_counts`` of the
    same rows, if they are already there.

    Columns: n_calibration, alpha, level_sym, level_lo, level_hi,
    q_hat_symmetric, q_hat_lo_asymmetric, q_hat_hi_asymmetric.
    """
    n = n if n is not None else cal.count()
    if n == 0:
        raise ValueError("empty calibration split")
    lvl = corrected_level(n, alpha) if correction else 1 - alpha
    lo, hi = asymmetric_levels(n, alpha, correction)
    probs = [lvl, lo, hi]
    if mode == "select":
        q = pick(counts if counts is not None else score_counts(cal, actual, point), probs, ["score"])
    else:
        q = grouped_quantiles(long_scores(cal, actual, point), "_v", probs, ["score"], mode)
    return q.agg(*[F.max(F.when(F.col("score") == kind, F.col(f"q{i}"))).alias(f"q{i}")
                   for i, kind in enumerate(("abs", "signed", "signed"))]).select(
        F.lit(n).cast("long").alias("n_calibration"), F.lit(alpha).alias("alpha"),
        F.lit(lvl).alias("level_sym"), F.lit(lo).alias("level_lo"), F.lit(hi).alias("level_hi"),
        F.col("q0").alias("q_hat_symmetric"), F.col("q1").alias("q_hat_lo_asymmetric"),
        F.col("q2").alias("q_hat_hi_asymmetric"))


def thresholds_for_alphas(cal: DataFrame, alphas: Sequence[float], method: str = "linear",
                          actual="actual", point="point", n: int | None = None,
                          mode: str = "select", counts: DataFrame | None = None) -> DataFrame:
    """Q-hat for many alphas from the kept scores, one pass (from
    ``counts``, see ``score_counts``, where given).

    ``method='linear'`` is the Stage-4 threshold (linear interpolation);
    ``'higher'`` the Stage-5 variant (next order statistic up), computed
    as an exact discrete percentile.  Returns (alpha, level, q_hat)."""
    sc = conformity_scores(cal, actual, point).select("abs_score")
    n = n if n is not None else sc.count()
    levels = [corrected_level(n, a) for a in alphas]
    if method == "higher":
        probs = [(higher_rank(n, lv) + 0.5) / n for lv in levels]
        mode = {"exact": "disc", "select": "select_disc"}.get(mode, mode)
    else:
        probs = levels
    if counts is not None and mode.startswith("select"):
        q = pick(counts.where(F.col("score") == "abs"), probs, discrete=mode == "select_disc")
    else:
        q = global_quantiles(sc, "abs_score", probs, mode=mode)
    rows = [F.struct(F.lit(float(a)).alias("alpha"), F.lit(float(lv)).alias("level"),
                     F.col(f"q{i}").alias("q_hat"))
            for i, (a, lv) in enumerate(zip(alphas, levels))]
    return q.select(F.inline(F.array(*rows)))


# ------------------------------------------------------------------ H6-H9
def symmetric_interval(df: DataFrame, q_hat, point="point", prefix: str = "",
                       clip_upper: bool = False) -> DataFrame:
    """H6: [max(p - q, 0), p + q] (H11 also clips the upper bound at 0)."""
    p, q = col_(point), col_(q_hat) if not isinstance(q_hat, (int, float)) else F.lit(float(q_hat))
    lo = F.greatest(p - q, F.lit(0.0))
    hi = F.greatest(p + q, F.lit(0.0)) if clip_upper else p + q
    return df.withColumn(f"lower{prefix}", lo).withColumn(f"upper{prefix}", hi) \
             .withColumn(f"width{prefix}", F.col(f"upper{prefix}") - F.col(f"lower{prefix}"))


def asymmetric_interval(df: DataFrame, q_lo, q_hi, point="point", prefix: str = "_asym") -> DataFrame:
    """H7: [max(p + q_lo, 0), max(p + q_hi, 0)]."""
    p = col_(point)
    return (df.withColumn(f"lower{prefix}", F.greatest(p + col_(q_lo), F.lit(0.0)))
              .withColumn(f"upper{prefix}", F.greatest(p + col_(q_hi), F.lit(0.0)))
              .withColumn(f"width{prefix}", F.col(f"upper{prefix}") - F.col(f"lower{prefix}")))


def conformal_intervals(test: DataFrame, thresholds: DataFrame, point="point") -> DataFrame:
    """H9: both interval families side by side.

    The one-row threshold table is attached as scalar subqueries (evaluated
    once, inlined as literals) - no join with the test rows."""
    qs = thresholds.select("q_hat_symmetric").scalar()
    ql = thresholds.select("q_hat_lo_asymmetric").scalar()
    qh = thresholds.select("q_hat_hi_asymmetric").scalar()
    out = symmetric_interval(test, qs, point, prefix="_sym")
    return asymmetric_interval(out, ql, qh, point)


# ------------------------------------------------------------------ H10
def calibration_summary(cal: DataFrame, thresholds: DataFrame, actual="actual", point="point",
                        counts: DataFrame | None = None) -> DataFrame:
    """Thresholds + coverage bounds + abs-score statistics (one row).
    Least, greatest and quartile scores are ranks of the counted scores."""
    counts = counts if counts is not None else score_counts(cal, actual, point)
    names = ("score_min", "score_p25", "score_median", "score_p75", "score_max")
    ranks = pick(counts.where(F.col("score") == "abs"), [0.0, 0.25, 0.5, 0.75, 1.0])
    s = F.col("abs_score")
    moments = conformity_scores(cal, actual, point).agg(F.avg(s).alias("score_mean"), F.stddev_pop(s).alias("score_std"))
    t = thresholds.withColumns({"_q": ranks.select(F.struct(*[F.col(f"q{i}").alias(c) for i, c in enumerate(names)])).scalar(),
                                "_m": moments.select(F.struct("score_mean", "score_std")).scalar()})
    return t.select(
        "n_calibration", "alpha", (1 - F.col("alpha")).alias("coverage_target"),
        "q_hat_symmetric", "q_hat_lo_asymmetric", "q_hat_hi_asymmetric",
        (1 - F.col("alpha")).alias("coverage_lower_bound"),
        F.least(F.lit(1.0), 1 - F.col("alpha") + 1.0 / (F.col("n_calibration") + 1)).alias("coverage_upper_bound"),
        *[F.col(f"_q.{c}").alias(c) for c in names], "_m.score_mean", "_m.score_std")
