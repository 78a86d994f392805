"""Point-forecast metrics (G1-G6) and interval scoring.

Metrics are aggregate expressions, so any grouping (split, method, item,
store, level ...) evaluates all of them in one pass with partial
aggregation before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.functions.columns import col_, series_window

SERIES = ("item_id", "store_id")


# ------------------------------------------------------------------ G1-G4
def _err(actual, point) -> Column:
    return col_(actual).cast("double") - F.greatest(col_(point), F.lit(0.0))


def rmse(actual="actual", point="point") -> Column:
    """G1 (predictions clipped at 0 first, G6)."""
    return F.sqrt(F.avg(F.pow(_err(actual, point), 2)))


def mae(actual="actual", point="point") -> Column:
    """G2."""
    return F.avg(F.abs(_err(actual, point)))


def mape(actual="actual", point="point") -> Column:
    """Over y != 0 only, x100; 0 when no such row."""
    y = col_(actual).cast("double")
    return F.coalesce(F.avg(F.when(y != 0, F.abs(_err(actual, point) / y))) * 100.0, F.lit(0.0))


def wape(actual="actual", point="point") -> Column:
    """sum|e| / sum y x100; 0 when sum y = 0."""
    y = col_(actual).cast("double")
    s = F.sum(y)
    return F.when(s == 0, F.lit(0.0)).otherwise(F.try_divide(F.sum(F.abs(_err(actual, point))), s) * 100.0)


def point_metrics(df: DataFrame, by: Sequence[str] = (), actual="actual", point="point") -> DataFrame:
    """G1-G4 (+n) per group."""
    aggs = [F.count(F.lit(1)).alias("n"), rmse(actual, point).alias("rmse"),
            mae(actual, point).alias("mae"), mape(actual, point).alias("mape"),
            wape(actual, point).alias("wape")]
    return df.groupBy(*by).agg(*aggs)


# ------------------------------------------------------------------ G5
def naive_scale(train: DataFrame, keys: Sequence[str] = SERIES, order: Sequence[str] = ("day_index",),
                target: str = "sales", squared: bool = True) -> DataFrame:
    """Per-key scale of the one-step naive forecast on the train rows:
    mean((y_t - y_{t-1})^2) (RMSSE) or mean|y_t - y_{t-1}| (MSIS).

    ``keys`` = ('item_id',) with order ('store_id', 'day_index') is the
    reference's item-level form (diffs run across store boundaries)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(*order)
    y = F.col(target).cast("double")
    d = y - F.lag(y).over(w)
    v = F.pow(d, 2) if squared else F.abs(d)
    return (train.select(*keys, v.alias("_v")).groupBy(*keys)
                 .agg(F.avg("_v").alias("scale")))


def rmsse(eval_df: DataFrame, train: DataFrame, keys: Sequence[str] = SERIES,
          by: Sequence[str] = (), order: Sequence[str] | None = None,
          actual="actual", point="point", target: str = "sales") -> DataFrame:
    """Mean over keys of sqrt(MSE_eval / scale); scale 0/missing -> 1."""
    order = order or [c for c in SERIES if c not in keys] + ["day_index"]
    scale = naive_scale(train, keys, order, target)
    mse = (eval_df.groupBy(*by, *keys)
                  .agg(F.avg(F.pow(_err(actual, point), 2)).alias("mse")))
    j = mse.join(scale, list(keys), "left")
    s = F.when(F.col("scale").isNull() | (F.col("scale") == 0), F.lit(1.0)).otherwise(F.col("scale"))
    return j.groupBy(*by).agg(F.avg(F.sqrt(F.col("mse") / s)).alias("rmsse"))


def accuracy_by_split(predictions: DataFrame, features: DataFrame,
                      splits: Sequence[str] = ("val", "test"), keys: Sequence[str] = SERIES) -> DataFrame:
    """RMSE / MAE / MAPE / WAPE / RMSSE per evaluation split."""
    ev = predictions.where(F.col("split").isin(list(splits)))
    base = point_metrics(ev, ["split"])
    r = rmsse(ev, features.where(F.col("split") == "train"), keys, by=["split"])
    return base.join(r, "split", "left")


# ------------------------------------------------------------------ I1-I5
def covered(actual="actual", lower="lower", upper="upper") -> Column:
    y = col_(actual).cast("double")
    return (y >= col_(lower)) & (y <= col_(upper))


def winkler(actual="actual", lower="lower", upper="upper", alpha=0.1) -> Column:
    """I3 per row: w + (2/a)(l-y)+ + (2/a)(y-u)+ ; ``alpha`` may be a column."""
    y = col_(actual).cast("double")
    a = col_(alpha) if not isinstance(alpha, (int, float)) else F.lit(float(alpha))
    lo, hi = col_(lower), col_(upper)
    return ((hi - lo) + (2.0 / a) * F.greatest(lo - y, F.lit(0.0))
            + (2.0 / a) * F.greatest(y - hi, F.lit(0.0)))


def interval_aggs(alpha=0.1, actual="actual", lower="lower", upper="upper") -> list[Column]:
    """I1, I2, I3 (mean), I5 and I7 as aggregate columns."""
    cov = covered(actual, lower, upper)
    width = col_(upper) - col_(lower)
    y = col_(actual).cast("double")
    zero = y == 0
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(cov.cast("double")).alias("coverage"),
        F.avg(width).alias("avg_width"),
        F.avg(winkler(actual, lower, upper, alpha)).alias("mean_winkler"),
        F.avg(F.when(cov, width)).alias("sharpness"),
        F.count_if(zero).alias("n_zeros"),
        F.avg(F.when(zero, cov.cast("double"))).alias("zero_coverage"),
        F.avg(F.when(zero, width)).alias("zero_mean_width"),
    ]


def interval_scores(df: DataFrame, train: DataFrame | None, by: Sequence[str] = ("method",),
                    alpha: float = 0.1, keys: Sequence[str] = SERIES) -> DataFrame:
    """One row per ``by`` group.

    MSIS scale = mean |y_t - y_{t-1}| over train rows with differences taken
    inside each ``keys`` group (1 when 0; mean |y| of the evaluated rows, or
    1, when there is no train data)."""
    w = F.col("upper") - F.col("lower")
    agg = df.groupBy(*by).agg(
        *interval_aggs(alpha),
        F.avg(F.abs(F.col("actual").cast("double"))).alias("_mean_abs_y"),
        F.min(w).alias("width_min"),
        F.max(w).alias("width_max"),
        F.stddev_pop(w).alias("width_std"))
    from stockpulse.operators.quantiles import grouped_quantiles
    wq = grouped_quantiles(df.withColumn("_w", w), "_w", [0.25, 0.5, 0.75, 0.95], list(by))
    wq = wq.select(*by, *[F.col(f"q{i}").alias(n) for i, n in
                          enumerate(["width_p25", "width_median", "width_p75", "width_p95"])])
    agg = agg.join(wq, list(by), "left") if by else agg.join(wq)
    if train is not None:
        # mean over all train differences (taken inside each key group),
        # evaluated once as a scalar subquery
        from pyspark.sql import Window
        ww = Window.partitionBy(*keys).orderBy("day_index")
        y = F.col("sales").cast("double")
        scale = train.select(F.abs(y - F.lag(y).over(ww)).alias("_d")).agg(F.avg("_d")).scalar()
        scale = F.when(scale == 0, F.lit(1.0)).otherwise(scale)
    else:
        scale = F.lit(None).cast("double")
    fallback = F.when((F.col("_mean_abs_y").isNull()) | (F.col("_mean_abs_y") == 0), F.lit(1.0)) \
        .otherwise(F.col("_mean_abs_y"))
    out = agg.withColumn("msis", F.col("mean_winkler") / F.coalesce(scale, fallback))
    out = out.withColumn("coverage_error", F.abs(F.col("coverage") - F.lit(1.0 - alpha)))
    out = out.withColumn("zero_fraction", F.col("n_zeros") / F.col("n"))
    return out.drop("_mean_abs_y")


# ------------------------------------------------------------------ I6
def coverage_by_group(df: DataFrame, group: str, by: Sequence[str] = ("method",),
                      alpha: float = 0.1) -> DataFrame:
    """N, coverage, mean width, MIS per group, sorted by coverage."""
    cov = covered()
    return (df.groupBy(*by, group)
              .agg(F.count(F.lit(1)).alias("n"),
                   F.avg(cov.cast("double")).alias("coverage"),
                   F.avg(F.col("upper") - F.col("lower")).alias("mean_width"),
                   F.avg(winkler(alpha=alpha)).alias("mis"))
              .orderBy(*by, "coverage", group))


# ------------------------------------------------------------------ I11/I12
def score_ecdf(df: DataFrame, value: str, by: Sequence[str] = ("method",), partitions: int | None = None) -> DataFrame:
    """Empirical CDF per group - one row per distinct (group, value)
    with ecdf = #rows <= value / #rows in the group (= ``cume_dist``).

    A distributed prefix sum over the counted values
    (``quantiles.running_counts``); no task sees a whole group."""
    from stockpulse.operators.quantiles import running_counts
    counted = running_counts(df, value, by, partitions)
    return counted.select(*by, F.col(value), (F.col("_cum") / F.col("_n")).alias("ecdf"))


def quantile_grid(df: DataFrame, value: str, by: Sequence[str] = ("method",), points: int = 100) -> DataFrame:
    """I11 at scale: the ECDF sampled on a fixed probability grid (one
    aggregate, no global sort)."""
    probs = [i / points for i in range(points + 1)]
    from stockpulse.operators.quantiles import grouped_quantiles
    g = grouped_quantiles(df, value, probs, list(by))
    q = g.select(*by, F.array(*[F.col(f"q{i}") for i in range(len(probs))]).alias("_q"))
    return q.select(*by, F.posexplode("_q").alias("i", value)).select(
        *by, (F.col("i") / points).alias("prob"), value)


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = (),
              lo: Column | float | None = None, hi: Column | float | None = None) -> DataFrame:
    """Fixed-width histogram with ``bins`` buckets over [min, max].

    Bounds default to the global min/max (a merged scalar subquery), so the
    pass is one aggregate; the top edge falls into the last bucket (NumPy)."""
    v = F.col(value).cast("double")
    if lo is None or hi is None:
        mm = df.agg(F.min(v).alias("mn"), F.max(v).alias("mx"))
        lo = mm.select("mn").scalar() if lo is None else F.lit(lo)
        hi = mm.select("mx").scalar() if hi is None else F.lit(hi)
    else:
        lo, hi = (F.lit(lo) if isinstance(lo, (int, float)) else lo), (F.lit(hi) if isinstance(hi, (int, float)) else hi)
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((v - lo) / width), F.lit(bins - 1))).cast("int")
    return (df.where(F.col(value).isNotNull()).groupBy(*by, b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("count"))
              .select(*by, "bin", (lo + F.col("bin") * width).alias("bin_lo"),
                      (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "count"))
