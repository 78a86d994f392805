"""Forecast models.

Two families share one output contract (keys, split, actual, point /
q05, q50, q95):

* deterministic baselines expressed as column expressions (point =
  rolling mean; quantiles from the rolling mean / std) - exactly
  reproducible, so every downstream stage is checkable by SQL;
* Spark ML estimators: Tweedie GLM (log link), GBT with early stopping on
  the validation split, IRLS quantile regression, seeded random search.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.functions.columns import pav3

# Fixed value: standard normal 95 % quantile used by the baseline quantile forecaster.
Z95 = 1.6448536269514722
KEYS = ("item_id", "store_id", "day_index")


# ------------------------------------------------------------ baselines
def baseline_point(features: DataFrame, window: int = 28,
                   carry: Sequence[str] = ("rolling_mean_7", "rolling_mean_28", "rolling_std_28",
                                           "has_any_event", "sell_price")) -> DataFrame:
    """prediction table for val and test - keys, split, actual and the
    rolling-mean point forecast (clipped at 0, F4)."""
    return (features.where(F.col("split").isin("val", "test"))
                    .select(*KEYS, "split", F.col("sales").alias("actual"),
                            F.greatest(F.col(f"rolling_mean_{window}"), F.lit(0.0)).alias("point"),
                            *carry))


def baseline_quantiles_raw(df: DataFrame, z: float = Z95) -> DataFrame:
    """Raw baseline quantiles: q05/q95 = 28-day mean -/+ z * 28-day std,
    q50 = 7-day mean.  The median comes from a shorter window, so raw
    quantiles can cross - which F9 then repairs."""
    m28, s28 = F.col("rolling_mean_28"), F.col("rolling_std_28")
    return df.select("*", (m28 - z * s28).alias("q05_raw"), F.col("rolling_mean_7").alias("q50_raw"),
                     (m28 + z * s28).alias("q95_raw"))


def clip_quantiles(df: DataFrame, cols=("q05", "q50", "q95"), suffix: str = "_raw") -> DataFrame:
    """F8: quantile predictions clipped at 0."""
    for c in cols:
        df = df.withColumn(f"{c}_clip", F.greatest(F.col(f"{c}{suffix}"), F.lit(0.0)))
    return df


def non_crossing(df: DataFrame, a="q05_clip", b="q50_clip", c="q95_clip",
                 out=("q05", "q50", "q95")) -> DataFrame:
    """isotonic correction of each row's three quantiles (closed-form
    pool-adjacent-violators, pure column expressions)."""
    g1, g2, g3 = pav3(a, b, c)
    return df.withColumn(out[0], g1).withColumn(out[1], g2).withColumn(out[2], g3)


def crossing_report(df: DataFrame) -> DataFrame:
    """crossing count and % before and after the correction."""
    before = (F.col("q05_clip") > F.col("q50_clip")) | (F.col("q50_clip") > F.col("q95_clip"))
    after = (F.col("q05") > F.col("q50")) | (F.col("q50") > F.col("q95"))
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(before).alias("n_cross_raw"),
                  F.count_if(after).alias("n_cross_corrected")) \
             .withColumn("pct_cross_raw", F.col("n_cross_raw") * 100.0 / F.col("n")) \
             .withColumn("pct_cross_corrected", F.col("n_cross_corrected") * 100.0 / F.col("n"))


def nearest_quantile(available: Sequence[float], target: float) -> float:
    return min(available, key=lambda q: abs(q - target))


def quantile_interval(df: DataFrame, alpha: float = 0.1,
                      available: Sequence[float] = (0.05, 0.50, 0.95)) -> DataFrame:
    """(1-alpha) interval from the nearest trained quantiles, bounds
    clipped at 0; adds lower / median / upper / width."""
    lq = nearest_quantile(available, round(alpha / 2, 4))
    uq = nearest_quantile(available, round(1 - alpha / 2, 4))
    name = lambda q: f"q{int(round(q * 100)):02d}"
    return (df.withColumn("lower", F.greatest(F.col(name(lq)), F.lit(0.0)))
              .withColumn("median", F.col("q50"))
              .withColumn("upper", F.greatest(F.col(name(uq)), F.lit(0.0)))
              .withColumn("width", F.col("upper") - F.col("lower")))


def baseline_quantile_frame(preds: DataFrame, features: DataFrame | None = None, alpha: float = 0.1) -> DataFrame:
    """F7/F8/F9/F10 for the baseline: prediction rows with q05/q50/q95 and
    the interval.  ``preds`` must carry rolling_mean_7/28 and
    rolling_std_28."""
    q = baseline_quantiles_raw(preds)
    q = non_crossing(clip_quantiles(q))
    return quantile_interval(q, alpha)


# ------------------------------------------------------------ Spark ML
def assemble(df: DataFrame, feature_cols: Sequence[str], string_cols: Sequence[str] = (),
             out: str = "features"):
    """StringIndexer (handleInvalid='keep') + VectorAssembler stages."""
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    stages = []
    cols = []
    for c in feature_cols:
        if c in string_cols:
            stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"))
            cols.append(f"{c}_idx")
        else:
            cols.append(c)
    stages.append(VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep"))
    return stages


def tweedie_model(feature_cols: Sequence[str], string_cols: Sequence[str] = (), label: str = "sales",
                  variance_power: float = 1.5, max_iter: int = 25, reg: float = 0.0):
    """F2: Tweedie GLM with log link (variance power 1.5) as a Pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GeneralizedLinearRegression
    glm = GeneralizedLinearRegression(family="tweedie", variancePower=variance_power, linkPower=0.0,
                                      labelCol=label, featuresCol="features", maxIter=max_iter, regParam=reg,
                                      predictionCol="raw_prediction")
    return Pipeline(stages=[*assemble(None, feature_cols, string_cols), glm])


def gbt_model(feature_cols: Sequence[str], string_cols: Sequence[str] = (), label: str = "sales",
              max_iter: int = 50, max_depth: int = 5, step: float = 0.1, seed: int = 42,
              validation_col: str | None = "is_val", max_bins: int = 64, **params):
    """gradient-boosted trees; early stopping on the rows flagged by
    ``validation_col`` (the temporal validation split). ``params`` are further
    parameters of Spark's ``GBTRegressor``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor
    kw = dict(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=max_depth,
              stepSize=step, seed=seed, maxBins=max_bins, predictionCol="raw_prediction", **params)
    if validation_col:
        kw["validationIndicatorCol"] = validation_col
    return Pipeline(stages=[*assemble(None, feature_cols, string_cols), GBTRegressor(**kw)])


def tweedie_inputs(numeric: Sequence[str], codes: Sequence[str], dictionary, reg: float = 1e-4, max_iter: int = 25, **options):
    """F1 / F2: the Tweedie pipeline over the whole catalogue: scaled numbers, indicators of the codes (those of very many values as numbers)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from stockpulse.operators.encode import indicators
    split = list(indicators(codes, dictionary))
    plain = [*numeric, *[c for c in codes if c not in split]]
    stages = tweedie_model([*plain, *[f"{c}_of" for c in split]], reg=reg, max_iter=max_iter, **options).getStages()
    return Pipeline(stages=[OneHotEncoder(inputCols=split, outputCols=[f"{c}_of" for c in split], handleInvalid="keep"), *stages])


def gbt_inputs(numeric: Sequence[str], codes: Sequence[str], dictionary, most: int = 1000, **options):
    """Boosted trees over the whole catalogue; codes are categories to the trees (those of more than ``most`` values are numbers)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer
    wide = [c for c in codes if dictionary.sizes[c.removesuffix("_code")] >= most]
    bins = max([64, *[dictionary.sizes[c.removesuffix("_code")] + 2 for c in codes if c not in wide]])
    names = [*numeric, *[f"{c}_num" if c in wide else c for c in codes]]
    stages = gbt_model(names, max_bins=bins, **options).getStages()
    as_number = "SELECT *" + "".join(f", CAST({c} AS DOUBLE) AS {c}_num" for c in wide) + " FROM __THIS__"
    return Pipeline(stages=[SQLTransformer(statement=as_number), *stages] if wide else stages)


def fit_rows(features: DataFrame, pipeline, train_splits=("train",), val_split: str = "val") -> DataFrame:
    """The rows a pipeline is fitted on: validation rows come in, flagged
    ``is_val``, only for an estimator that stops early on flagged rows."""
    last = pipeline.getStages()[-1] if hasattr(pipeline, "getStages") else pipeline
    early = last.hasParam("validationIndicatorCol") and last.isDefined("validationIndicatorCol")
    splits = (*train_splits, val_split) if early else train_splits
    return features.where(F.col("split").isin(*splits)).withColumn("is_val", F.col("split") == val_split)


def vectors(rows: DataFrame, pipeline, label: str = "sales") -> DataFrame:
    """(keys, split, label, features): the inputs as the stages before a pipeline's estimator make them.

    Written once, they serve every trial of a search."""
    from pyspark.ml import Pipeline
    made = Pipeline(stages=pipeline.getStages()[:-1]).fit(rows).transform(rows)
    return made.select(*KEYS, "split", label, "features")


def fit_point_model(features: DataFrame, pipeline, train_splits=("train",), val_split: str = "val", write=None):
    """Fit on train (+ val rows flagged for early stopping).

    ``write`` (a function of a DataFrame that returns it as written) holds
    the vectors that the stages before the estimator make, so that the
    estimator's iterations read them instead of making them anew each time."""
    rows = fit_rows(features, pipeline, train_splits, val_split)
    if write is None or not hasattr(pipeline, "getStages"):
        return pipeline.fit(rows)
    from pyspark.ml import Pipeline, PipelineModel
    *before, estimator = pipeline.getStages()
    made = Pipeline(stages=before).fit(rows)
    used = [estimator.getLabelCol(), estimator.getFeaturesCol(), "is_val"]
    return PipelineModel([*made.stages, estimator.fit(write(made.transform(rows).select(*used)))])


def predict_clipped(model, df: DataFrame) -> DataFrame:
    """model.transform + prediction clipped at 0 -> ``point``."""
    return model.transform(df).withColumn("point", F.greatest(F.col("raw_prediction"), F.lit(0.0)))


def feature_importance(model, feature_cols: Sequence[str], string_cols: Sequence[str] = ()) -> DataFrame:
    """importance per input feature (gain share for trees, |coef| for
    the GLM), sorted descending; ``split_count`` = nodes splitting on it."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    last = model.stages[-1] if hasattr(model, "stages") else model
    names = [f"{c}_idx" if c in string_cols else c for c in feature_cols]
    if hasattr(last, "featureImportances"):
        imp = last.featureImportances.toArray().tolist()
        counts = [0] * len(names)
        for t in last.trees:
            _count_splits(t._call_java("rootNode"), counts)
        rows = [(n, float(g), int(c)) for n, g, c in zip(feature_cols, imp, counts)]
    else:
        coefs = last.coefficients.toArray().tolist()
        rows = [(n, float(abs(g)), 0) for n, g in zip(feature_cols, coefs)]
    return spark.createDataFrame(rows, "feature string, gain double, split_count int").orderBy(F.desc("gain"))


def _count_splits(node, counts):
    if node.getClass().getSimpleName() == "LeafNode":
        return
    counts[node.split().featureIndex()] += 1
    _count_splits(node.leftChild(), counts)
    _count_splits(node.rightChild(), counts)


def rmse_on(df: DataFrame, label: str = "sales", pred: str = "point") -> float:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(pred), 2)))).first()[0]


# the trees' own eight parameters. The ranges of the first five
# are those of the searched model; Spark's trees have no penalty on leaf values,
# so gain, bins and weight share of a node take the other three places.
GBT_SPACE = {"step": ("loguniform", 0.01, 0.3), "max_depth": ("int", 5, 12), "minInstancesPerNode": ("int", 10, 300),
             "subsamplingRate": ("uniform", 0.5, 0.95), "featureSubsetStrategy": ("uniform", 0.5, 0.9),
             "minInfoGain": ("uniform", 0.0, 0.01), "extra_bins": ("int", 0, 64), "minWeightFractionPerNode": ("uniform", 0.0, 0.01)}


def gbt_trial(bins: int, max_iter: int = 300, extra_bins: int = 0, featureSubsetStrategy: float = 1.0, **params):
    """the estimator of one draw from ``GBT_SPACE`` over assembled vectors; ``bins`` is what the categories need."""
    return gbt_model([], max_iter=max_iter, max_bins=bins + extra_bins, featureSubsetStrategy=str(featureSubsetStrategy), **params).getStages()[-1]


def random_search(features: DataFrame, make_pipeline, space: dict, n_trials: int = 5, seed: int = 42,
                  val_split: str = "val") -> DataFrame:
    """seeded random search minimising validation RMSE.

    ``space`` maps a parameter to ("loguniform", lo, hi) / ("int", lo, hi) /
    ("uniform", lo, hi).  Each trial is a full distributed fit, with early
    stopping where the estimator has it; the driver only draws parameters and
    reads one RMSE per trial.  Returns one row per trial (params as a map,
    rmse, trees kept: null for a model without trees), best first."""
    rng = random.Random(seed)
    val = features.where(F.col("split") == val_split)
    rows = []
    for t in range(n_trials):
        params = {}
        for k, (kind, lo, hi) in space.items():
            if kind == "loguniform":
                params[k] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            elif kind == "int":
                params[k] = rng.randint(lo, hi)
            else:
                params[k] = rng.uniform(lo, hi)
        model = fit_point_model(features, make_pipeline(**params), val_split=val_split)
        last = model.stages[-1] if hasattr(model, "stages") else model
        rows.append((t, {k: float(v) for k, v in params.items()}, rmse_on(predict_clipped(model, val)), getattr(last, "getNumTrees", None)))
    spark = features.sparkSession
    return spark.createDataFrame(rows, "trial int, params map<string,double>, val_rmse double, trees int") \
                .orderBy("val_rmse", "trial")


def repaired_quantiles(df: DataFrame, cols: Sequence[str] = ("q05", "q50", "q95")) -> DataFrame:
    """F8 + F9: predictions of any subset of quantiles (``<col>_raw``), clipped at 0, put in order row by row.

    Three columns go through the closed-form pool-adjacent-violators; any
    other number through the general one over the row's array.
    """
    cols = sorted(cols)
    df = clip_quantiles(df, cols)
    if len(cols) == 3:
        return non_crossing(df, *[f"{c}_clip" for c in cols], out=tuple(cols))
    return df.withColumn("_iso", isotonic(F.array(*[F.col(f"{c}_clip") for c in cols]))) \
        .withColumns({c: F.get("_iso", F.lit(k)) for k, c in enumerate(cols)}).drop("_iso")


def isotonic(values: Column) -> Column:
    """F9 for any number of values: the nearest non-decreasing sequence, value k being the max over i <= k of the min over j >= k of mean(i..j)."""
    n = F.size(values)

    def mean(i: Column, j: Column) -> Column:
        return F.aggregate(F.slice(values, i + 1, j - i + 1), F.lit(0.0), lambda a, x: a + x) / (j - i + 1)

    return F.transform(values, lambda _, k: F.array_max(F.transform(F.sequence(F.lit(0), k), lambda i: F.array_min(F.transform(F.sequence(k, n - 1), lambda j: mean(i, j))))))


def save_model(model, path: str) -> None:
    """F12."""
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    """F12."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
