"""The named reports, each one row of nested structs and maps.

Each report is a DataFrame of one row, so it is built by Spark beside the
stages and written as JSON like any other table. Maps are built from rows
whose number is bounded by the settings (columns of the catalogue, splits,
checks, policies), never by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockpulse.config import FeatureConfig
from stockpulse.operators import impact, quality
from stockpulse.operators.features import catalogue_frame
from stockpulse.operators.layout import write_json


def _as_map(key: str, value: Column) -> Column:
    """One map of all rows, by key in ascending order (null keys are left out)."""
    entries = F.collect_list(F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("key"), value.alias("value"))))
    return F.map_from_entries(F.array_sort(entries))


def catalogue_report(spark: SparkSession, states: Sequence[str], fcfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """``features`` (name to position, group, dtype, description), ``groups`` (group to features), ``n_features``."""
    rows = catalogue_frame(spark, states, fcfg)
    groups = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).agg(_as_map("group", F.col("n")).alias("groups"))
    features = rows.agg(_as_map("name", F.struct("position", "group", "dtype", "description")).alias("features"), F.count(F.lit(1)).alias("n_features"))
    return features.select("features", groups.scalar().alias("groups"), "n_features")


def split_index_report(features: DataFrame) -> DataFrame:
    """``splits``: name to first and last day, days, rows, first and last date."""
    return quality.split_index(features).agg(_as_map("split", F.struct(
        F.col("min_day").cast("long").alias("day_index_min"), F.col("max_day").cast("long").alias("day_index_max"), "n_days", F.col("rows").alias("n_rows"),
        F.col("start_date").cast("string").alias("date_start"), F.col("end_date").cast("string").alias("date_end"))).alias("splits"))


def validation_summary(features: DataFrame, states: Sequence[str], expected_rows) -> DataFrame:
    """Shape, checks, how many passed, rows of each split, target statistics (sample std, zero share in percent)."""
    checks = quality.validation_checks(features, states, expected_rows).agg(
        _as_map("check", F.struct("passed", F.col("detail").alias("message"))).alias("validation_checks"),
        F.count_if("passed").alias("n_checks_passed"), F.count(F.lit(1)).alias("n_checks_total"), F.bool_and("passed").alias("all_passed"))
    y = F.col("sales").cast("double")
    splits = features.groupBy("split").agg(F.count(F.lit(1)).alias("n")).agg(_as_map("split", F.col("n")).alias("m"))
    shape = features.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.lit(len(features.columns)).cast("long").alias("columns")).alias("dataset_shape"),
        F.struct(F.round(F.avg(y), 4).alias("mean"), F.round(F.stddev_samp(y), 4).alias("std"), F.max("sales").cast("long").alias("max"),
                 F.round(F.avg((y == 0).cast("double")) * 100, 1).alias("zero_pct")).alias("target_stats"))
    one = checks.select(F.struct(*checks.columns).alias("c"))
    return shape.select("dataset_shape", one.scalar().alias("c"), splits.scalar().alias("split_counts"), "target_stats") \
        .select("dataset_shape", "c.*", "split_counts", "target_stats")


def kpi_report(policies: DataFrame) -> DataFrame:
    """``policies`` (policy to its KPIs by name) and ``comparison``, from the rows of ``impact.policy_costs``."""
    kpis = impact.policy_kpis(policies)
    own = {f"{p}_{k}" for p in impact.POLICIES for k in impact.KPI_NAMES}
    each = [x for p in impact.POLICIES for x in (F.lit(p), F.map_from_arrays(
        F.array(*[F.lit(k) for k in impact.KPI_NAMES]), F.array(*[F.col(f"{p}_{k}").cast("double") for k in impact.KPI_NAMES])))]
    return kpis.select(F.create_map(*each).alias("policies"), F.struct(*[F.col(c) for c in kpis.columns if c not in own]).alias("comparison"))


def write_reports(reports: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Every report as JSON in a folder of its name; the paths by name. Null fields are left out and read back as null."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in reports}
    for name, report in reports.items():
        write_json(report, paths[name])
    return paths


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A written report under its own schema (maps stay maps); a file that does not fit raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
