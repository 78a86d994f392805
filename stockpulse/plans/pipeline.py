"""End-to-end stage composition.

``Pipeline(spark, sf_dir)`` exposes every stage output as a lazy
DataFrame: prepare (features) -> forecast (predictions) -> intervals
(quantile + conformal) -> calibrate (curve, segments) -> triage (risk) ->
impact.  With ``materialize=True`` the stage tables - the feature table above
all - are written once as Parquet below the folder the session names in
``spark.checkpoint.dir`` (reliable storage: a lost executor does not
recompute the panel), and every downstream stage reads them back.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.config import DEFAULT, EngineConfig, PanelConfig
from stockpulse.operators import calibration as J
from stockpulse.operators import conformal as H
from stockpulse.operators import encode as EN
from stockpulse.operators import features as FE
from stockpulse.operators import forecast as FC
from stockpulse.operators import impact as L
from stockpulse.operators import panel as P
from stockpulse.operators import quantile_regression as QR
from stockpulse.operators import reports as RP
from stockpulse.operators import risk as K
from stockpulse.session import ensure_checkpoint_dir
from stockpulse.sources import tables as T
from stockpulse.sources import testdata as TD

_MATERIALIZED: dict = {}

#: Test tables that the pipeline reads.
SOURCES = ("lineitem", "part", "supplier", "nation", "region")


#: Stages that do not depend on the point forecast.
SHARED_STAGES = {"day_maps", "sales_long", "features", "dictionary", "model_inputs", "tree_vectors", "tweedie_vectors", "quantile_model", "quantile_predictions", "tweedie_predictions"}


def manifest(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of the names, sizes and times of all files below ``paths``: the files' contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths)).select("path", "length", F.col("modificationTime").cast("double"))
    return hashlib.sha256(repr(sorted(map(tuple, files.collect()))).encode()).hexdigest()[:16]


def release_stages(spark: SparkSession) -> None:
    """Forget this application's stage tables and remove their folder."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _MATERIALIZED if k[0] == app]:
        del _MATERIALIZED[key]
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/stockpulse/{app}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Pipeline:
    """``source`` is a folder of test tables, or paths of the user's calendar, prices and wide sales files.

    Written stages are kept by the files they come from (names, sizes, times)
    and all settings: changed input gives new stages. ``forecaster`` is the
    point forecast of stages 4 to 7: ``baseline`` or ``tweedie``.
    """

    def __init__(self, spark: SparkSession, source: str | Mapping[str, str], cfg: EngineConfig = DEFAULT,
                 materialize: bool = False, forecaster: str = "baseline"):
        self.spark, self.materialize, self.forecaster = spark, materialize, forecaster
        self.files = None if isinstance(source, str) else dict(source)
        self.sf_dir = source if isinstance(source, str) else repr(sorted(self.files.items()))
        if self.files:
            T.check_inputs_exist(self.files)
        self.manifest = manifest(spark, list(self.files.values()) if self.files else [f"{source}/{t}.parquet" for t in SOURCES])
        if cfg.panel is None:
            key = (spark.sparkContext.applicationId, self.manifest, "window")
            if key not in _MATERIALIZED:
                _MATERIALIZED[key] = self._file_window() if self.files else TD.whole_window(spark, source)
            cfg = replace(cfg, panel=_MATERIALIZED[key])
        self.cfg = cfg

    @classmethod
    def from_files(cls, spark: SparkSession, paths: Mapping[str, str], cfg: EngineConfig = DEFAULT, **options) -> "Pipeline":
        """A pipeline over the user's own ``calendar``, ``prices`` and ``sales`` files (CSV or Parquet)."""
        return cls(spark, paths, cfg, **options)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return T.check_columns(T.load_m5_tables(self.spark, self.files))

    def _file_window(self) -> PanelConfig:
        """Day 1 to the last day column of the wide sales; the last 2 x 28 days are the validation and test splits."""
        days = [int(c[2:]) for c in P.day_columns(self.raw["sales"])]
        if not days:
            raise ValueError("the sales file has no day columns d_<n>")
        start = self.raw["calendar"].where(F.col("d") == f"d_{min(days)}").agg(F.min("date")).first()[0]
        if start is None:
            raise ValueError(f"the calendar has no row for d_{min(days)}")
        n = max(days)
        return PanelConfig(start.isoformat(), n, max(0, n - 56), max(0, n - 28), len(days))

    # -------------------------------------------------------- stage 2
    @cached_property
    def day_maps(self) -> DataFrame:
        """Stage-1 boundary: one row per observed series with its bounded
        ``day -> (units, max price)`` map - the only stage that scans the
        shipment tables.  When materializing it is written once and read
        back hash-repartitioned by series: only these compact rows are
        exchanged, and every series window downstream reuses that
        partitioning."""
        m = self._stage("day_maps", lambda: TD.series_day_maps(self.spark, self.sf_dir, self.cfg.panel))
        if not self.materialize:
            return m
        # explicit partition count: AQE would coalesce these few compact rows
        # into one partition, but each row expands n_days-fold downstream
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return m.repartition(n, "item_id", "store_id")

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        if self.files:
            ids = [c for c in ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id") if c in self.raw["sales"].columns]
            derived = TD.with_hierarchy(self.raw["sales"]) if len(ids) < 6 else self.raw["sales"]
            long = P.add_day_index(P.melt(derived, ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]))
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            long = self._stage("sales_long", lambda: long).repartition(n, "item_id", "store_id")
            return {"calendar": self.raw["calendar"], "prices": self.raw["prices"], "sales_long": long}
        maps = self.day_maps if self.materialize else None
        return TD.m5_tables(self.spark, self.sf_dir, self.cfg.panel, maps)

    @cached_property
    def features(self) -> DataFrame:
        def build():
            t = self.tables
            return FE.build_features(t["sales_long"], t["calendar"], t["prices"], self.cfg.panel, self.cfg.features)
        return self._stage("features", build, partition_by=("split",))

    @cached_property
    def raw_panel(self) -> DataFrame:
        """Stage-2 merge output: sales panel + calendar + raw weekly price
        (before any fill) - what the join audits and missing report read."""
        t = self.tables   # built on the written day-map stage: no shipment scan
        return P.join_prices(P.join_calendar(t["sales_long"], t["calendar"]), t["prices"])

    def _key(self, name: str):
        own = "" if name in SHARED_STAGES or name.startswith("model-") else self.forecaster
        return (self.spark.sparkContext.applicationId, self.sf_dir, self.manifest, repr(self.cfg), own, name)

    def _stage(self, name: str, build, partition_by=()) -> DataFrame:
        """Stage boundary.  ``build`` returns the stage's lazy DataFrame;
        when materializing it is written once per session (and read back),
        and later pipelines reuse the written table without re-planning."""
        if not self.materialize:
            return build()
        key = self._key(name)
        if key not in _MATERIALIZED:
            _MATERIALIZED[key] = self._write_stage(build(), name, partition_by)
        return _MATERIALIZED[key]

    def _write_stage(self, df: DataFrame, name: str, partition_by=()) -> DataFrame:
        """Write a stage output as Parquet under the session's checkpoint
        folder (shared storage on a cluster) and read it back: lineage is
        cut, reads get column pruning and partition pruning on ``split``."""
        root = ensure_checkpoint_dir(self.spark)
        tag = hashlib.sha1(repr(self._key(name)).encode()).hexdigest()[:12]
        path = os.path.join(root, "stockpulse", self.spark.sparkContext.applicationId, f"{name}-{tag}")
        w = df.write.mode("overwrite").option("compression", "snappy")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return self.spark.read.parquet(path).select(*df.columns)

    @cached_property
    def states(self) -> list[str]:
        """The states of the source's calendar (not of the feature table, which is checked against them)."""
        return [c[len("snap_"):] for c in self.tables["calendar"].columns if c.startswith("snap_")]

    @cached_property
    def series(self) -> DataFrame:
        """One row for each series of the source, with its hierarchy."""
        ids = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
        if self.files:
            return self.tables["sales_long"].select(*ids).distinct()
        return TD.with_hierarchy(self.day_maps.select("item_id", "store_id")).select(*ids)

    @cached_property
    def day_rows(self) -> DataFrame:
        """(date, units) of the days that have rows: one for each series and day of the source."""
        if self.files:
            return self.tables["sales_long"].join(F.broadcast(self.raw["calendar"].select("d", "date")), "d").select("date", F.col("sales").cast("long").alias("units"))
        start = F.to_date(F.lit(self.cfg.panel.start_date))
        return self.day_maps.select(F.explode("day_sales").alias("day", "v")).select(F.date_add(start, F.col("day") - 1).alias("date"), F.col("v.qty").cast("long").alias("units"))

    @cached_property
    def expected_rows(self):
        """Rows that the feature table must have: series of the source times days."""
        return self.series.agg(F.count(F.lit(1)) * self.cfg.panel.n_days).scalar()

    # -------------------------------------------------------- model inputs
    @cached_property
    def model_columns(self) -> list[str]:
        """A4: the whole catalogue but identity, meta and target, with the ids."""
        return [c for c in FE.feature_columns(self.states, fcfg=self.cfg.features) if c != "day_index"]

    @cached_property
    def dictionary(self) -> EN.Dictionary:
        key = self._key("dictionary")
        if key not in _MATERIALIZED:
            text = EN.split_columns(self.features, self.model_columns)[1]
            _MATERIALIZED[key] = EN.Dictionary.fit(self.features.where(F.col("split") == "train"), text)
        return _MATERIALIZED[key]

    @cached_property
    def model_inputs(self) -> tuple[DataFrame, list[str], list[str]]:
        """written rows of the model's inputs, and the numeric and code columns among them."""
        rows, numeric, codes, _ = EN.model_inputs(self.features, self.model_columns, self.dictionary)
        return self._stage("model_inputs", lambda: rows, partition_by=("split",)), numeric, codes

    @cached_property
    def tree_inputs(self):
        """the pipeline of boosted trees (unfitted, for its bins) and the written vectors of train and val that all fits share."""
        rows, numeric, codes = self.model_inputs
        trees = FC.gbt_inputs(numeric, codes, self.dictionary)
        return trees, self._stage("tree_vectors", lambda: FC.vectors(rows.where(F.col("split").isin("train", "val")), trees), partition_by=("split",))

    @cached_property
    def quantile_model(self) -> QR.LinearQuantiles:
        """linear quantiles of the train split over all inputs."""
        key = self._key("quantile_model")
        if key not in _MATERIALIZED:
            rows, numeric, codes = self.model_inputs
            split = EN.indicators(codes, self.dictionary)
            plain = [*numeric, *[c for c in codes if c not in split]]
            _MATERIALIZED[key] = QR.fit_quantiles(rows.where(F.col("split") == "train"), plain, "sales", self.cfg.uncertainty.quantiles, split)
        return _MATERIALIZED[key]

    @cached_property
    def quantile_predictions(self) -> DataFrame:
        """Raw quantiles of all splits: keys, split, sales, q05_raw, q50_raw, q95_raw."""
        names = [f"q{int(round(q * 100)):02d}_raw" for q in self.cfg.uncertainty.quantiles]
        return self._stage("quantile_predictions", lambda: self.quantile_model.predict(self.model_inputs[0]).select(
            "item_id", "store_id", "day_index", "split", "sales", *names), partition_by=("split",))

    def point_model(self, name: str, make):
        """a fitted point model, saved below the stages and read back."""
        key = self._key(f"model-{name}")
        if key not in _MATERIALIZED:
            rows, numeric, codes = self.model_inputs
            path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/stockpulse/{self.spark.sparkContext.applicationId}/model-{name}-{hashlib.sha1(repr(key).encode()).hexdigest()[:12]}"
            model = FC.fit_point_model(rows, make(numeric, codes, self.dictionary), write=lambda vectors: self._stage(f"{name}_vectors", lambda: vectors))
            FC.save_model(model, path)
            _MATERIALIZED[key] = FC.load_pipeline_model(path)
        return _MATERIALIZED[key]

    @cached_property
    def tweedie_predictions(self) -> DataFrame:
        """the trained point forecast of val and test, with what stages 4 to 7 carry."""
        def build():
            rows = self.model_inputs[0].where(F.col("split").isin("val", "test"))
            scored = FC.predict_clipped(self.point_model("tweedie", FC.tweedie_inputs), rows).select("item_id", "store_id", "day_index", "point")
            return FC.baseline_point(self.features, self.cfg.features.point_window).drop("point").join(scored, ["item_id", "store_id", "day_index"])
        return self._stage("tweedie_predictions", build)

    # -------------------------------------------------------- stage 3
    @cached_property
    def predictions(self) -> DataFrame:
        if self.forecaster == "tweedie":
            return self.tweedie_predictions
        return FC.baseline_point(self.features, self.cfg.features.point_window)

    @cached_property
    def cal(self) -> DataFrame:
        return self.predictions.where(F.col("split") == self.cfg.uncertainty.calibration_split)

    @cached_property
    def test(self) -> DataFrame:
        return self.predictions.where(F.col("split") == self.cfg.uncertainty.eval_split)

    @cached_property
    def n_cal(self) -> int:
        key = self._key("n_cal")
        if key not in _MATERIALIZED:
            _MATERIALIZED[key] = self.cal.count()
        return _MATERIALIZED[key]

    # -------------------------------------------------------- stage 4
    @cached_property
    def score_counts(self) -> DataFrame:
        """The calibration scores counted by value: every threshold of stages 4 and 5 picks its ranks here."""
        return self._stage("score_counts", lambda: H.score_counts(self.cal))

    @cached_property
    def thresholds(self) -> DataFrame:
        u = self.cfg.uncertainty
        return self._stage("thresholds", lambda: H.calibrate(self.cal, u.alpha, n=self.n_cal, mode=u.quantile_mode, counts=self.score_counts))

    @cached_property
    def conformal_test(self) -> DataFrame:
        return self._stage("conformal_intervals", lambda: H.conformal_intervals(self.test, self.thresholds))

    @cached_property
    def quantile_test(self) -> DataFrame:
        def build():
            if self.forecaster == "baseline":
                return FC.baseline_quantile_frame(self.test, alpha=self.cfg.uncertainty.alpha)
            keys = ["item_id", "store_id", "day_index"]
            raw = [c for c in self.quantile_predictions.columns if c.endswith("_raw")]
            met = self.test.join(self.quantile_predictions.where(F.col("split") == self.cfg.uncertainty.eval_split).select(*keys, *raw), keys)
            return FC.quantile_interval(FC.repaired_quantiles(met), self.cfg.uncertainty.alpha)
        return self._stage("quantile_intervals", build)

    @cached_property
    def intervals_long(self) -> DataFrame:
        """Both Stage-4 methods as one long table (method, keys, actual, lower, upper)."""
        keys = ["item_id", "store_id", "day_index", "actual"]
        q = self.quantile_test.select(F.lit("Quantile").alias("method"), *keys, "lower", "upper")
        cs = self.conformal_test.select(F.lit("Conformal_Symmetric").alias("method"), *keys,
                                        F.col("lower_sym").alias("lower"), F.col("upper_sym").alias("upper"))
        ca = self.conformal_test.select(F.lit("Conformal_Asymmetric").alias("method"), *keys,
                                        F.col("lower_asym").alias("lower"), F.col("upper_asym").alias("upper"))
        return q.unionByName(cs).unionByName(ca)

    @cached_property
    def train(self) -> DataFrame:
        return self.features.where(F.col("split") == "train").select("item_id", "store_id", "day_index", "sales")

    # -------------------------------------------------------- stage 5
    @cached_property
    def curve(self) -> DataFrame:
        u = self.cfg.uncertainty
        return self._stage("calibration_curve", lambda: J.calibration_curve(
            self.test, self.cal, u.confidence_levels, self.quantile_test, u.qr_native_level, self.n_cal,
            u.quantile_mode, self.score_counts))

    @cached_property
    def long90(self) -> DataFrame:
        u = self.cfg.uncertainty
        return self._stage("methods_at_level", lambda: J.methods_at_level(
            self.test, self.cal, self.quantile_test, u.qr_native_level, n_cal=self.n_cal, mode=u.quantile_mode, counts=self.score_counts))

    @cached_property
    def segments(self) -> DataFrame:
        return self._stage("segments", lambda: J.segment_calibration(self.long90, self.cfg.uncertainty.qr_native_level))

    # -------------------------------------------------------- stage 6
    @cached_property
    def scored(self) -> DataFrame:
        return self._stage("scored", lambda: K.risk_scores(self.conformal_test, self.segments, self.cfg.decision))

    @cached_property
    def risk_bounds(self) -> DataFrame:
        return self._stage("risk_bounds", lambda: K.risk_bounds(self.scored, self.cfg.decision, self.cfg.uncertainty.quantile_mode))

    @cached_property
    def leveled(self) -> DataFrame:
        return K.risk_levels(self.scored, self.cfg.decision, bounds=self.risk_bounds)

    @cached_property
    def recs(self) -> DataFrame:
        return self._stage("triage", lambda: K.recommendations(self.leveled, self.cfg.decision))

    @cached_property
    def risk(self) -> DataFrame:
        return K.risk_table(self.recs)

    # -------------------------------------------------------- stage 7
    @cached_property
    def impact(self) -> DataFrame:
        s = self.cfg.simulation
        base = self.recs.select(*K.RISK_OUTPUT, "sell_price", "has_any_event", "rolling_std_28")
        return L.policy_costs(L.order_policies(base), s.holding_rate, s.stockout_rate)

    # -------------------------------------------------------- reports
    @cached_property
    def reports(self) -> dict[str, DataFrame]:
        """The named reports of the stages, each one nested row."""
        return {"feature_catalogue": RP.catalogue_report(self.spark, self.states, self.cfg.features),
                "split_index": RP.split_index_report(self.features),
                "validation": RP.validation_summary(self.features, self.states, self.expected_rows),
                "kpis": RP.kpi_report(self.impact)}

    def write_reports(self, folder: str | None = None) -> dict[str, str]:
        """Write the reports to ``folder``, or once beside the stages where none is given; their paths by name."""
        if folder:
            return RP.write_reports(self.reports, folder)
        key = self._key("reports")
        if key not in _MATERIALIZED:
            tag = hashlib.sha1(repr(key).encode()).hexdigest()[:12]
            own = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/stockpulse/{self.spark.sparkContext.applicationId}/reports-{tag}"
            _MATERIALIZED[key] = RP.write_reports(self.reports, own)
        return _MATERIALIZED[key]
