"""Query registry: name -> (spark, sf_dir) -> DataFrame.

Every query reads the given test tables (through the panel builder) over
their whole extent.  Float outputs are rounded to 6 decimals (stable value
hashes across engines); the library operators themselves keep full
precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.config import DEFAULT
from stockpulse.functions.columns import round_doubles
from stockpulse.operators import calibration as J
from stockpulse.operators import conformal as H
from stockpulse.operators import encode as EN
from stockpulse.operators import features as FE
from stockpulse.operators import forecast as FC
from stockpulse.operators import impact as L
from stockpulse.operators import layout as LY
from stockpulse.operators import metrics as G
from stockpulse.operators import panel as P
from stockpulse.operators import quality as E
from stockpulse.operators import quantile_regression as QR
from stockpulse.operators import reports as RP
from stockpulse.operators import risk as K
from stockpulse.operators import serving as M
from stockpulse.plans.pipeline import Pipeline
from stockpulse.session import ensure_checkpoint_dir
from stockpulse.sources import testdata as TD

Query = Callable[[SparkSession, str], DataFrame]
_REG: dict[str, Query] = {}
# The feature table is the shared stage boundary: written once per session
# and sf_dir under spark.checkpoint.dir and read back by every query.
MATERIALIZE = True


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(Pipeline(spark, sf_dir, DEFAULT, MATERIALIZE)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REG[name] = run
        return fn
    return deco


def registry() -> dict[str, Query]:
    return dict(_REG)


KEYS = ["item_id", "store_id", "day_index"]


# ------------------------------------------------------------ B / C / D
@query("melt_wide_sales")
def _melt(p: Pipeline):
    """B1 + D1: wide last-28-day table melted back to long."""
    wide = TD.sales_wide(p.spark, p.sf_dir, p.cfg.panel, maps=p.day_maps if p.materialize else None)
    long = P.melt(wide, ["id", "item_id", "store_id"], method="generate")
    return P.add_day_index(long).select("id", "item_id", "store_id", "d", "day_index", "sales")


@query("melt_unpivot")
def _melt2(p: Pipeline):
    """B1 via Spark's unpivot (must equal melt_wide_sales)."""
    wide = TD.sales_wide(p.spark, p.sf_dir, p.cfg.panel, maps=p.day_maps if p.materialize else None)
    long = P.melt(wide, ["id", "item_id", "store_id"], method="unpivot")
    return P.add_day_index(long).select("id", "item_id", "store_id", "d", "day_index", "sales")


@query("panel_join")
def _panel_join(p: Pipeline):
    """B2 + B3 + C1: calendar and raw price joined onto the panel."""
    df = P.fill_events(p.raw_panel)
    return df.select(*KEYS, "d", "sales", "wm_yr_wk", "event_name_1", "event_type_1",
                     "event_name_2", "event_type_2", F.col("sell_price").alias("raw_price"))


@query("join_audit")
def _join_audit(p: Pipeline):
    """Audit of the price left join."""
    t = p.tables
    left = P.join_calendar(t["sales_long"], t["calendar"])
    return P.join_audit(left, t["prices"], ["store_id", "item_id", "wm_yr_wk"], "sell_price")


@query("key_coverage")
def _key_cov(p: Pipeline):
    """Distinct series keys / weeks shared by sales and prices."""
    t = p.tables
    sales = t["sales_long"].select("item_id", "store_id", TD.week_of("day_index").alias("wm_yr_wk"))
    return P.key_coverage(sales, t["prices"], {"series": ["item_id", "store_id"], "wm_yr_wk": ["wm_yr_wk"], "store_id": ["store_id"], "item_id": ["item_id"]})


@query("price_fill")
def _price_fill(p: Pipeline):
    """forward/back-filled price."""
    return p.features.select(*KEYS, "sell_price")


@query("date_features")
def _date(p: Pipeline):
    """D2 + D3."""
    return p.features.select(*KEYS, "year", "month", "week", "day_of_month", "day_of_week",
                             "is_weekend", "quarter", "wday", "weekday")


@query("event_snap_features")
def _events(p: Pipeline):
    """D9 - D11."""
    return p.features.select(*KEYS, "has_event_1", "has_event_2", "has_any_event", "is_sporting",
                             "is_cultural", "is_national", "is_religious", "snap_active")


@query("price_features")
def _price(p: Pipeline):
    """D5 - D8."""
    return p.features.select(*KEYS, "price_diff", "price_pct_change", "price_rel_to_mean", "has_price")


@query("lag_features")
def _lags(p: Pipeline):
    """C3 + D12."""
    return p.features.select(*KEYS, "lag_7", "lag_14", "lag_28")


@query("rolling_features")
def _rolling(p: Pipeline):
    """D13 + D14."""
    return p.features.select(*KEYS, "rolling_mean_7", "rolling_mean_14", "rolling_mean_28",
                             "rolling_std_7", "rolling_std_28")


@query("zero_split_labels")
def _zero_split(p: Pipeline):
    """D4 + D15."""
    return p.features.select(*KEYS, "sales", "is_zero_sales", "split")


@query("feature_table")
def _feature_table(p: Pipeline):
    """The full feature table."""
    return p.features


# ------------------------------------------------------------ E
@query("missing_report")
def _missing(p: Pipeline):
    """E2 on the raw panel join (before the fills)."""
    return E.missing_report(p.raw_panel)


@query("duplicate_rows")
def _dups(p: Pipeline):
    """Full-row and key duplicates of the panel."""
    return E.duplicate_rows(p.tables["sales_long"], key_columns=KEYS[:2] + ["d"])


@query("distinct_counts")
def _distinct(p: Pipeline):
    """E4."""
    return E.distinct_counts(p.series, ["item_id", "dept_id", "cat_id", "store_id", "state_id"])


@query("describe_sales")
def _describe(p: Pipeline):
    """E5 + E6."""
    return E.global_stats(p.tables["sales_long"], "sales")


@query("series_mean_distribution")
def _series_mean(p: Pipeline):
    """E7."""
    return E.series_mean_distribution(p.tables["sales_long"], "sales")


@query("hierarchy_counts")
def _hier(p: Pipeline):
    """E8, from one row for each series."""
    return E.hierarchy_counts(p.series)


@query("calendar_continuity")
def _cal_cont(p: Pipeline):
    """E9."""
    return E.calendar_continuity(p.tables["calendar"], p.day_rows)


@query("price_coverage")
def _price_cov(p: Pipeline):
    """E10."""
    return E.price_coverage(p.tables["prices"])


@query("event_frequency")
def _event_freq(p: Pipeline):
    """E11."""
    return E.event_frequency(p.tables["calendar"], p.day_rows)


@query("validation_checks")
def _checks(p: Pipeline):
    """Expectations come from the source, not from the checked table."""
    return E.validation_checks(p.features, p.states, p.expected_rows).select("check", "passed", "measured")


@query("lag_leaks")
def _leaks(p: Pipeline):
    """Lag columns against the sales they must hold, joined by day."""
    return E.lag_leaks(p.features, p.cfg.features.lags)


CODED = ("item_id", "store_id", "dept_id", "weekday", "event_name_1", "event_type_1", "event_name_2", "event_type_2")


@query("encoded_features")
def _encoded(p: Pipeline):
    """Category codes by a dictionary of the train split; values that train lacks get the code after the last."""
    d = EN.Dictionary.fit(p.features.where(F.col("split") == "train"), CODED)
    return d.encode(p.features, CODED).select(*KEYS, *[f"{c}_code" for c in CODED])


@query("category_dictionary")
def _dictionary(p: Pipeline):
    """The dictionary itself, with the rows of each value."""
    return EN.value_dictionary(p.features.where(F.col("split") == "train"), CODED)


@query("file_features")
def _file_features(p: Pipeline):
    """The three raw files written as CSV, read back by their headers, and the feature table of those files."""
    root = f"{ensure_checkpoint_dir(p.spark).rstrip('/')}/stockpulse/{p.spark.sparkContext.applicationId}/files-{p.manifest}"
    t, panel = p.tables, p.cfg.panel
    LY.write_csv(t["calendar"], f"{root}/calendar")
    LY.write_csv(t["prices"], f"{root}/prices")
    LY.write_csv(TD.sales_wide(p.spark, p.sf_dir, panel, 1, panel.n_days, p.day_maps), f"{root}/sales")
    return Pipeline.from_files(p.spark, {k: f"{root}/{k}" for k in ("calendar", "prices", "sales")}, DEFAULT, materialize=MATERIALIZE).features


@query("dataset_summary")
def _summary(p: Pipeline):
    """E1 + E19."""
    return E.dataset_summary(p.features)


@query("zero_rate_grouping_sets")
def _zero_gs(p: Pipeline):
    """E20."""
    return E.zero_rate_grouping_sets(p.features)


@query("split_index")
def _split_index(p: Pipeline):
    """E21."""
    return E.split_index(p.features)


def _written_report(p: Pipeline, name: str) -> DataFrame:
    """The report as it is read back from its file."""
    return RP.read_report(p.spark, p.write_reports()[name], p.reports[name].schema)


@query("split_index_report")
def _split_index_report(p: Pipeline):
    """The written split index, one row of it for each split."""
    return _written_report(p, "split_index").select(F.explode("splits").alias("split", "s")).select("split", "s.*")


@query("validation_summary")
def _validation_summary(p: Pipeline):
    """The written validation report, its nested fields beside one another."""
    counts = [F.col("split_counts")[s].alias(f"{s}_rows") for s in ("train", "val", "test")]
    return _written_report(p, "validation").select("dataset_shape.*", "n_checks_passed", "n_checks_total", "all_passed", *counts, "target_stats.*")


@query("kpi_report")
def _kpi_report(p: Pipeline):
    """The written KPI report, a row for each policy and KPI."""
    return _written_report(p, "kpis").select(F.explode("policies").alias("policy", "k")).select("policy", F.explode("k").alias("kpi", "value"))


# ------------------------------------------------------------ F / G
@query("accuracy_by_split")
def _acc(p: Pipeline):
    """G1 - G4, G6 (and G5 RMSSE per series) on val and test."""
    return G.accuracy_by_split(p.predictions, p.features)


@query("rmsse_item_level")
def _rmsse_item(p: Pipeline):
    """G5 with the reference's item-level key."""
    ev = p.predictions
    return G.rmsse(ev, p.features.where(F.col("split") == "train"), keys=["item_id"], by=["split"])


@query("quantile_non_crossing")
def _qnc(p: Pipeline):
    """F8 + F9 + F11 on the baseline quantile forecaster."""
    return FC.crossing_report(p.quantile_test)


@query("quantile_intervals")
def _qint(p: Pipeline):
    """quantile interval rows."""
    return p.quantile_test.select(*KEYS, "actual", "q05", "q50", "q95", "lower", "median", "upper", "width")


# ------------------------------------------------------------ H / I
@query("conformal_thresholds")
def _thr(p: Pipeline):
    """H1 - H5, H10."""
    return H.calibration_summary(p.cal, p.thresholds, counts=p.score_counts)


@query("conformal_intervals")
def _cint(p: Pipeline):
    """H6 + H7 + H9."""
    return p.conformal_test.select(*KEYS, "actual", "lower_sym", "point", "upper_sym", "width_sym",
                                   "lower_asym", "upper_asym", "width_asym")


@query("conformal_any_alpha")
def _any_alpha(p: Pipeline):
    """H8: thresholds for several alphas from the kept scores."""
    return H.thresholds_for_alphas(p.cal, [0.5, 0.2, 0.1, 0.05], n=p.n_cal, counts=p.score_counts)


@query("conformal_higher")
def _higher(p: Pipeline):
    """Stage-5 'higher' thresholds."""
    return H.thresholds_for_alphas(p.cal, [0.5, 0.2, 0.1, 0.05], method="higher", n=p.n_cal, counts=p.score_counts)


@query("interval_scores")
def _iscores(p: Pipeline):
    """I1 - I5, I7 - I9 for the three Stage-4 methods."""
    return G.interval_scores(p.intervals_long, p.train, by=["method"], alpha=p.cfg.uncertainty.alpha)


@query("coverage_by_item")
def _cov_item(p: Pipeline):
    """I6 by item."""
    return G.coverage_by_group(p.intervals_long, "item_id")


@query("coverage_by_store")
def _cov_store(p: Pipeline):
    """I6 by store."""
    return G.coverage_by_group(p.intervals_long, "store_id")


@query("method_comparison")
def _mcomp(p: Pipeline):
    """Comparison table (4-decimal strings) of the three methods."""
    s = G.interval_scores(p.intervals_long, p.train, by=["method"], alpha=p.cfg.uncertainty.alpha)
    fmt = lambda c: F.format_number(F.col(c), 4)
    return s.select(F.col("method").alias("Method"), fmt("coverage").alias("Empirical_Coverage"),
                    fmt("coverage_error").alias("Coverage_Error"), fmt("avg_width").alias("Avg_Interval_Width"),
                    fmt("mean_winkler").alias("Mean_IS_Winkler"), fmt("msis").alias("MSIS"),
                    fmt("sharpness").alias("Sharpness"), fmt("zero_coverage").alias("Zero_Coverage"))


@query("width_histogram")
def _whist(p: Pipeline):
    """60-bin width histogram per method."""
    df = p.intervals_long.withColumn("width", F.col("upper") - F.col("lower"))
    return G.histogram(df, "width", 60, by=["method"])


@query("score_quantile_grid")
def _ecdf(p: Pipeline):
    """I11 at scale: Winkler-score ECDF sampled at 101 probabilities."""
    df = p.intervals_long.withColumn("winkler", G.winkler(alpha=p.cfg.uncertainty.alpha))
    return G.quantile_grid(df, "winkler", by=["method"], points=100)


# ------------------------------------------------------------ J
@query("calibration_curve")
def _curve(p: Pipeline):
    """J1 + J2."""
    return p.curve


@query("method_comparison_90")
def _m90(p: Pipeline):
    """J7."""
    return J.method_comparison_at(p.curve, 0.9)


@query("volatility_regimes")
def _vol(p: Pipeline):
    """J3."""
    return J.volatility_regimes(p.long90, pct=p.cfg.uncertainty.volatility_pct)


@query("segment_calibration")
def _seg(p: Pipeline):
    """J4 + J5."""
    return p.segments


@query("worst_segments")
def _worst(p: Pipeline):
    """J6."""
    return J.worst_segments(p.segments, 15)


@query("segment_view")
def _segview(p: Pipeline):
    """J8."""
    return J.segment_view(p.segments, "store_id")


# ------------------------------------------------------------ K
@query("risk_scores")
def _rscores(p: Pipeline):
    """K1 - K3."""
    return p.scored.select(*KEYS, "raw_width", "raw_error", "raw_volatility", "raw_calib_penalty",
                           "comp_width", "comp_error", "comp_volat", "comp_calib", "Risk_Score")


@query("risk_levels")
def _rlevels(p: Pipeline):
    """K4."""
    return p.leveled.select(*KEYS, "Risk_Score", "Risk_Level")


@query("risk_level_counts")
def _rcounts(p: Pipeline):
    """K5."""
    return K.level_counts(p.leveled, p.cfg.decision, bounds=p.risk_bounds)


@query("recommendations")
def _recs(p: Pipeline):
    """K6 - K10 (with B7/B8)."""
    return p.risk


@query("top_risk_items")
def _top(p: Pipeline):
    """K11."""
    return K.top_risk_items(p.risk, 10)


@query("risk_heatmap")
def _heat(p: Pipeline):
    """K12."""
    return K.risk_heatmap(p.risk)


@query("store_risk")
def _srisk(p: Pipeline):
    """K13."""
    return K.store_risk(p.risk)


# ------------------------------------------------------------ L
@query("policy_costs")
def _pcosts(p: Pipeline):
    """L1 - L3."""
    cols = [c for c in p.impact.columns if c.startswith(("Baseline_", "Proposed_"))]
    return p.impact.select(*KEYS, "actual", "sell_price", *cols)


@query("policy_kpis")
def _pkpis(p: Pipeline):
    """L4 + L5."""
    return L.policy_kpis(p.impact)


@query("cost_breakdown")
def _cbreak(p: Pipeline):
    """L11 long cost table."""
    return L.cost_breakdown(L.policy_kpis(p.impact))


@query("scenario_kpis")
def _scen(p: Pipeline):
    """L6 + L7."""
    return L.scenario_kpis(p.impact, p.cfg.simulation.high_volatility_pct)


@query("sensitivity_grid")
def _sgrid(p: Pipeline):
    """L8 + B10."""
    s = p.cfg.simulation
    return L.sensitivity_grid(p.impact, s.holding_rates, s.stockout_rates)


@query("sensitivity_pivot")
def _spivot(p: Pipeline):
    """B11."""
    s = p.cfg.simulation
    return L.sensitivity_pivot(L.sensitivity_grid(p.impact, s.holding_rates, s.stockout_rates), s.holding_rates)


@query("whatif_kpis")
def _whatif(p: Pipeline):
    """L9 at a non-default setting (lead time 4 days, 95 % confidence, volatility 1.2)."""
    return L.whatif_kpis(p.impact, 0.05, 0.40, 95.0, 4.0, 1.2)


@query("savings_curve")
def _curve_sav(p: Pipeline):
    """L10."""
    return L.savings_curve(p.impact, 0.40, 90.0, 1.0, 1.0)


# ------------------------------------------------------------ M
@query("exposure_topn")
def _expo(p: Pipeline):
    """M1 - M3: top-20 exposure rows of High-risk rows (top-k is the feature)."""
    return M.exposure_topn(p.impact, 20, level="High")


@query("sku_search")
def _search(p: Pipeline):
    """M4: literal substring search (any store)."""
    return M.sku_search(p.impact, "promo_1").select(*KEYS, "Risk_Level", "Risk_Score")


@query("sku_card")
def _card(p: Pipeline):
    """M5 + M6 for every SKU."""
    return M.sku_card(p.impact)


@query("stock_proxies")
def _stock(p: Pipeline):
    """M7."""
    return M.stock_proxies(p.impact)


@query("sku_stats")
def _skustats(p: Pipeline):
    """M8."""
    return M.sku_stats(p.impact)


@query("residual_histogram")
def _rhist(p: Pipeline):
    """M9."""
    return M.residual_histogram(p.impact, 20)


@query("filter_options")
def _opts(p: Pipeline):
    """Sorted distinct store ids."""
    return P.distinct_values(p.impact, "store_id")


@query("rescaled_interval")
def _rescaled(p: Pipeline):
    """M10 at 80 % confidence."""
    return M.rescaled_interval(p.conformal_test, p.curve, 80.0)


@query("headline_kpis")
def _head(p: Pipeline):
    """M12."""
    return M.headline_kpis(p.impact)


# ------------------------------------------------------------ more A / C / E / I / M
@query("dataset_overview")
def _overview(p: Pipeline):
    """Rows, columns and dtype histogram of the feature table."""
    return E.overview(p.features)


NARROW_INT_COLUMNS = ("sales", "year", "month", "week", "day_of_month", "day_of_week", "is_weekend", "quarter",
                      "day_index", "wday", "is_zero_sales", "has_price", "wm_yr_wk", "snap_active")


@query("narrowing_plan")
def _narrow(p: Pipeline):
    """Observed integer ranges and the smallest safe types."""
    from stockpulse.operators.layout import narrow_report
    return narrow_report(p.features, NARROW_INT_COLUMNS)


DEV_STORES = ("AFRICA_1", "ASIA_2", "EUROPE_1")


@query("dev_subset")
def _dev(p: Pipeline):
    """A10: dev-mode subset - store list, first 100 days, first 5 items
    (sorted; the item list is a semi join on a 5-row side).  Subsetting is
    the feature of this operator."""
    f = p.features.where(F.col("store_id").isin(*DEV_STORES) & (F.col("day_index") <= 100))
    items = p.features.select("item_id").distinct().orderBy("item_id").limit(5)
    return f.join(F.broadcast(items), "item_id", "left_semi").select(*KEYS, "sales", "split")


@query("score_ecdf")
def _score_ecdf(p: Pipeline):
    """Empirical CDF of widths per method (cume_dist)."""
    df = p.intervals_long.withColumn("width", F.col("upper") - F.col("lower"))
    return G.score_ecdf(df, "width").select("method", "width", "ecdf")


@query("conformal_thresholds_select")
def _thr_select(p: Pipeline):
    """H3/H4 through the exact distributed-selection quantile path (the
    at-scale mode); must equal conformal_thresholds' thresholds."""
    u = p.cfg.uncertainty
    t = H.calibrate(p.cal, u.alpha, n=p.n_cal, mode="select")
    return t.select("n_calibration", "q_hat_symmetric", "q_hat_lo_asymmetric", "q_hat_hi_asymmetric")


@query("validation_report")
def _vreport(p: Pipeline):
    """E18 + E22: check table, split index and target stats (no oracle:
    formatted text)."""
    return E.validation_report(p.features, p.states, p.expected_rows)


@query("inspect_sample")
def _sample(p: Pipeline):
    """Seeded 5 % Bernoulli sample of the impact rows (no oracle:
    sampling is engine-specific)."""
    return M.inspect_sample(p.impact, 0.05, 42).select(*KEYS, "actual", "point", "Risk_Level")


@query("sample_items")
def _sample_items(p: Pipeline):
    """5 seeded pseudo-random items and all their rows (no oracle)."""
    return M.sample_items(p.impact, 5, 42).select(*KEYS, "actual", "point")


# ------------------------------------------------------------ F (trained models; rows-only checks)
@query("tweedie_forecast")
def _tweedie(p: Pipeline):
    """Tweedie GLM (log link, power 1.5) over the whole catalogue and the ids,
    trained on train, saved, read back, scored on val and test; accuracy per split."""
    return G.point_metrics(Pipeline(p.spark, p.sf_dir, DEFAULT, MATERIALIZE, "tweedie").predictions, ["split"])


@query("trained_interval_scores")
def _trained_scores(p: Pipeline):
    """F / H / I of the trained models: conformal intervals around the Tweedie forecast and those of the fitted
    quantiles, scored like the baseline's."""
    t = Pipeline(p.spark, p.sf_dir, DEFAULT, MATERIALIZE, "tweedie")
    return G.interval_scores(t.intervals_long, t.train, by=["method"], alpha=t.cfg.uncertainty.alpha)


@query("trained_recommendations")
def _trained_recs(p: Pipeline):
    """K of the trained models: risk levels and recommendations counted by level and root cause."""
    t = Pipeline(p.spark, p.sf_dir, DEFAULT, MATERIALIZE, "tweedie")
    return t.risk.groupBy("Risk_Level", "Root_Cause").agg(F.count(F.lit(1)).alias("rows"), F.avg("Risk_Score").alias("mean_score"))


#: Share by which a round must lower the validation error to go on; the first that does not is the last (these trees have no patience).
TREE_TOLERANCE = 1e-3


@query("gbt_importance")
def _gbt(p: Pipeline):
    """Boosted trees over the whole catalogue, codes as categories, up to 300 rounds of depth 6 with early
    stopping on val; top-15 features by gain with split counts."""
    _, numeric, codes = p.model_inputs
    trees, vectors = p.tree_inputs
    bins = trees.getStages()[-1].getMaxBins()
    model = FC.fit_point_model(vectors, FC.gbt_trial(bins, step=0.3, max_depth=6, validationTol=TREE_TOLERANCE))
    return FC.feature_importance(model, [*numeric, *codes]).limit(15)


@query("quantile_forecast")
def _qforecast(p: Pipeline):
    """Linear quantile regression (q05 / q50 / q95) over the whole catalogue and the ids,
    clipped, non-crossing, interval on test; crossing report."""
    test = p.quantile_predictions.where(F.col("split") == "test")
    return FC.crossing_report(FC.quantile_interval(FC.repaired_quantiles(test), 0.1))


@query("quantile_levels")
def _qlevels(p: Pipeline):
    """share of rows below each fitted quantile, by split."""
    return QR.level_report(p.quantile_predictions, DEFAULT.uncertainty.quantiles)


@query("param_search")
def _search(p: Pipeline):
    """seeded random search, 5 trials over eight parameters of the boosted trees (up to 300 rounds each, early
    stopping on val), minimising validation RMSE over one written table of vectors."""
    trees, vectors = p.tree_inputs
    bins = trees.getStages()[-1].getMaxBins()
    return FC.random_search(vectors, lambda **drawn: FC.gbt_trial(bins, validationTol=TREE_TOLERANCE, **drawn), FC.GBT_SPACE, n_trials=5, seed=42)


@query("scenario_savings_ranking")
def _scen_rank(p: Pipeline):
    """Scenarios ranked by net savings."""
    return L.scenario_savings_ranking(L.scenario_kpis(p.impact, p.cfg.simulation.high_volatility_pct))
