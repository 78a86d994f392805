"""Unit tests on tiny hand-computed fixtures (FIXTURES.md part 3)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpulse.operators import conformal as H
from stockpulse.operators import features as FE
from stockpulse.operators import forecast as FC
from stockpulse.operators import impact as L
from stockpulse.operators import panel as P
from stockpulse.operators import risk as K
from stockpulse.operators.quantiles import global_quantiles, select_quantiles


def test_melt_both_methods_agree(spark):
    wide = spark.createDataFrame([("A", 1, 2, 3), ("B", 4, 5, 6)], "id string, d_1 int, d_2 int, d_3 int")
    a = P.melt(wide, ["id"]).orderBy("id", "d").collect()
    b = P.melt(wide, ["id"], method="unpivot").orderBy("id", "d").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    assert len(a) == 6
    assert P.add_day_index(P.melt(wide, ["id"])).agg(F.max("day_index")).first()[0] == 3


def test_gap_price_fill_uses_day_order(spark):
    # prices null,5,null,7 on days 1,2,3,10 -> 5,5,5,7 (string order of d would differ)
    df = spark.createDataFrame([("I", "S", 1, None), ("I", "S", 2, 5.0), ("I", "S", 3, None), ("I", "S", 10, 7.0)],
                               "item_id string, store_id string, day_index int, sell_price double")
    out = [r.sell_price for r in P.fill_prices(df).orderBy("day_index").collect()]
    assert out == [5.0, 5.0, 5.0, 7.0]


def test_all_null_price_becomes_zero(spark):
    df = spark.createDataFrame([("I", "S", 1, None), ("I", "S", 2, None)],
                               "item_id string, store_id string, day_index int, sell_price double")
    assert [r.sell_price for r in P.fill_prices(df).collect()] == [0.0, 0.0]


def test_rolling_frame_excludes_today(spark):
    # sales 3,0,0,5,1, frame 3: mean 0,3,1.5,1,1.667; std 0,0,2.1213,1.7321,2.8868
    df = spark.createDataFrame([("I", "S", i + 1, v) for i, v in enumerate([3, 0, 0, 5, 1])],
                               "item_id string, store_id string, day_index int, sales int")
    out = FE.rolling_features(df, [3], [3]).orderBy("day_index").collect()
    assert np.allclose([r.rolling_mean_3 for r in out], [0, 3, 1.5, 1, 5 / 3], atol=1e-4)
    assert np.allclose([r.rolling_std_3 for r in out], [0, 0, 2.1213, 1.7321, 2.8868], atol=1e-4)


def test_lag_zero_fill(spark):
    df = spark.createDataFrame([("I", "S", i + 1, i) for i in range(10)],
                               "item_id string, store_id string, day_index int, sales int")
    out = FE.lag_features(df, [7]).orderBy("day_index").collect()
    assert [r.lag_7 for r in out] == [0.0] * 7 + [0.0, 1.0, 2.0]


def test_iso_week_and_weekday(spark):
    df = spark.createDataFrame([("2012-01-01",), ("2016-01-01",)], "s string").select(F.to_date("s").alias("date"))
    out = FE.date_features(df).collect()
    assert [r.week for r in out] == [52, 53]
    assert out[0].day_of_week == 6 and out[0].is_weekend == 1   # Sunday, 0 = Monday


def test_pav_closed_form_matches_isotonic(spark):
    rows = [(5.0, 3.0, 4.0), (1.0, 2.0, 3.0), (9.0, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "q05_clip double, q50_clip double, q95_clip double")
    out = [(r.q05, r.q50, r.q95) for r in FC.non_crossing(df).collect()]
    assert np.allclose(out, [(4, 4, 4), (1, 2, 3), (5, 5, 5)])
    rng = np.random.default_rng(0)
    trip = rng.normal(size=(500, 3))
    df = spark.createDataFrame([tuple(map(float, t)) for t in trip], "q05_clip double, q50_clip double, q95_clip double")
    got = np.array([(r.q05, r.q50, r.q95) for r in FC.non_crossing(df).collect()])
    assert np.all(np.diff(got, axis=1) >= -1e-12)
    assert np.allclose(got, np.array([_pava(t) for t in trip]), atol=1e-12)


def _pava(y):
    blocks = [[v, 1] for v in y]
    i = 0
    while i < len(blocks) - 1:
        if blocks[i][0] > blocks[i + 1][0]:
            v = (blocks[i][0] * blocks[i][1] + blocks[i + 1][0] * blocks[i + 1][1]) / (blocks[i][1] + blocks[i + 1][1])
            blocks[i] = [v, blocks[i][1] + blocks[i + 1][1]]
            del blocks[i + 1]
            i = max(i - 1, 0)
        else:
            i += 1
    return [b[0] for b in blocks for _ in range(b[1])]


@pytest.mark.parametrize("n", [97, 560, 5600])
def test_conformal_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    y = rng.poisson(2.0, n).astype(float)
    p = rng.gamma(2.0, 1.0, n)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "actual double, point double")
    alphas = [0.5, 0.2, 0.1, 0.05]
    scores = np.abs(y - p)
    lin = {r.alpha: r.q_hat for r in H.thresholds_for_alphas(df, alphas, n=n).collect()}
    hig = {r.alpha: r.q_hat for r in H.thresholds_for_alphas(df, alphas, method="higher", n=n).collect()}
    for a in alphas:
        lvl = min(math.ceil((n + 1) * (1 - a)) / n, 1.0)
        assert lin[a] == pytest.approx(np.quantile(scores, lvl), abs=1e-12)
        assert hig[a] == pytest.approx(np.quantile(scores, lvl, method="higher"), abs=1e-12)
    thr = H.calibrate(df, 0.1, n=n).first()
    signed = y - p
    lo, hi = H.asymmetric_levels(n, 0.1)
    assert thr.q_hat_lo_asymmetric == pytest.approx(np.quantile(signed, lo), abs=1e-12)
    assert thr.q_hat_hi_asymmetric == pytest.approx(np.quantile(signed, hi), abs=1e-12)


def test_select_quantiles_exact(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([np.zeros(3000), rng.exponential(2.0, 5000), rng.normal(50, 1, 200)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.05, 0.5, 0.6, 0.85, 0.9, 0.999]
    got = select_quantiles(df, "x", probs, partitions=7)
    ref = global_quantiles(df, "x", probs, mode="exact").first()
    assert np.allclose(got, [ref[f"q{i}"] for i in range(len(probs))], rtol=0, atol=1e-9)
    assert np.allclose(got, np.quantile(vals, probs), atol=1e-9)


def test_root_cause_tie_order_and_low(spark):
    df = spark.createDataFrame([("High", 0.5, 0.5, 0.5, 0.5), ("Medium", 0.1, 0.9, 0.9, 0.2), ("Low", 1.0, 0.0, 0.0, 0.0)],
                               "Risk_Level string, comp_width double, comp_error double, comp_volat double, comp_calib double")
    out = [r.rc for r in df.select(K.root_cause().alias("rc")).collect()]
    assert out[0].endswith("volatile historical demand.")
    assert out[1].endswith("volatile historical demand.")
    assert out[2] == "Demand is stable and predictable."


def test_minmax_flat_component(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r.n for r in K.minmax(df, "x", "n").collect()] == [0.0, 0.0]


def test_half_even_orders(spark):
    df = spark.createDataFrame([(0.5, 0.5), (1.5, 1.5), (2.5, 2.5)], "point double, Recommended_Stock_Level double")
    assert [r.Baseline_Order for r in L.order_policies(df).collect()] == [0.0, 2.0, 2.0]


def test_policy_identities_and_roi_null(spark):
    df = spark.createDataFrame([(3, 2.0, 2.0, 10.0), (1, 4.0, 4.0, 10.0)],
                               "actual int, Baseline_Order double, Proposed_Order double, sell_price double")
    c = L.policy_costs(df).collect()
    for r in c:
        assert r.Baseline_Sold_Units + r.Baseline_Stockout_Units == r.actual
        assert r.Baseline_Sold_Units + r.Baseline_Overstock_Units == r.Baseline_Order
    k = L.policy_kpis(L.policy_costs(df)).first()
    assert k.ROI is None   # no extra holding -> NULL instead of infinity


def test_scenarios_overlap(spark):
    rows = [(1, 10.0), (0, 1.0), (0, 0.5), (1, 0.1)]
    df = spark.createDataFrame(rows, "has_any_event int, rolling_std_28 double")
    s = {r.scenario: r.n for r in L.scenario_frame(df).groupBy("scenario").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert s["Holiday_Event"] == 2 and s["High_Volatility"] == 1
    assert sum(s.values()) > len(rows)   # overlapping, not a partition


def test_sensitivity_grid_equals_rowwise(spark):
    rows = [(3, 1.0, 2.0, 5.0), (0, 2.0, 0.0, 7.0), (5, 5.0, 6.0, 1.5)]
    df = L.policy_costs(spark.createDataFrame(rows, "actual int, Baseline_Order double, Proposed_Order double, sell_price double"))
    g = {(r.Holding_Rate, r.Stockout_Rate): r for r in L.sensitivity_grid(df, [0.1, 0.2], [0.4]).collect()}
    for h in (0.1, 0.2):
        direct = L.policy_kpis(L.policy_costs(df, h, 0.4)).first()
        assert g[(h, 0.4)].Baseline_Total_Cost == pytest.approx(direct.Baseline_Total_Cost)
        assert g[(h, 0.4)].Net_Savings == pytest.approx(direct.Net_Savings)


def test_discrete_selection_matches_percentile_disc(spark):
    rng = np.random.default_rng(5)
    vals = np.concatenate([np.zeros(500), rng.exponential(3.0, 1500)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    n = len(vals)
    probs = [(r + 0.5) / n for r in (0, 17, 499, 500, 1234, n - 1)]
    a = global_quantiles(df, "x", probs, mode="disc").first()
    b = global_quantiles(df, "x", probs, mode="select_disc").first()
    s = np.sort(vals)
    for i, r in enumerate((0, 17, 499, 500, 1234, n - 1)):
        assert a[f"q{i}"] == s[r] == b[f"q{i}"]


def test_distinct_counts_bounded_list(spark):
    from stockpulse.operators.quality import distinct_counts
    df = spark.createDataFrame([(str(i % 20), str(i % 3)) for i in range(100)], "a string, b string")
    out = {r.column: r for r in distinct_counts(df, ["a", "b"]).collect()}
    assert out["a"].n_distinct == 20 and out["a"]["values"] is None
    assert out["b"].n_distinct == 3 and list(out["b"]["values"]) == ["0", "1", "2"]


def test_distributed_ecdf_equals_cume_dist(spark):
    from pyspark.sql import Window
    from stockpulse.operators.metrics import score_ecdf
    rng = np.random.default_rng(11)
    rows = [("A" if i % 3 else "B", float(v)) for i, v in enumerate(np.round(rng.exponential(2.0, 3000), 1))]
    rows += [("A", 0.0)] * 1000   # a hot value
    df = spark.createDataFrame(rows, "method string, w double")
    got = {(r.method, r.w): r.ecdf for r in score_ecdf(df, "w", partitions=7).collect()}
    ref = {(r.method, r.w): r.e for r in df.select("method", "w", F.cume_dist().over(
        Window.partitionBy("method").orderBy("w")).alias("e")).distinct().collect()}
    assert got.keys() == ref.keys()
    assert all(abs(got[k] - ref[k]) < 1e-12 for k in ref)


def test_policy_kpis_long(spark):
    df = spark.createDataFrame([(3, 2.0, 4.0, 10.0)], "actual int, Baseline_Order double, Proposed_Order double, sell_price double")
    k = L.policy_kpis(L.policy_costs(df))
    long = {(r.policy, r.kpi): r.value for r in L.policy_kpis_long(k).collect()}
    assert long[("Baseline", "Stockout_Units")] == 1.0 and long[("Proposed", "Overstock_Units")] == 1.0
    assert len(long) == 18


def test_grouped_quantiles_select_equals_exact(spark):
    from stockpulse.operators.quantiles import grouped_quantiles
    rng = np.random.default_rng(9)
    rows = [("A" if i % 2 else "B", float(v)) for i, v in enumerate(rng.gamma(1.5, 2.0, 4000))]
    df = spark.createDataFrame(rows, "m string, x double")
    probs = [0.25, 0.5, 0.95]
    a = {r.m: [r.q0, r.q1, r.q2] for r in grouped_quantiles(df, "x", probs, ["m"], mode="exact").collect()}
    b = {r.m: [r.q0, r.q1, r.q2] for r in grouped_quantiles(df, "x", probs, ["m"], mode="select").collect()}
    for k in a:
        assert np.allclose(a[k], b[k], rtol=0, atol=1e-9)


def test_glm_is_fitted_on_train_rows_only(spark):
    from stockpulse.operators import forecast as FC
    df = spark.createDataFrame([("train", 1.0), ("train", 2.0), ("val", 3.0), ("test", 4.0)], "split string, x double")
    assert sorted(r["split"] for r in FC.fit_rows(df, FC.tweedie_model(["x"])).collect()) == ["train", "train"]
    assert sorted((r["split"], r["is_val"]) for r in FC.fit_rows(df, FC.gbt_model(["x"])).collect()) == [("train", False), ("train", False), ("val", True)]


def test_whole_window_keeps_all_shipments(spark):
    from pyspark.sql import functions as F
    from stockpulse.sources import testdata as TD
    sf = "/root/testdata/sf0.001"
    cfg = TD.whole_window(spark, sf)
    sold = TD.sales_long(spark, sf, cfg).agg(F.sum("sales")).first()[0]
    assert sold == spark.read.parquet(f"{sf}/lineitem.parquet").agg(F.sum("l_quantity")).first()[0]
    assert cfg.n_days - cfg.val_end == cfg.val_end - cfg.train_end == 28


def test_calendar_schema_is_not_changed_by_reading(spark, tmp_path):
    from stockpulse.sources import tables as TB
    n = len(TB.CALENDAR_SCHEMA.fields)
    for name in ("calendar", "prices", "sales"):
        (tmp_path / f"{name}.csv").write_text("a\n1\n")
    for _ in range(2):
        TB.load_m5_tables(spark, {k: str(tmp_path / f"{k}.csv") for k in ("calendar", "prices", "sales")})
    assert len(TB.CALENDAR_SCHEMA.fields) == n


def test_quantiles_of_many_groups_equal_exact(spark):
    from stockpulse.operators.quantiles import grouped_quantiles
    rng = np.random.default_rng(17)
    rows = [(None if g == 7 else g, float(v)) for g in range(240) for v in np.round(rng.gamma(1.5, 2.0, 20 + g % 5), 2)]
    rows += [(3, 1.0)] * 2000 + [(5, None)] * 9 + [(500, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [i / 10 for i in range(11)]
    a = {r.g: list(r)[1:] for r in grouped_quantiles(df, "x", probs, ["g"], mode="exact").collect()}
    b = {r.g: list(r)[1:] for r in grouped_quantiles(df, "x", probs, ["g"]).collect()}
    assert a.pop(500) == [None] * 11
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose(a[k], b[k], rtol=0, atol=1e-12)


def test_quantiles_of_no_rows(spark):
    r = global_quantiles(spark.createDataFrame([], "x double"), "x", [0.1, 0.5]).collect()
    assert [list(x) for x in r] == [[None, None]]


def test_rolling_std_of_large_sales(spark):
    from pyspark.sql import Window
    from stockpulse.operators.features import exact_std
    df = spark.createDataFrame([(i, 600_000_000 + i % 2) for i in range(40)], "i int, x long")
    last = df.select("i", exact_std(F.col("x"), Window.orderBy("i").rowsBetween(-28, -1)).alias("s")).where("i = 39").first()
    assert last.s == pytest.approx(np.std([i % 2 for i in range(28)], ddof=1), rel=1e-12)


def test_counted_scores_serve_every_threshold(spark):
    """Picks from one counted table equal NumPy's quantiles of the scores."""
    rng = np.random.default_rng(5)
    y, p = rng.integers(0, 40, 500).astype(float), rng.uniform(0, 40, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)] + [(None, 1.0)], "actual double, point double")
    counts = H.score_counts(df)
    n = 500
    t = H.calibrate(df, 0.1, n=n, counts=counts)
    got, own = t.first(), H.calibrate(df, 0.1, n=n, mode="exact").first()
    s = y - p
    lo, hi = H.asymmetric_levels(n, 0.1)
    want = [np.quantile(abs(s), H.corrected_level(n, 0.1)), np.quantile(s, lo), np.quantile(s, hi)]
    assert np.allclose([got.q_hat_symmetric, got.q_hat_lo_asymmetric, got.q_hat_hi_asymmetric], want)
    assert np.allclose([own.q_hat_symmetric, own.q_hat_lo_asymmetric, own.q_hat_hi_asymmetric], want)
    high = {r.alpha: r.q_hat for r in H.thresholds_for_alphas(df, [0.2, 0.05], method="higher", n=n, counts=counts).collect()}
    assert all(high[a] == np.quantile(abs(s), H.corrected_level(n, a), method="higher") for a in (0.2, 0.05))
    r = H.calibration_summary(df, t, counts=counts).first()
    assert np.allclose([r.score_min, r.score_p25, r.score_median, r.score_p75, r.score_max], np.quantile(abs(s), [0, 0.25, 0.5, 0.75, 1]))
    assert np.allclose([r.score_mean, r.score_std], [abs(s).mean(), abs(s).std()])
