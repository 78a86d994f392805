"""Dictionaries, quantile regression, the partitioned sink, lag leaks, one-pass profiles, user files and stage reuse."""

import os
import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpulse.config import DEFAULT, PanelConfig
from stockpulse.operators import encode, forecast, layout, panel, quality, quantile_regression
from stockpulse.plans import pipeline as pl
from stockpulse.sources import tables, testdata

SF = "/root/testdata/sf0.001"
SMALL = replace(DEFAULT, panel=PanelConfig("2000-10-01", 120, 64, 92, 120))


def scans(df) -> int:
    """File scans of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("FileScan ") + plan.count("Scan ExistingRDD")


@pytest.fixture(scope="module")
def small(spark):
    return pl.Pipeline(spark, SF, SMALL, materialize=True)


# ------------------------------------------------------------ C6 / F1
def test_dictionary_is_dense_and_ordered(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abcdefghij") * rng.randrange(1, 4), rng.choice([None, "x", "y", ""]), k % 7) for k in range(500)]
    df = spark.createDataFrame(rows, "a string, b string, n int").repartition(7)
    got = {}
    for c, v, code, n in encode.value_dictionary(df, ["a", "b", "n"]).collect():
        got.setdefault(c, {})[v] = (code, n)
    for k, c in enumerate("abn"):
        seen = Counter(str(r[k]) if c == "n" else r[k] for r in rows if r[k] is not None)
        assert got[c] == {v: (i, seen[v]) for i, v in enumerate(sorted(seen))}


@pytest.mark.parametrize("limit", [0, 100_000])
def test_encode_unseen_and_null(spark, monkeypatch, limit):
    """By a shuffle and by a broadcast; clashing names give way."""
    monkeypatch.setattr(encode, "BROADCAST_VALUES", limit)
    d = encode.Dictionary.fit(spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "v string"), ["v"])
    new = spark.createDataFrame([(1, "a", 9), (2, "b", 9), (3, "z", 9), (4, None, 9)], "k int, v string, v_code int")
    out = d.encode(new)
    assert {r["k"]: r["v_code"] for r in out.collect()} == {1: 0, 2: 1, 3: 2, 4: 2}
    assert out.schema["v_code"].metadata["ml_attr"]["num_vals"] == 3
    assert d.encode(new.limit(0)).count() == 0
    none = encode.Dictionary.fit(new.limit(0), ["v"])
    assert none.sizes == {"v": 0} and {r["v_code"] for r in none.encode(new).collect()} == {0}


def test_model_inputs_are_the_whole_catalogue(small):
    rows, numeric, codes = small.model_inputs
    assert {"item_id_code", "store_id_code", "weekday_code", "event_type_1_code"} <= set(codes)
    assert {"lag_28", "rolling_std_28", "price_pct_change", "snap_ASIA", "is_religious"} <= set(numeric)
    assert "is_zero_sales" not in numeric and "sales_num" not in numeric
    assert rows.count() == small.features.count()


# ------------------------------------------------------------ F7 / F8 / F9
def test_quantile_levels_on_train(spark):
    """Heteroscedastic line with a category: shares within a point, coefficients near the true ones."""
    rng = np.random.default_rng(2)
    n = 6000
    x, g = rng.uniform(0, 10, n), rng.integers(0, 3, n)
    y = 5 + 2 * x + np.array([0, 4, -3])[g] + (0.5 + 0.3 * x) * rng.standard_normal(n)
    df = spark.createDataFrame([(float(a), float(2.0), int(b), float(c)) for a, b, c in zip(x, g, y)], "x double, same double, g_code int, sales double").repartition(5)
    levels = (0.05, 0.5, 0.9, 0.95)
    m = quantile_regression.fit_quantiles(df, ["x", "same"], "sales", levels, {"g_code": 4}, tol=1e-5)
    got = m.predict(df).select("sales", *[f"q{int(round(q * 100)):02d}_raw" for q in levels]).toPandas()
    for q in levels:
        assert abs((got["sales"] < got[f"q{int(round(q * 100)):02d}_raw"]).mean() - q) < 0.01
    assert abs(m.slopes[0.5][0] - 2) < 0.1 and abs(m.steps[0.5]["g_code"][1] - 4) < 0.3
    assert m.slopes[0.95][0] > m.slopes[0.5][0] > m.slopes[0.05][0]


def test_quantile_levels_with_many_zeros(small):
    """On the panel a share of rows lies exactly on 0: each level is between the share below and that at or below."""
    rep = quantile_regression.level_report(small.quantile_predictions.where("split = 'train'")).collect()
    assert len(rep) == 3
    for r in rep:
        assert r["below"] - 0.01 <= r["level"] <= r["at_or_below"] + 0.01


def test_isotonic_any_number(spark):
    rows = [(1.0, 2.0, 3.0, 4.0, 5.0), (5.0, 4.0, 3.0, 2.0, 1.0), (1.0, 3.0, 2.0, 2.0, 9.0), (-4.0, 0.0, -1.0, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "q05_raw double, q25_raw double, q50_raw double, q75_raw double, q95_raw double")
    got = [tuple(r) for r in forecast.repaired_quantiles(df, ["q05", "q25", "q50", "q75", "q95"]).select("q05", "q25", "q50", "q75", "q95").collect()]

    def pav(v):
        groups = []
        for x in v:
            groups.append([max(x, 0.0), 1])
            while len(groups) > 1 and groups[-2][0] > groups[-1][0]:
                (b, nb), (a, na) = groups.pop(), groups.pop()
                groups.append([(a * na + b * nb) / (na + nb), na + nb])
        return [x for x, n in groups for _ in range(n)]

    for row, out in zip(rows, got):
        assert out == pytest.approx(pav(row))
    two = forecast.repaired_quantiles(df, ["q05", "q95"]).select("q05", "q95").collect()
    assert tuple(two[1]) == (3.0, 3.0)


# ------------------------------------------------------------ A6
def test_partitioned_sink_splits_a_hot_value(spark, tmp_path):
    """A value of 90 % of the rows is written by several tasks, into sorted files; narrow types survive."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, F.concat(F.lit("s"), (F.col("id") % 30).cast("string"))).otherwise(F.lit("hot")).alias("store_id"),
                                       F.concat(F.lit("i"), (F.col("id") * 7919 % 1000).cast("string")).alias("item_id"), (F.col("id") * 31 % 500).alias("day_index"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("pad")).repartition(8)
    path = str(tmp_path / "out")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        layout.write_parquet(rows, path, ["store_id"], ["item_id", "day_index"], narrow=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = [f for f in os.listdir(f"{path}/store_id=hot") if f.endswith(".parquet")]
    assert len(hot) > 3
    for f in hot:
        part = spark.read.parquet(f"{path}/store_id=hot/{f}").select("item_id", "day_index").toPandas()
        keys = list(map(tuple, part.to_numpy().tolist()))
        assert keys == sorted(keys)
    back = spark.read.parquet(path)
    assert back.count() == 200_000 and back.where("store_id = 'hot'").count() == 180_000
    assert back.schema["day_index"].dataType.typeName() == "short"


# ------------------------------------------------------------ E16, E12-E18
def test_lag_leaks_finds_a_shift(small):
    f = small.features
    assert all(r["mismatched"] == 0 and r["lead_in_set"] == 0 and r["matched"] > 0 for r in quality.lag_leaks(f).collect())
    shifted = f.withColumn("lag_7", F.lead("lag_7").over(own_window()))  # tomorrow's lag: one day too fresh
    bad = {r["lag"]: r for r in quality.lag_leaks(shifted).collect()}
    assert bad[7]["mismatched"] > 0 and bad[14]["mismatched"] == 0
    early = f.withColumn("lag_28", F.when(F.col("day_index") <= 28, F.lit(1.0)).otherwise(F.col("lag_28")))
    assert {r["lag"]: r["lead_in_set"] > 0 for r in quality.lag_leaks(early).collect()} == {7: False, 14: False, 28: True}


def own_window():
    from stockpulse.functions.columns import series_window
    return series_window(("item_id", "store_id"), "day_index")


def test_every_check_fails_on_a_broken_table(small):
    f, states, n = small.features, small.states, small.expected_rows
    whole = {r["check"]: r["passed"] for r in quality.validation_checks(f, states, n, (0.0, 1.0)).collect()}
    assert len(whole) == 8 and all(whole.values())
    broken = {
        "row_count": f.where("day_index > 5"),
        "no_nulls_critical": f.withColumn("split", F.when(F.col("day_index") == 3, F.lit(None)).otherwise(F.col("split"))),
        "no_negative_sales": f.withColumn("sales", F.when(F.col("day_index") == 3, F.lit(-1)).otherwise(F.col("sales"))),
        "all_splits_present": f.where("split <> 'val'"),
        "catalogue_columns": f.drop("snap_ASIA"),
        "zero_rate_in_bounds": f.withColumn("sales", F.lit(3)),
        "temporal_order": f.where("day_index <> 40"),
        "no_lag_leakage": f.withColumn("lag_14", F.col("lag_14") + 1),
    }
    for check, table in broken.items():
        got = {r["check"]: r["passed"] for r in quality.validation_checks(table, states, n, (0.01, 0.9999)).collect()}
        assert not got[check], check
    gone = {r["check"]: r for r in quality.validation_checks(f.drop("lag_7", "sales"), states, n).collect()}
    assert not gone["no_lag_leakage"]["passed"] and "lag_7" in gone["no_lag_leakage"]["detail"] and not gone["no_negative_sales"]["passed"]


# ------------------------------------------------------------ B4 / B5 / E3 / E4 / E8 / E9
def test_join_audit_counts(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, None), (9, 4.0), (None, 5.0)], "k int, p double")
    got = panel.join_audit(left, right, ["k"], "p").first()
    plain = left.join(right, "k", "left")
    assert (got["rows_before"], got["rows_after"], got["unmatched_rows"], got["duplicate_right_keys"]) == (5, plain.count(), plain.where("p is null").count(), 1)
    inner = panel.join_audit(left, right, ["k"], "p", "inner").first()
    assert inner["rows_after"] == left.join(right, "k").count()


def test_profiles_in_one_pass(spark, tmp_path):
    rows = [("A_1", "A", "x", "s1", k) for k in (1, 2, 2)] + [("A_2", "A", "y", "s1", 1), ("B_1", "B", None, "s2", 1), ("B_1", "B", None, "s3", 1)]
    df = spark.createDataFrame(rows, "dept_id string, cat_id string, item_id string, store_id string, d int").withColumn("state_id", F.lit("S"))
    df.write.parquet(str(tmp_path / "p"))
    t = spark.read.parquet(str(tmp_path / "p"))
    dup = quality.duplicate_rows(t, ["item_id", "store_id"])
    assert tuple(dup.first()) == (1, 2) and scans(dup) == 1
    assert tuple(quality.duplicate_rows(t).first()) == (1,) and tuple(quality.duplicate_rows(t.limit(0)).first()) == (0,)
    counts = quality.distinct_counts(t, ["cat_id", "item_id", "d"], list_max=2)
    assert {r[0]: (r[1], r[2]) for r in counts.collect()} == {"cat_id": (2, ["A", "B"]), "item_id": (2, ["x", "y"]), "d": (2, ["1", "2"])}
    few = quality.distinct_counts(t, ["store_id"], list_max=2).first()
    assert (few["n_distinct"], few["values"]) == (3, None)
    levels = quality.hierarchy_counts(t)
    assert {(r[0], r[2]): r[3] for r in levels.collect()} == {("cat_dept", "A_1"): 1, ("cat_dept", "A_2"): 1, ("cat_dept", "B_1"): 1, ("state_store", "s1"): 2, ("state_store", "s2"): 1, ("state_store", "s3"): 1}
    assert scans(levels) == 1
    cover = panel.key_coverage(t, t.where("store_id <> 's1'"), {"store": ["store_id"], "series": ["item_id", "store_id"]})
    assert {r["key"]: tuple(r)[1:] for r in cover.collect()} == {"store": (3, 2, 2), "series": (2, 0, 0)}
    assert scans(cover) == 2


def test_calendar_gaps_are_found(spark):
    days = spark.sql("select explode(sequence(date'2020-01-01', date'2020-01-10')) as date")
    cal = days.where("date <> date'2020-01-04'").union(days.limit(1))
    sold = days.where("day(date) in (2, 3, 7)").union(spark.sql("select date'2020-02-01' as date"))
    r = quality.calendar_continuity(cal, sold).first()
    assert (r["rows"], r["expected_days"], r["continuous"], r["missing_dates"], r["repeated_dates"]) == (10, 10, False, 1, 1)
    assert (r["sales_days"], r["sales_days_in_calendar"], r["sales_gaps"]) == (4, 3, 27)


# ------------------------------------------------------------ A1 / A2, stages
@pytest.fixture(scope="module")
def user_files(small, tmp_path_factory):
    root = tmp_path_factory.mktemp("user")
    t = small.tables
    layout.write_csv(t["calendar"], str(root / "calendar"))
    layout.write_csv(t["prices"], str(root / "prices"))
    layout.write_csv(testdata.sales_wide(small.spark, SF, SMALL.panel, 1, 120, small.day_maps), str(root / "sales"))
    return {k: str(root / k) for k in ("calendar", "prices", "sales")}


def test_header_schema(spark, user_files):
    schema = tables.header_schema(spark, user_files["sales"])
    assert [f.dataType.typeName() for f in schema.fields[:7]] == ["string"] * 6 + ["integer"] and len(schema) == 126
    assert tables.header_schema(spark, user_files["calendar"])["snap_ASIA"].dataType.typeName() == "integer"


def test_user_files_give_the_same_features(spark, small, user_files):
    mine = pl.Pipeline.from_files(spark, user_files, materialize=True)
    assert (mine.cfg.panel.start_date, mine.cfg.panel.n_days, mine.cfg.panel.val_end) == ("2000-10-01", 120, 92)
    a, b = (p.features.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in p.features.dtypes]) for p in (mine, small))
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert all(r["passed"] for r in quality.validation_checks(mine.features, mine.states, mine.expected_rows, (0.0, 1.0)).collect())


def test_missing_files_and_columns(spark, user_files, tmp_path):
    with pytest.raises(FileNotFoundError):
        pl.Pipeline.from_files(spark, {**user_files, "prices": str(tmp_path / "none")})
    with pytest.raises(ValueError, match="no path for: prices"):
        tables.load_m5_tables(spark, {k: v for k, v in user_files.items() if k != "prices"})
    (tmp_path / "p.csv").write_text("store_id,item_id,sell_price\na,b,1.0\n")
    with pytest.raises(ValueError, match="wm_yr_wk"):
        pl.Pipeline.from_files(spark, {**user_files, "prices": str(tmp_path / "p.csv")}).raw


def test_changed_files_change_the_answer(spark, user_files, tmp_path):
    path = str(tmp_path / "prices.csv")
    prices = spark.read.csv(user_files["prices"], header=True).toPandas()
    prices.to_csv(path, index=False)
    files = {**user_files, "prices": path}
    total = lambda: pl.Pipeline.from_files(spark, files, materialize=True).features.agg(F.sum("sell_price")).first()[0]
    one = total()
    assert total() == one
    prices["sell_price"] = prices["sell_price"].astype(float) * 2
    prices.to_csv(path, index=False)
    os.utime(path, (os.path.getmtime(path) + 5,) * 2)
    assert total() == pytest.approx(2 * one)


def test_stages_are_released(spark, user_files):
    p = pl.Pipeline.from_files(spark, user_files, materialize=True)
    p.features.count()
    app = spark.sparkContext.applicationId
    folder = os.path.join(spark.conf.get("spark.checkpoint.dir").replace("file://", ""), "stockpulse", app)
    assert os.path.isdir(folder) and any(k[0] == app for k in pl._MATERIALIZED)
    pl.release_stages(spark)
    assert not os.path.exists(folder) and not any(k[0] == app for k in pl._MATERIALIZED)


def test_tree_search_over_shared_vectors(spark):
    """trials draw the same parameters for the same seed, fit trees on train with val for the stop, and come best first."""
    rows = [(f"i{k % 3}", "s", k, "train" if k < 160 else "val", float(k % 7 + 3 * (k % 3)), float(k % 7), k % 3) for k in range(200)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, day_index int, split string, sales double, x double, code int")
    made = forecast.vectors(df, forecast.gbt_model(["x", "code"]))
    assert made.columns == ["item_id", "store_id", "day_index", "split", "sales", "features"]
    space = {**forecast.GBT_SPACE, "max_depth": ("int", 2, 4), "minInstancesPerNode": ("int", 1, 5)}

    def run():
        return forecast.random_search(made, lambda **drawn: forecast.gbt_trial(32, max_iter=4, **drawn), space, n_trials=2, seed=7).collect()

    got = run()
    assert [sorted(r["params"]) for r in got] == [sorted(space)] * 2 and all(1 <= r["trees"] <= 4 for r in got)
    assert [r["val_rmse"] for r in got] == sorted(r["val_rmse"] for r in got) and got[0]["params"] == run()[0]["params"]
    glm = forecast.random_search(made, lambda reg: forecast.tweedie_model([], reg=reg, max_iter=3).getStages()[-1], {"reg": ("loguniform", 1e-3, 1e-1)}, n_trials=1).first()
    assert glm["trees"] is None and glm["val_rmse"] > 0
