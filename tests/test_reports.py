"""The named reports: contents against the tables they describe, and their round trip through files."""

import json
import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpulse.config import DEFAULT, PanelConfig
from stockpulse.operators import reports
from stockpulse.operators.features import feature_catalogue
from stockpulse.plans import pipeline as pl

SF = "/root/testdata/sf0.001"
SMALL = replace(DEFAULT, panel=PanelConfig("2000-10-01", 120, 64, 92, 120))


@pytest.fixture(scope="module")
def small(spark):
    return pl.Pipeline(spark, SF, SMALL, materialize=True)


def test_reports_round_trip(spark, small, tmp_path):
    paths = small.write_reports(str(tmp_path))
    assert sorted(paths) == ["feature_catalogue", "kpis", "split_index", "validation"]
    for name, report in small.reports.items():
        back = reports.read_report(spark, paths[name], report.schema)
        assert back.schema.simpleString() == report.schema.simpleString()
        assert back.collect() == report.collect()
        parts = [f for f in os.listdir(paths[name]) if f.endswith(".json")]
        lines = [json.loads(x) for f in parts for x in open(os.path.join(paths[name], f))]
        assert len(lines) == 1 and set(lines[0]) == set(report.columns)
    assert small.write_reports() == small.write_reports()


def test_report_contents(spark, small):
    features = small.features
    catalogue = small.reports["feature_catalogue"].first()
    assert set(catalogue["features"]) == set(feature_catalogue(small.states)) and catalogue["n_features"] == len(catalogue["features"])
    assert sum(catalogue["groups"].values()) == catalogue["n_features"]
    seen = features.select("split", "day_index", "date", "sales").toPandas()
    splits = small.reports["split_index"].first()["splits"]
    for name, own in seen.groupby("split"):
        s = splits[name]
        assert (s["day_index_min"], s["day_index_max"], s["n_days"], s["n_rows"]) == (own["day_index"].min(), own["day_index"].max(), own["day_index"].nunique(), len(own))
        assert (s["date_start"], s["date_end"]) == (str(own["date"].min()), str(own["date"].max()))
    v = small.reports["validation"].first()
    assert v["all_passed"] == all(c["passed"] for c in v["validation_checks"].values())
    assert v["n_checks_total"] == len(v["validation_checks"]) == 8
    assert v["split_counts"] == seen["split"].value_counts().to_dict() and v["dataset_shape"]["rows"] == len(seen)
    t = v["target_stats"]
    assert (t["mean"], t["std"], t["max"]) == pytest.approx((seen["sales"].mean(), np.std(seen["sales"], ddof=1), seen["sales"].max()), abs=1e-4)
    assert t["zero_pct"] == pytest.approx(100 * (seen["sales"] == 0).mean(), abs=0.051)
    kpis = small.reports["kpis"].first()
    saved = kpis["policies"]["Baseline"]["Total_Cost"] - kpis["policies"]["Proposed"]["Total_Cost"]
    assert kpis["comparison"]["Net_Savings"] == pytest.approx(saved)


def test_reports_of_broken_and_empty_tables(spark, small):
    broken = small.features.withColumn("sales", F.when(F.col("day_index") == 3, -1).otherwise(F.col("sales")))
    v = reports.validation_summary(broken, small.states, small.expected_rows).first()
    assert not v["all_passed"] and not v["validation_checks"]["no_negative_sales"]["passed"]
    assert v["n_checks_passed"] < v["n_checks_total"]
    empty = small.features.limit(0)
    v = reports.validation_summary(empty, small.states, small.expected_rows).first()
    assert not v["validation_checks"]["row_count"]["passed"] and v["split_counts"] == {} and v["target_stats"]["mean"] is None
    assert reports.split_index_report(empty).first()["splits"] == {}
