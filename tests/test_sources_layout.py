"""Readers / writers (A1, A2, A5-A9), catalogue (D16), narrowing."""

import os

import pytest
from pyspark.sql import functions as F

from stockpulse.operators import features as FE
from stockpulse.operators import layout as LY
from stockpulse.sources import tables as TB
from stockpulse.sources import testdata as TD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def panel(spark):
    return TD.sales_long(spark, SF)


def test_panel_shape_matches_fixture_rule(panel):
    # FIXTURES.md: sf0.001 -> 168 observed series x 730 days
    assert panel.count() == 168 * 730
    assert panel.select("item_id", "store_id").distinct().count() == 168
    assert panel.where(F.col("sales") < 0).count() == 0


def test_calendar_rules(spark):
    cal = TD.calendar(spark)
    r = {x.d: x for x in cal.where(F.col("d").isin("d_1", "d_54", "d_61")).collect()}
    assert r["d_1"].weekday == "Tuesday" and r["d_1"].wday == 4      # 1999-11-02, M5 wday 1 = Saturday
    assert r["d_54"].event_name_1 == "Christmas"                       # 1999-12-25
    assert r["d_61"].event_name_1 == "NewYear" and r["d_61"].event_name_2 == "Parade"
    assert cal.count() == 730


def test_csv_parquet_json_roundtrip(spark, panel, tmp_path):
    small = panel.where(F.col("day_index") <= 3)
    p_csv, p_pq, p_json = str(tmp_path / "s.csv"), str(tmp_path / "s.parquet"), str(tmp_path / "s.json")
    LY.write_csv(small, p_csv)
    LY.write_parquet(small, p_pq, partition_by=["store_id"], sort_within=["item_id", "day_index"])
    LY.write_json(small.groupBy("store_id").agg(F.sum("sales").alias("units")), p_json)
    back = TB.load_csv(spark, p_csv, small.schema)
    assert back.count() == small.count()
    assert TB.load_csv(spark, p_csv, small.schema, nrows=5).count() == 5
    pq = TB.read_stage_output(spark, p_pq)
    assert pq.count() == small.count() and {"cat_id", "dept_id"} <= set(pq.columns)
    assert spark.read.json(p_json).count() == small.select("store_id").distinct().count()


def test_missing_inputs_fail_up_front(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        TB.load_m5_tables(spark, {"calendar": str(tmp_path / "no.csv"), "prices": str(tmp_path / "no2.csv"),
                                  "sales": str(tmp_path / "no3.csv")})


def test_catalogue_and_schema():
    states = list(TD.FIXTURE_STATES)
    cat = FE.feature_catalogue(states)
    assert len(cat) == 52 and list(cat)[-1] == "split"
    cols = FE.feature_columns(states)
    assert "is_zero_sales" not in cols and "sales" not in cols and "split" not in cols
    assert FE.feature_schema(states)["rolling_std_28"].dataType.typeName() == "double"


def test_narrowing_is_safe(spark, panel):
    plan = LY.narrow_plan(panel.select("day_index", "sales"))
    assert plan["day_index"] == "short"
    out = LY.narrow_schema(panel, plan)
    assert dict(out.dtypes)["day_index"] == "smallint"
    assert out.agg(F.sum("sales")).first()[0] == panel.agg(F.sum("sales")).first()[0]
