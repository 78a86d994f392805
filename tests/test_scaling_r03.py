"""Round 3 findings: wide unpivots, linear day arrays, rolling sums and vectors written once."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockpulse.config import PanelConfig
from stockpulse.operators import features as FE
from stockpulse.operators import forecast as FC
from stockpulse.operators import panel as P
from stockpulse.sources import testdata as TD


def _expand_sizes(df):
    node, sizes, todo = None, [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Expand":
            sizes.append(node.projections().size())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return sizes


def test_unpivot_of_many_columns_by_blocks(spark):
    n = 2 * P.UNPIVOT_BLOCK + 5
    rows = [("a'b", *[k if k % 3 else None for k in range(n)]), ("a'b", *range(n)), (None, *range(n))]
    wide = spark.createDataFrame(rows, "id string, " + ", ".join(f"d_{k + 1} int" for k in range(n)))
    long = P.melt(wide, ["id"], method="unpivot")
    assert max(_expand_sizes(long)) <= P.UNPIVOT_BLOCK
    assert long.columns == ["id", "d", "sales"]
    want = sorted(((r[0], f"d_{k + 1}", r[k + 1]) for r in rows for k in range(n)), key=repr)
    assert sorted(map(tuple, long.collect()), key=repr) == want
    assert sorted(map(tuple, P.melt(wide, ["id"]).collect()), key=repr) == want


def test_unpivot_of_mixed_types_and_odd_names(spark):
    n = P.UNPIVOT_BLOCK + 2
    wide = spark.range(2).select("id", *[F.lit(k).cast("int" if k else "bigint").alias(f"it's `{k}") for k in range(n)])
    for frame in (wide, wide.select("id", *[F.col("`" + c.replace("`", "``") + "`").cast("int").alias(c) for c in wide.columns[1:]])):
        got = P.melt(frame, ["id"], [c for c in frame.columns if c != "id"], method="generate").collect()
        assert sorted(map(tuple, got)) == sorted((i, f"it's `{k}", k) for i in range(2) for k in range(n))


def _maps(spark):
    rows = [("p", "s", {2: (5, 1.0), 7: (None, 1.0), 9: (1, 2.0)}), ("q", "s", {1: (3, 1.0), 10: (4, 1.0)}), ("r", "s", {4: (8, 1.0)})]
    return spark.createDataFrame(rows, "item_id string, store_id string, day_sales map<int, struct<qty: int, max_price: double>>"), rows


def test_day_arrays_without_join(spark):
    maps, rows = _maps(spark)
    cfg = PanelConfig("2000-01-01", 10, 8, 9, 4)
    long = TD.sales_long(spark, "", cfg, maps)
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    unit = lambda m, d: (m.get(d) or (0,))[0] or 0
    want = sorted((i, s, d, f"d_{d}", unit(m, d)) for i, s, m in rows for d in range(1, 11))
    assert sorted(map(tuple, long.select("item_id", "store_id", "day_index", "d", "sales").collect())) == want
    for first, n in ((7, 4), (1, 10), (3, 2)):
        wide = TD.sales_wide(spark, "", cfg, first, n, maps)
        got = {r["item_id"]: [r[f"d_{d}"] for d in range(first, first + n)] for r in wide.collect()}
        assert got == {i: [unit(m, d) for d in range(first, first + n)] for i, _, m in rows}


def test_rolling_features_from_running_sums(spark):
    rng = random.Random(5)
    rows = [(f"i{s}", "s", d, None if s == 1 and rng.random() < .4 else rng.choice([0, 3, 50, 2_000_000_000 * (s == 2)])) for s in range(3) for d in range(1, 61)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, day_index int, sales int")
    for least in (1, 3):
        got = FE.rolling_features(df, (7, 28), (7, 28), least)
        assert "sliding" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert "specifiedwindowframe(RowFrame, -28, -1)" not in got._jdf.queryExecution().optimizedPlan().toString()
        w, y = Window.partitionBy("item_id", "store_id").orderBy("day_index"), F.col("sales").cast("double")
        exprs = []
        for n in (7, 28):
            fr = w.rowsBetween(-n, -1)
            enough = F.count(y).over(fr) >= least
            exprs += [F.coalesce(F.when(enough, F.avg(y).over(fr)), F.lit(0.0)).alias(f"rolling_mean_{n}"),
                      F.coalesce(F.when(enough, FE.exact_std(F.col("sales"), fr)), F.lit(0.0)).alias(f"rolling_std_{n}")]
        old = df.select("*", *exprs).select(got.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, old.collect()))


def test_model_is_fitted_on_vectors_written_once(spark):
    df = spark.range(200).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("sales"),
                                 F.when(F.col("id") < 150, "train").otherwise("val").alias("split"))
    seen = []

    def write(vectors):
        seen.append(vectors.columns)
        return vectors.localCheckpoint()

    pipeline = FC.tweedie_model(["x"], reg=1e-4)
    plain, held = FC.fit_point_model(df, pipeline), FC.fit_point_model(df, pipeline, write=write)
    assert seen == [["sales", "features", "is_val"]]
    assert abs(plain.stages[-1].coefficients[0] - held.stages[-1].coefficients[0]) < 1e-9
    assert FC.predict_clipped(held, df).count() == 200
