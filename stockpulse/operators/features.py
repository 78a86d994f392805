"""Feature engineering (D1-D17) and the feature catalogue.

All series features use one window spec, ``W_series`` = partition by
(item_id, store_id) ordered by day_index, so the whole table needs one
exchange and one sort; every frame (lag, rolling, running, whole-series)
is evaluated inside the same Window operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockpulse.config import FeatureConfig, PanelConfig, NO_EVENT, PRICE_EPS
from stockpulse.functions.columns import series_window
from stockpulse.operators import panel as P

SERIES = ("item_id", "store_id")


# ----------------------------------------------------------------- D2-D4
def date_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Year, month, ISO week, day_of_month, day_of_week (0=Mon),
    quarter, is_weekend."""
    d = F.col(date)
    return (df.withColumn("year", F.year(d))
              .withColumn("month", F.month(d))
              .withColumn("week", F.weekofyear(d))
              .withColumn("day_of_month", F.dayofmonth(d))
              .withColumn("day_of_week", F.weekday(d))
              .withColumn("is_weekend", (F.weekday(d) >= 5).cast("int"))
              .withColumn("quarter", F.quarter(d)))


def zero_flag(df: DataFrame, target: str = "sales") -> DataFrame:
    """is_zero_sales."""
    return df.withColumn("is_zero_sales", (F.col(target) == 0).cast("int"))


# ----------------------------------------------------------------- D5-D8
def price_features(df: DataFrame, price: str = "sell_price", keys=SERIES,
                   causal_mean: bool = False) -> DataFrame:
    """Day-over-day price diff and % change (NULL -> 0), price
    relative to the series mean price (whole series by default; running
    mean when ``causal_mean``), has_price."""
    w = series_window(keys)
    p = F.col(price)
    prev = F.lag(p).over(w)
    mean_frame = (w.rowsBetween(Window.unboundedPreceding, 0) if causal_mean
                  else w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (df.withColumn("price_diff", F.coalesce(p - prev, F.lit(0.0)))
              .withColumn("price_pct_change",
                          F.coalesce((p - prev) / (prev + PRICE_EPS) * 100.0, F.lit(0.0)))
              .withColumn("price_rel_to_mean", p / (F.avg(p).over(mean_frame) + PRICE_EPS))
              .withColumn("has_price", (p > 0).cast("int")))


# ----------------------------------------------------------------- D9-D11
def event_features(df: DataFrame, event_types: Sequence[str] = FeatureConfig().event_types) -> DataFrame:
    """has_event_1/2, has_any_event, is_<type> (slot 1 or slot 2)."""
    e1 = (F.col("event_name_1") != NO_EVENT)
    e2 = (F.col("event_name_2") != NO_EVENT)
    out = (df.withColumn("has_event_1", e1.cast("int"))
             .withColumn("has_event_2", e2.cast("int"))
             .withColumn("has_any_event", (e1 | e2).cast("int")))
    for t in event_types:
        out = out.withColumn(f"is_{t.lower()}",
                             ((F.col("event_type_1") == t) | (F.col("event_type_2") == t)).cast("int"))
    return out


def snap_columns(df: DataFrame, prefix: str = "snap_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix) and c != "snap_active"]


def snap_feature(df: DataFrame, state: str = "state_id", prefix: str = "snap_") -> DataFrame:
    """snap_active = the SNAP flag of the row's own state, else 0."""
    expr = None
    for c in snap_columns(df, prefix):
        st = c[len(prefix):]
        cond = F.col(state) == st
        expr = F.when(cond, F.col(c)) if expr is None else expr.when(cond, F.col(c))
    expr = F.lit(0) if expr is None else expr.otherwise(F.lit(0))
    return df.withColumn("snap_active", expr.cast("int"))


# ----------------------------------------------------------------- D12-D14
def lag_features(df: DataFrame, lags: Sequence[int] = FeatureConfig().lags,
                 target: str = "sales", keys=SERIES) -> DataFrame:
    """D12 (+C3): lag_n = value n rows earlier in the series, NULL -> 0."""
    w = series_window(keys)
    return df.select("*", *[F.coalesce(F.lag(F.col(target).cast("double"), n).over(w), F.lit(0.0))
                            .alias(f"lag_{n}") for n in lags])


def rolling_features(df: DataFrame, mean_windows: Sequence[int] = FeatureConfig().rolling_mean_windows,
                     std_windows: Sequence[int] = FeatureConfig().rolling_std_windows,
                     min_periods: int = 1, target: str = "sales", keys=SERIES) -> DataFrame:
    """D13/D14 (+C3): mean / sample std over rows [t-w, t-1] (shift by one
    first, so today's target never leaks), NULL -> 0."""
    w = series_window(keys)
    y = F.col(target).cast("double")
    kind = dict(df.dtypes).get(target)
    if kind in ("int", "smallint", "tinyint"):
        return _integer_rolling(df, F.col(target), w, mean_windows, std_windows, min_periods)
    cols = []

    def _guard(expr: Column, frame) -> Column:
        if min_periods <= 1:
            return expr
        return F.when(F.count(y).over(frame) >= min_periods, expr)

    for n in mean_windows:
        fr = w.rowsBetween(-n, -1)
        cols.append(F.coalesce(_guard(F.avg(y).over(fr), fr), F.lit(0.0)).alias(f"rolling_mean_{n}"))
    for n in std_windows:
        fr = w.rowsBetween(-n, -1)
        std = exact_std(F.col(target), fr) if kind == "bigint" else F.stddev_samp(y).over(fr)
        cols.append(F.coalesce(_guard(std, fr), F.lit(0.0)).alias(f"rolling_std_{n}"))
    return df.select("*", *cols)


def _integer_rolling(df: DataFrame, x: Column, w, mean_windows: Sequence[int], std_windows: Sequence[int], min_periods: int) -> DataFrame:
    """The rolling columns of an integer target from running sums.

    A window's sum is the running sum up to yesterday less the one up to the
    day before the window: a few additions a row, where a sliding frame adds
    up all its rows again for every row. Integers, so the differences are
    exact: a square's upper and lower 31 bits are summed apart and fit longs.
    """
    xl = x.cast("long")
    square = xl * xl
    parts = {"n": F.count(x), "s": F.sum(xl)}
    squares = {"hi": F.sum(F.shiftright(square, 31)), "lo": F.sum(square.bitwiseAND(F.lit((1 << 31) - 1)))}
    ends = [1, *sorted({n + 1 for n in (*mean_windows, *std_windows)})]
    needed = [(p, d, agg) for d in ends for p, agg in (parts | squares).items() if p in parts or d == 1 or d - 1 in std_windows]
    # each running sum is a column of its own: a window expression that is used twice is evaluated twice
    sums = df.select("*", *[F.coalesce(agg.over(w.rowsBetween(Window.unboundedPreceding, -d)), F.lit(0)).alias(f"_{p}_{d}") for p, d, agg in needed])
    spans = {(p, d - 1): (F.col(f"_{p}_1") - F.col(f"_{p}_{d}")).alias(f"_{p}_of_{d - 1}") for p, d, _ in needed if d > 1}
    rows = sums.select(*[F.col(f"`{c}`") for c in df.columns], *spans.values())

    def within(part: str, n: int) -> Column:
        return F.col(f"_{part}_of_{n}")

    def _guard(expr: Column, n: int) -> Column:
        return F.coalesce(F.when(within("n", n) >= max(min_periods, 1), expr), F.lit(0.0))

    cols = [_guard(within("s", n).cast("double") / within("n", n), n).alias(f"rolling_mean_{n}") for n in mean_windows]
    for n in std_windows:
        k, s, hi, lo = (within(p, n) for p in ("n", "s", "hi", "lo"))
        # numerator n * sum(x^2) - sum(x)^2: in longs where it fits, else in decimals
        total = (hi.cast("decimal(19,0)") * F.lit(1 << 31).cast("decimal(10,0)") + lo.cast("decimal(19,0)")).cast("decimal(38,0)")
        num = (k * total - s.cast("decimal(19,0)") * s.cast("decimal(19,0)")).cast("double")
        if n < 1 << 11:
            num = F.when(hi < (1 << 20), (k * (hi * F.lit(1 << 31) + lo) - s * s).cast("double")).otherwise(num)
        cols.append(_guard(F.when(k >= 2, F.sqrt(num / (k * (k - 1)).cast("double"))), n).alias(f"rolling_std_{n}"))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *cols)


def exact_std(x: Column, frame) -> Column:
    """Sample std of an integer column over a window frame from exact
    integer moments: var = (n*sum(x^2) - sum(x)^2) / (n(n-1)).  The
    numerator is an exact integer, so the result is the correctly rounded
    value (no streaming-update drift; identical across engines).  NULL for
    fewer than two rows, like ``stddev_samp``."""
    xl = x.cast("long")
    xd = xl.cast("decimal(19,0)")   # squares and their sums go beyond a long
    n = F.count(xl).over(frame)
    s1 = F.sum(xl).over(frame).cast("decimal(19,0)")
    s2 = F.sum(xd * xd).over(frame)
    num = (n * s2 - s1 * s1).cast("double")
    return F.when(n >= 2, F.sqrt(num / (n * (n - 1)).cast("double")))


# ----------------------------------------------------------------- D15
def split_label(df: DataFrame, train_end: int = PanelConfig().train_end,
                val_end: int = PanelConfig().val_end, day: str = "day_index") -> DataFrame:
    """Train (<= train_end) / val (<= val_end) / test."""
    d = F.col(day)
    return df.withColumn("split", F.when(d <= train_end, "train").when(d <= val_end, "val").otherwise("test"))


# ----------------------------------------------------------------- D16
# Feature catalogue: name -> (group, Spark type, description).
IDENTITY = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "date", "wm_yr_wk")
DATE = ("year", "month", "week", "day_of_month", "day_of_week", "is_weekend", "quarter",
        "day_index", "wday", "weekday")
PRICE = ("sell_price", "price_diff", "price_pct_change", "price_rel_to_mean", "has_price")
EVENT = ("event_name_1", "event_type_1", "event_name_2", "event_type_2", "has_event_1",
         "has_event_2", "has_any_event", "is_sporting", "is_cultural", "is_national", "is_religious")


def feature_catalogue(states: Sequence[str], fcfg: FeatureConfig = FeatureConfig()) -> dict:
    """Ordered catalogue {column: (group, dtype, description)}."""
    cat = {}
    for c in IDENTITY:
        cat[c] = ("identity", {"date": "date", "wm_yr_wk": "int"}.get(c, "string"), "series / day identifier")
    cat["sales"] = ("target", "int", "units sold that day")
    for c in DATE:
        cat[c] = ("date", "string" if c == "weekday" else "int", "calendar part of the date")
    cat["is_zero_sales"] = ("zero_inflation", "int", "1 when no unit was sold")
    for c in PRICE:
        cat[c] = ("price", "int" if c == "has_price" else "double", "weekly price and its changes")
    for c in EVENT:
        cat[c] = ("event", "string" if c.startswith("event_") else "int", "calendar events")
    for s in states:
        cat[f"snap_{s}"] = ("snap", "int", f"SNAP day in {s}")
    cat["snap_active"] = ("snap", "int", "SNAP day in the row's own state")
    for n in fcfg.lags:
        cat[f"lag_{n}"] = ("lag", "double", f"sales {n} days earlier")
    for n in fcfg.rolling_mean_windows:
        cat[f"rolling_mean_{n}"] = ("rolling", "double", f"mean sales over the previous {n} days")
    for n in fcfg.rolling_std_windows:
        cat[f"rolling_std_{n}"] = ("rolling", "double", f"sample std of sales over the previous {n} days")
    cat["split"] = ("meta", "string", "temporal split train / val / test")
    return cat


def catalogue_frame(spark, states: Sequence[str], fcfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """D16 as a DataFrame (name, group, dtype, description, position)."""
    rows = [(i, k, g, t, d) for i, (k, (g, t, d)) in enumerate(feature_catalogue(states, fcfg).items())]
    return spark.createDataFrame(rows, "position int, name string, group string, dtype string, description string")


def feature_columns(states: Sequence[str], exclude_groups=("identity", "meta", "target"),
                    keys=("item_id", "store_id", "day_index"), fcfg: FeatureConfig = FeatureConfig(),
                    exclude=("is_zero_sales",)) -> list[str]:
    """A4: model inputs = catalogue minus excluded groups, plus keys.

    ``is_zero_sales`` is today's target in disguise and is excluded from
    model inputs by default (it stays in the table)."""
    cols = [c for c, (g, _, _) in feature_catalogue(states, fcfg).items()
            if g not in set(exclude_groups) and c not in set(exclude)]
    return list(dict.fromkeys([*keys, *cols]))


def with_metadata(df: DataFrame, states: Sequence[str], fcfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Attach catalogue group/description as column metadata."""
    cat = feature_catalogue(states, fcfg)
    return df.select(*[F.col(c).alias(c, metadata={"group": cat[c][0], "description": cat[c][2]})
                       if c in cat else F.col(c) for c in df.columns])


# ----------------------------------------------------------------- D17
def build_features(sales_long: DataFrame, calendar: DataFrame, prices: DataFrame,
                   pcfg: PanelConfig = PanelConfig(), fcfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Panel -> 50-column feature table (one lazy plan).

    B2 calendar join (broadcast) -> B3 price join -> C1 event fill ->
    C2 price fill -> D2-D4 -> D5-D8 -> D9-D11 -> D12 -> D13/D14 -> D15.
    """
    states = [c[len("snap_"):] for c in calendar.columns if c.startswith("snap_")]
    df = P.join_calendar(sales_long, calendar)
    df = P.join_prices(df, prices)
    df = P.fill_events(df)
    df = P.fill_prices(df)
    df = date_features(df)
    df = zero_flag(df)
    df = price_features(df, causal_mean=fcfg.causal_price_mean)
    df = event_features(df, fcfg.event_types)
    df = snap_feature(df)
    df = lag_features(df, fcfg.lags)
    df = rolling_features(df, fcfg.rolling_mean_windows, fcfg.rolling_std_windows, fcfg.rolling_min_periods)
    df = split_label(df, pcfg.train_end, pcfg.val_end)
    order = list(feature_catalogue(states, fcfg))
    return df.select(*order)


FEATURE_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
                 "date": T.DateType()}


def feature_schema(states: Sequence[str], fcfg: FeatureConfig = FeatureConfig()) -> T.StructType:
    """Explicit StructType of the feature table."""
    return T.StructType([T.StructField(c, FEATURE_TYPES[t], True, {"group": g})
                         for c, (g, t, _) in feature_catalogue(states, fcfg).items()])
