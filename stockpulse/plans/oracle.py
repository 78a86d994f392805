"""Independent DuckDB SQL for every SQL-expressible query.

The SQL re-derives everything from the raw test tables (lineitem, part,
supplier, nation, region) with plain ANSI constructs - CTEs, window
frames, CASE, scalar subqueries - so a logic error in the Spark operators
shows up as a mismatch.  Data-dependent quantile levels (conformal) are
computed from explicit order statistics because DuckDB only accepts
constant quantile levels.  Float outputs are rounded to 6 decimals.
"""

from __future__ import annotations

from stockpulse.config import DEFAULT, ZERO_RATE_BOUNDS
from stockpulse.operators.forecast import Z95
from stockpulse.operators.impact import KPI_NAMES, POLICIES
from stockpulse.sources.testdata import FIXTURE_STATES

# the window: the whole span of the shipments' dates, its last 2 x 28 days the validation and test splits
START = "(SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem)"
N_DAYS = "(SELECT CAST(date_diff('day', CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE)) + 1 AS INTEGER) FROM lineitem)"
W = "PARTITION BY item_id, store_id ORDER BY day_index"
ALPHA = DEFAULT.uncertainty.alpha
LEVELS = DEFAULT.uncertainty.confidence_levels


def r6(e: str, name: str) -> str:
    return f"round(CAST({e} AS DOUBLE), 6) AS {name}"


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


SNAPS = ",\n    ".join(f"CASE WHEN day(dt) BETWEEN {1 + k} AND {10 + k} THEN 1 ELSE 0 END AS snap_{s}"
                       for k, s in enumerate(FIXTURE_STATES))
SNAP_COLS = ", ".join(f"c.snap_{s}" for s in FIXTURE_STATES)
SNAP_NAMES = ", ".join(f"snap_{s}" for s in FIXTURE_STATES)
SNAP_ACTIVE = "CASE " + " ".join(f"WHEN state_id = '{s}' THEN snap_{s}" for s in FIXTURE_STATES) + " ELSE 0 END"


BASE = f"""
ship AS (
  SELECT concat_ws('_', p.p_type, CAST(1 + p.p_size % 2 AS VARCHAR),
                   lpad(CAST(1 + p.p_partkey % 2 AS VARCHAR), 3, '0')) AS item_id,
         concat_ws('_', replace(r.r_name, ' ', ''), CAST(1 + s.s_suppkey % 2 AS VARCHAR)) AS store_id,
         CAST(date_diff('day', {START}, CAST(l.l_shipdate AS DATE)) + 1 AS INTEGER) AS day_index,
         l.l_quantity, p.p_retailprice
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
daily AS (
  SELECT item_id, store_id, day_index, CAST(sum(l_quantity) AS INTEGER) AS qty, max(p_retailprice) AS max_price
  FROM ship GROUP BY item_id, store_id, day_index
),
prices AS (
  SELECT store_id, item_id, CAST(1 + floor((day_index - 1) / 7.0) AS INTEGER) AS wm_yr_wk, max(max_price) AS sell_price
  FROM daily GROUP BY 1, 2, 3
),
series AS (SELECT DISTINCT item_id, store_id FROM daily),
days AS (SELECT CAST(unnest(range(1, {N_DAYS} + 1)) AS INTEGER) AS day_index),
cal AS (
  SELECT day_index, 'd_' || CAST(day_index AS VARCHAR) AS d, dt AS date,
    CAST(1 + floor((day_index - 1) / 7.0) AS INTEGER) AS wm_yr_wk,
    dayname(dt) AS weekday, CAST((dayofweek(dt) + 1) % 7 + 1 AS INTEGER) AS wday,
    CAST(month(dt) AS INTEGER) AS month, CAST(year(dt) AS INTEGER) AS year,
    CASE WHEN month(dt) = 12 AND day(dt) = 25 THEN 'Christmas' WHEN month(dt) = 1 AND day(dt) = 1 THEN 'NewYear'
         WHEN month(dt) = 7 AND day(dt) = 4 THEN 'Independence' WHEN month(dt) = 2 AND day(dt) = 14 THEN 'Valentines'
         WHEN month(dt) = 2 AND day(dt) <= 7 AND dayofweek(dt) = 0 THEN 'Final' END AS event_name_1,
    CASE WHEN month(dt) = 12 AND day(dt) = 25 THEN 'Religious' WHEN month(dt) = 1 AND day(dt) = 1 THEN 'National'
         WHEN month(dt) = 7 AND day(dt) = 4 THEN 'National' WHEN month(dt) = 2 AND day(dt) = 14 THEN 'Cultural'
         WHEN month(dt) = 2 AND day(dt) <= 7 AND dayofweek(dt) = 0 THEN 'Sporting' END AS event_type_1,
    CASE WHEN month(dt) = 1 AND day(dt) = 1 THEN 'Parade' END AS event_name_2,
    CASE WHEN month(dt) = 1 AND day(dt) = 1 THEN 'Cultural' END AS event_type_2,
    {SNAPS}
  FROM (SELECT day_index, CAST({START} + (day_index - 1) AS DATE) AS dt FROM days) x
),
sales_long AS (
  SELECT concat_ws('_', s.item_id, s.store_id) AS id, s.item_id,
         regexp_extract(s.item_id, '^[^_]*_[^_]*', 0) AS dept_id, split_part(s.item_id, '_', 1) AS cat_id,
         s.store_id, split_part(s.store_id, '_', 1) AS state_id,
         'd_' || CAST(dd.day_index AS VARCHAR) AS d, dd.day_index, CAST(coalesce(dl.qty, 0) AS INTEGER) AS sales
  FROM series s CROSS JOIN days dd
  LEFT JOIN daily dl ON dl.item_id = s.item_id AND dl.store_id = s.store_id AND dl.day_index = dd.day_index
),
panel AS (
  SELECT sl.*, c.date, c.wm_yr_wk, c.weekday, c.wday, c.month, c.year,
         coalesce(c.event_name_1, 'no_event') AS event_name_1, coalesce(c.event_type_1, 'no_event') AS event_type_1,
         coalesce(c.event_name_2, 'no_event') AS event_name_2, coalesce(c.event_type_2, 'no_event') AS event_type_2,
         {SNAP_COLS}, pr.sell_price AS raw_price
  FROM sales_long sl JOIN cal c ON sl.day_index = c.day_index
  LEFT JOIN prices pr ON pr.store_id = sl.store_id AND pr.item_id = sl.item_id AND pr.wm_yr_wk = c.wm_yr_wk
),
f1 AS (
  SELECT *, coalesce(last_value(raw_price IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     first_value(raw_price IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
                     0.0) AS sell_price
  FROM panel
),
feat AS (
  SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, date, wm_yr_wk, sales,
    year, month, CAST(weekofyear(date) AS INTEGER) AS week, CAST(day(date) AS INTEGER) AS day_of_month,
    CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
    CAST(CASE WHEN isodow(date) - 1 >= 5 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    CAST(quarter(date) AS INTEGER) AS quarter, day_index, wday, weekday,
    CAST(CASE WHEN sales = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_zero_sales,
    sell_price,
    coalesce(sell_price - lag(sell_price) OVER ({W}), 0.0) AS price_diff,
    coalesce((sell_price - lag(sell_price) OVER ({W})) / (lag(sell_price) OVER ({W}) + 1e-6) * 100.0, 0.0) AS price_pct_change,
    sell_price / (avg(sell_price) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) + 1e-6) AS price_rel_to_mean,
    CAST(CASE WHEN sell_price > 0 THEN 1 ELSE 0 END AS INTEGER) AS has_price,
    event_name_1, event_type_1, event_name_2, event_type_2,
    CAST(CASE WHEN event_name_1 <> 'no_event' THEN 1 ELSE 0 END AS INTEGER) AS has_event_1,
    CAST(CASE WHEN event_name_2 <> 'no_event' THEN 1 ELSE 0 END AS INTEGER) AS has_event_2,
    CAST(CASE WHEN event_name_1 <> 'no_event' OR event_name_2 <> 'no_event' THEN 1 ELSE 0 END AS INTEGER) AS has_any_event,
    CAST(CASE WHEN event_type_1 = 'Sporting' OR event_type_2 = 'Sporting' THEN 1 ELSE 0 END AS INTEGER) AS is_sporting,
    CAST(CASE WHEN event_type_1 = 'Cultural' OR event_type_2 = 'Cultural' THEN 1 ELSE 0 END AS INTEGER) AS is_cultural,
    CAST(CASE WHEN event_type_1 = 'National' OR event_type_2 = 'National' THEN 1 ELSE 0 END AS INTEGER) AS is_national,
    CAST(CASE WHEN event_type_1 = 'Religious' OR event_type_2 = 'Religious' THEN 1 ELSE 0 END AS INTEGER) AS is_religious,
    {SNAP_NAMES},
    CAST({SNAP_ACTIVE} AS INTEGER) AS snap_active,
    coalesce(CAST(lag(sales, 7) OVER ({W}) AS DOUBLE), 0.0) AS lag_7,
    coalesce(CAST(lag(sales, 14) OVER ({W}) AS DOUBLE), 0.0) AS lag_14,
    coalesce(CAST(lag(sales, 28) OVER ({W}) AS DOUBLE), 0.0) AS lag_28,
    coalesce(avg(CAST(sales AS DOUBLE)) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_mean_7,
    coalesce(avg(CAST(sales AS DOUBLE)) OVER ({W} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_mean_14,
    coalesce(avg(CAST(sales AS DOUBLE)) OVER ({W} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_mean_28,
    coalesce(CASE WHEN count(sales) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) >= 2 THEN sqrt(CAST(count(sales) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) * sum(CAST(sales AS BIGINT) * sales) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) - sum(CAST(sales AS BIGINT)) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) * sum(CAST(sales AS BIGINT)) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) / CAST(count(sales) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) * (count(sales) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) - 1) AS DOUBLE)) END, 0.0) AS rolling_std_7,
    coalesce(CASE WHEN count(sales) OVER ({W} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) >= 2 THEN sqrt(CAST(count(sales) OVER ({W} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) * sum(CAST(sales AS BIGINT) * sales) OVER ({W} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) - sum(CAST(sales AS BIGINT)) OVER ({W} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) * sum(CAST(sales AS BIGINT)) OVER ({W} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS DOUBLE) / CAST(count(sales) OVER ({W} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) * (count(sales) OVER ({W} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) - 1) AS DOUBLE)) END, 0.0) AS rolling_std_28,
    CASE WHEN day_index <= {N_DAYS} - 56 THEN 'train' WHEN day_index <= {N_DAYS} - 28 THEN 'val' ELSE 'test' END AS split
  FROM f1
),
preds AS (
  SELECT item_id, store_id, day_index, split, sales AS actual, greatest(rolling_mean_28, 0.0) AS point,
         rolling_mean_7, rolling_mean_28, rolling_std_28, has_any_event, sell_price
  FROM feat WHERE split IN ('val', 'test')
),
testp AS (SELECT * FROM preds WHERE split = 'test'),
calsc AS (SELECT abs(CAST(actual AS DOUBLE) - point) AS s, CAST(actual AS DOUBLE) - point AS ss FROM preds WHERE split = 'val'),
ncal AS (SELECT count(*) AS n FROM calsc),
lv AS (
  SELECT n, least(ceil((n + 1) * (1.0 - {d(ALPHA)})) / n, 1.0) AS l_sym,
         least(ceil((n + 1) * ({d(ALPHA)} / 2)) / n, 1.0) AS l_lo,
         least(ceil((n + 1) * (1.0 - {d(ALPHA)} / 2)) / n, 1.0) AS l_hi
  FROM ncal
),
rabs AS (SELECT s AS v, row_number() OVER (ORDER BY s) - 1 AS r FROM calsc),
rsig AS (SELECT ss AS v, row_number() OVER (ORDER BY ss) - 1 AS r FROM calsc)
"""


def qlin(ranked: str, level: str) -> str:
    """Linear-interpolated quantile (Spark's formula) of a ranked CTE at a
    level expression over ``lv``."""
    return f"""(SELECT CASE WHEN floor(pos) = ceil(pos) THEN lo_v
                 ELSE (ceil(pos) - pos) * lo_v + (pos - floor(pos)) * hi_v END
    FROM (SELECT pos, max(CASE WHEN r = floor(pos) THEN v END) AS lo_v, max(CASE WHEN r = ceil(pos) THEN v END) AS hi_v
          FROM {ranked}, (SELECT (n - 1) * ({level}) AS pos FROM lv) pp GROUP BY pos) z)"""


def qhigher(alpha: float) -> str:
    """Stage-5 'higher' threshold at alpha: order statistic
    min(ceil((n-1) L), n-1) with L the corrected level."""
    lvl = f"least(ceil((n + 1) * (1.0 - {d(alpha)})) / n, 1.0)"
    return f"""(SELECT max(v) FROM rabs, (SELECT least(ceil((n - 1) * {lvl}), n - 1) AS rr FROM lv) pp WHERE r = rr)"""


THR = f"""
thr AS (
  SELECT n AS n_calibration, {qlin('rabs', 'l_sym')} AS q_sym, {qlin('rsig', 'l_lo')} AS q_lo,
         {qlin('rsig', 'l_hi')} AS q_hi
  FROM lv
),
conf AS (
  SELECT t.*, greatest(point - q_sym, 0.0) AS lower_sym, point + q_sym AS upper_sym,
         point + q_sym - greatest(point - q_sym, 0.0) AS width_sym,
         greatest(point + q_lo, 0.0) AS lower_asym, greatest(point + q_hi, 0.0) AS upper_asym,
         greatest(point + q_hi, 0.0) - greatest(point + q_lo, 0.0) AS width_asym
  FROM testp t, thr
),
qraw AS (
  SELECT *, greatest(rolling_mean_28 - {d(Z95)} * rolling_std_28, 0.0) AS a, greatest(rolling_mean_7, 0.0) AS b,
         greatest(rolling_mean_28 + {d(Z95)} * rolling_std_28, 0.0) AS c
  FROM testp
),
qpav AS (
  SELECT *, least(a, (a + b) / 2.0, (a + b + c) / 3.0) AS q05,
         greatest(least((a + b) / 2.0, (a + b + c) / 3.0), least(b, (b + c) / 2.0)) AS q50,
         greatest(c, (b + c) / 2.0, (a + b + c) / 3.0) AS q95
  FROM qraw
),
qint AS (
  SELECT *, greatest(q05, 0.0) AS lower, q50 AS median, greatest(q95, 0.0) AS upper,
         greatest(q95, 0.0) - greatest(q05, 0.0) AS width
  FROM qpav
),
ilong AS (
  SELECT 'Quantile' AS method, item_id, store_id, day_index, actual, lower, upper FROM qint
  UNION ALL SELECT 'Conformal_Symmetric', item_id, store_id, day_index, actual, lower_sym, upper_sym FROM conf
  UNION ALL SELECT 'Conformal_Asymmetric', item_id, store_id, day_index, actual, lower_asym, upper_asym FROM conf
),
lvl_thr AS (
  {" UNION ALL ".join(f"SELECT {d(lv)} AS level, {d(round(1 - lv, 10))} AS alpha, {qhigher(round(1 - lv, 10))} AS q_hat" for lv in LEVELS)}
),
lvl_int AS (
  SELECT t.*, l.level, l.alpha, greatest(t.point - l.q_hat, 0.0) AS lower, greatest(t.point + l.q_hat, 0.0) AS upper
  FROM testp t, lvl_thr l
),
long90 AS (
  SELECT 'Conformal' AS Method, item_id, store_id, day_index, actual, lower, upper, rolling_std_28
  FROM lvl_int WHERE level = {d(0.9)}
  UNION ALL
  SELECT 'Quantile', item_id, store_id, day_index, actual, lower, upper, rolling_std_28 FROM qint
),
seg AS (
  SELECT Method, Segment_Type, Segment_Name, count(*) AS Count,
         avg(CASE WHEN actual >= lower AND actual <= upper THEN 1.0 ELSE 0.0 END) AS Coverage,
         avg(upper - lower) AS Avg_Width
  FROM (
    SELECT Method, 'store_id' AS Segment_Type, store_id AS Segment_Name, actual, lower, upper FROM long90
    UNION ALL SELECT Method, 'state_id', split_part(store_id, '_', 1), actual, lower, upper FROM long90
    UNION ALL SELECT Method, 'cat_id', split_part(item_id, '_', 1), actual, lower, upper FROM long90
    UNION ALL SELECT Method, 'dept_id', regexp_extract(item_id, '^[^_]*_[^_]*', 0), actual, lower, upper FROM long90
  ) x GROUP BY 1, 2, 3
),
segs AS (SELECT *, abs(Coverage - 0.9) AS Coverage_Error FROM seg),
rk0 AS (
  SELECT c.*, split_part(c.item_id, '_', 1) AS cat_id,
         abs(CAST(c.actual AS DOUBLE) - c.point) AS raw_error, c.width_sym AS raw_width,
         c.rolling_std_28 AS raw_volatility, coalesce(s.Coverage_Error, 0.0) AS raw_calib_penalty
  FROM conf c LEFT JOIN (SELECT Segment_Name, Coverage_Error FROM segs WHERE Segment_Type = 'cat_id' AND Method = 'Conformal') s
    ON split_part(c.item_id, '_', 1) = s.Segment_Name
),
mm AS (
  SELECT min(raw_width) AS w0, max(raw_width) AS w1, min(raw_error) AS e0, max(raw_error) AS e1,
         min(raw_volatility) AS v0, max(raw_volatility) AS v1, min(raw_calib_penalty) AS c0, max(raw_calib_penalty) AS c1
  FROM rk0
),
rk1 AS (
  SELECT rk0.*,
    CASE WHEN abs(w0 - w1) <= 1e-8 + 1e-5 * abs(w1) THEN 0.0 ELSE (raw_width - w0) / (w1 - w0) END AS comp_width,
    CASE WHEN abs(e0 - e1) <= 1e-8 + 1e-5 * abs(e1) THEN 0.0 ELSE (raw_error - e0) / (e1 - e0) END AS comp_error,
    CASE WHEN abs(v0 - v1) <= 1e-8 + 1e-5 * abs(v1) THEN 0.0 ELSE (raw_volatility - v0) / (v1 - v0) END AS comp_volat,
    CASE WHEN abs(c0 - c1) <= 1e-8 + 1e-5 * abs(c1) THEN 0.0 ELSE (raw_calib_penalty - c0) / (c1 - c0) END AS comp_calib
  FROM rk0, mm
),
rk2 AS (
  SELECT *, round_even((0.3 * comp_width + 0.25 * comp_error + 0.25 * comp_volat + 0.2 * comp_calib) * 100.0 * 100.0, 0) / 100.0 AS Risk_Score
  FROM rk1
),
rb AS (SELECT quantile_cont(Risk_Score, 0.6) AS lo, quantile_cont(Risk_Score, 0.85) AS md FROM rk2),
rk3 AS (
  SELECT rk2.*, CASE WHEN Risk_Score <= lo THEN 'Low' WHEN Risk_Score <= md THEN 'Medium' ELSE 'High' END AS Risk_Level
  FROM rk2, rb
),
rk4 AS (
  SELECT *,
    CASE WHEN Risk_Level = 'Low' THEN 'Demand is stable and predictable.'
         WHEN comp_volat = greatest(comp_volat, comp_error, comp_calib, comp_width) THEN 'High uncertainty driven by volatile historical demand.'
         WHEN comp_error = greatest(comp_volat, comp_error, comp_calib, comp_width) THEN 'High uncertainty driven by large historical forecast errors.'
         WHEN comp_calib = greatest(comp_volat, comp_error, comp_calib, comp_width) THEN 'High uncertainty driven by poor historical calibration for this segment.'
         ELSE 'High uncertainty driven by exceptionally wide prediction intervals.' END AS Root_Cause,
    CASE Risk_Level WHEN 'Low' THEN 'Standard replenishment. Order predicted quantity.'
         WHEN 'Medium' THEN 'Increase safety stock moderately. Monitor demand closely.'
         ELSE 'Increase safety stock significantly. Increase replenishment frequency.' END AS Recommended_Action,
    CASE Risk_Level WHEN 'Low' THEN 'No intervention required.' WHEN 'Medium' THEN 'Review supplier lead time.'
         ELSE 'Notify planners immediately. Escalate to supply chain manager.' END AS Intervention,
    round_even(greatest(point, point + (upper_sym - point) *
         CASE Risk_Level WHEN 'Low' THEN 0.5 WHEN 'Medium' THEN 0.75 ELSE 0.95 END) * 100.0, 0) / 100.0 AS Recommended_Stock_Level
  FROM rk3
),
risk AS (
  SELECT *, round_even((Recommended_Stock_Level - point) * 100.0, 0) / 100.0 AS Inventory_Increase,
         round_even((100.0 - Risk_Score) * 10.0, 0) / 10.0 AS Confidence_Level
  FROM rk4
),
imp0 AS (
  SELECT *, greatest(round_even(point, 0), 0.0) AS Baseline_Order,
         greatest(round_even(Recommended_Stock_Level, 0), 0.0) AS Proposed_Order
  FROM risk
),
impact AS (
  SELECT *,
    greatest(actual - Baseline_Order, 0.0) AS Baseline_Stockout_Units, greatest(Baseline_Order - actual, 0.0) AS Baseline_Overstock_Units,
    least(CAST(actual AS DOUBLE), Baseline_Order) AS Baseline_Sold_Units,
    greatest(Baseline_Order - actual, 0.0) * (sell_price * 0.05) AS Baseline_Holding_Cost,
    greatest(actual - Baseline_Order, 0.0) * (sell_price * 0.4) AS Baseline_Stockout_Cost,
    greatest(Baseline_Order - actual, 0.0) * (sell_price * 0.05) + greatest(actual - Baseline_Order, 0.0) * (sell_price * 0.4) AS Baseline_Total_Cost,
    greatest(actual - Proposed_Order, 0.0) AS Proposed_Stockout_Units, greatest(Proposed_Order - actual, 0.0) AS Proposed_Overstock_Units,
    least(CAST(actual AS DOUBLE), Proposed_Order) AS Proposed_Sold_Units,
    greatest(Proposed_Order - actual, 0.0) * (sell_price * 0.05) AS Proposed_Holding_Cost,
    greatest(actual - Proposed_Order, 0.0) * (sell_price * 0.4) AS Proposed_Stockout_Cost,
    greatest(Proposed_Order - actual, 0.0) * (sell_price * 0.05) + greatest(actual - Proposed_Order, 0.0) * (sell_price * 0.4) AS Proposed_Total_Cost
  FROM imp0
)
"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts) + "\n"


FULL = with_(BASE, THR)

FEATURE_COLUMNS_NUM = None  # filled lazily by queries needing the whole table


FEATURE_ORDER = (
    "id, item_id, dept_id, cat_id, store_id, state_id, d, date, wm_yr_wk, sales, year, month, week, day_of_month, "
    "day_of_week, is_weekend, quarter, day_index, wday, weekday, is_zero_sales, {r_sell_price}, {r_price_diff}, "
    "{r_price_pct_change}, {r_price_rel_to_mean}, has_price, event_name_1, event_type_1, event_name_2, event_type_2, "
    "has_event_1, has_event_2, has_any_event, is_sporting, is_cultural, is_national, is_religious, "
    + SNAP_NAMES + ", snap_active, {r_lag_7}, {r_lag_14}, {r_lag_28}, {r_rolling_mean_7}, {r_rolling_mean_14}, "
    "{r_rolling_mean_28}, {r_rolling_std_7}, {r_rolling_std_28}, split")


def _feature_select() -> str:
    cols = ["sell_price", "price_diff", "price_pct_change", "price_rel_to_mean", "lag_7", "lag_14", "lag_28",
            "rolling_mean_7", "rolling_mean_14", "rolling_mean_28", "rolling_std_7", "rolling_std_28"]
    return FEATURE_ORDER.format(**{f"r_{c}": r6(c, c) for c in cols})


KEYS = "item_id, store_id, day_index"
F_ = FULL  # alias


def _i(e: str, name: str) -> str:
    return f"CAST({e} AS BIGINT) AS {name}"


COV = "CASE WHEN actual >= lower AND actual <= upper THEN 1.0 ELSE 0.0 END"


def _wink(alpha: str) -> str:
    return (f"((upper - lower) + (2.0 / {alpha}) * greatest(lower - actual, 0.0)"
            f" + (2.0 / {alpha}) * greatest(actual - upper, 0.0))")


ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- B / C / D
ORACLE["melt_wide_sales"] = F_ + f"""
SELECT id, item_id, store_id, d, day_index, sales FROM sales_long"""
ORACLE["melt_unpivot"] = ORACLE["melt_wide_sales"]

ORACLE["panel_join"] = F_ + f"""
SELECT {KEYS}, d, sales, wm_yr_wk, event_name_1, event_type_1, event_name_2, event_type_2,
       {r6('raw_price', 'raw_price')} FROM panel"""

ORACLE["join_audit"] = F_ + """
SELECT (SELECT count(*) FROM sales_long) AS rows_before, count(*) AS rows_after,
       count(*) - (SELECT count(*) FROM sales_long) AS row_change,
       (SELECT count(*) FROM (SELECT store_id, item_id, wm_yr_wk FROM prices GROUP BY ALL HAVING count(*) > 1)) AS duplicate_right_keys,
       count(*) FILTER (WHERE raw_price IS NULL) AS unmatched_rows,
       round(coalesce(count(*) FILTER (WHERE raw_price IS NULL) * 100.0 / count(*), 0.0), 6) AS unmatched_pct
FROM panel"""


def _kc(key_sales: str, key_prices: str, name: str) -> str:
    return f"""SELECT '{name}' AS key,
  (SELECT count(DISTINCT {key_sales}) FROM sales_long) AS n_left,
  (SELECT count(DISTINCT {key_prices}) FROM prices) AS n_right,
  (SELECT count(*) FROM (SELECT DISTINCT {key_sales} AS k FROM sales_long INTERSECT SELECT DISTINCT {key_prices} FROM prices)) AS n_common"""


ORACLE["key_coverage"] = F_ + " UNION ALL ".join([
    _kc("item_id || '|' || store_id", "item_id || '|' || store_id", "series"),
    _kc("CAST(1 + floor((day_index - 1) / 7.0) AS INTEGER)", "wm_yr_wk", "wm_yr_wk"),
    _kc("store_id", "store_id", "store_id"), _kc("item_id", "item_id", "item_id")])

ORACLE["price_fill"] = F_ + f"SELECT {KEYS}, {r6('sell_price', 'sell_price')} FROM feat"
ORACLE["date_features"] = F_ + f"""
SELECT {KEYS}, year, month, week, day_of_month, day_of_week, is_weekend, quarter, wday, weekday FROM feat"""
ORACLE["event_snap_features"] = F_ + f"""
SELECT {KEYS}, has_event_1, has_event_2, has_any_event, is_sporting, is_cultural, is_national, is_religious,
       snap_active FROM feat"""
ORACLE["price_features"] = F_ + f"""
SELECT {KEYS}, {r6('price_diff', 'price_diff')}, {r6('price_pct_change', 'price_pct_change')},
       {r6('price_rel_to_mean', 'price_rel_to_mean')}, has_price FROM feat"""
ORACLE["lag_features"] = F_ + f"SELECT {KEYS}, {r6('lag_7', 'lag_7')}, {r6('lag_14', 'lag_14')}, {r6('lag_28', 'lag_28')} FROM feat"
ORACLE["rolling_features"] = F_ + f"""
SELECT {KEYS}, {r6('rolling_mean_7', 'rolling_mean_7')}, {r6('rolling_mean_14', 'rolling_mean_14')},
       {r6('rolling_mean_28', 'rolling_mean_28')}, {r6('rolling_std_7', 'rolling_std_7')},
       {r6('rolling_std_28', 'rolling_std_28')} FROM feat"""
ORACLE["zero_split_labels"] = F_ + f"SELECT {KEYS}, sales, is_zero_sales, split FROM feat"
ORACLE["feature_table"] = F_ + f"SELECT {_feature_select()} FROM feat"

# ---------------------------------------------------------------- E
_RAW_COLS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "day_index", "sales",
             "date", "wm_yr_wk", "weekday", "wday", "month", "year", "event_name_1", "event_type_1",
             "event_name_2", "event_type_2", *[f"snap_{s}" for s in FIXTURE_STATES], "sell_price"]
ORACLE["missing_report"] = F_ + """, raw AS (
  SELECT sl.*, c.date, c.wm_yr_wk, c.weekday, c.wday, c.month, c.year, c.event_name_1, c.event_type_1,
         c.event_name_2, c.event_type_2, """ + SNAP_COLS + """, pr.sell_price
  FROM sales_long sl JOIN cal c ON sl.day_index = c.day_index
  LEFT JOIN prices pr ON pr.store_id = sl.store_id AND pr.item_id = sl.item_id AND pr.wm_yr_wk = c.wm_yr_wk)
SELECT "column", missing, round(coalesce(missing * 100.0 / n, 0.0), 6) AS missing_pct, n * """ + str(len(_RAW_COLS)) + """ AS total_cells
FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing, count(*) AS n FROM raw"
    for c in _RAW_COLS) + ")"

ORACLE["duplicate_rows"] = F_ + """
SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales_long)) AS duplicate_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT item_id, store_id, d FROM sales_long)) AS duplicate_keys
FROM sales_long"""

ORACLE["distinct_counts"] = F_ + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
       CASE WHEN count(DISTINCT {c}) <= 15 THEN list_sort(list(DISTINCT {c})) END AS "values" FROM sales_long"""
    for c in ["item_id", "dept_id", "cat_id", "store_id", "state_id"])

ORACLE["describe_sales"] = F_ + """
SELECT count(*) AS cells, CAST(min(sales) AS DOUBLE) AS min, CAST(max(sales) AS DOUBLE) AS max,
       round(avg(sales), 6) AS mean, round(CAST(median(CAST(sales AS DOUBLE)) AS DOUBLE), 6) AS median,
       round(stddev_pop(sales), 6) AS std_pop, count(*) FILTER (WHERE sales = 0) AS zero_cells,
       round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS zero_pct
FROM sales_long"""

ORACLE["series_mean_distribution"] = F_ + """, m AS (SELECT item_id, store_id, avg(CAST(sales AS DOUBLE)) AS m FROM sales_long GROUP BY 1, 2)
SELECT count(*) AS series, round(min(m), 6) AS min, round(quantile_cont(m, 0.25), 6) AS p25,
       round(quantile_cont(m, 0.5), 6) AS p50, round(quantile_cont(m, 0.75), 6) AS p75, round(max(m), 6) AS max FROM m"""

ORACLE["hierarchy_counts"] = F_ + """
SELECT 'cat_dept' AS level, cat_id AS parent, dept_id AS child, count(DISTINCT item_id) AS count FROM sales_long GROUP BY 2, 3
UNION ALL
SELECT 'state_store', state_id, store_id, count(DISTINCT (item_id, store_id)) FROM sales_long GROUP BY 2, 3"""

_DAY_ROWS = """, day_rows AS (SELECT CAST(""" + START + """ + (day_index - 1) AS DATE) AS date, qty AS units FROM daily)"""
ORACLE["calendar_continuity"] = F_ + _DAY_ROWS + """
SELECT (SELECT min(date) FROM cal) AS first_date, (SELECT max(date) FROM cal) AS last_date, (SELECT count(*) FROM cal) AS rows,
       CAST((SELECT date_diff('day', min(date), max(date)) + 1 FROM cal) AS INTEGER) AS expected_days,
       (SELECT count(DISTINCT date) = date_diff('day', min(date), max(date)) + 1 FROM cal) AS continuous,
       (SELECT date_diff('day', min(date), max(date)) + 1 - count(DISTINCT date) FROM cal) AS missing_dates,
       (SELECT count(*) FROM (SELECT date FROM cal GROUP BY date HAVING count(*) > 1)) AS repeated_dates,
       count(DISTINCT date) AS sales_days, count(DISTINCT date) FILTER (WHERE date IN (SELECT date FROM cal)) AS sales_days_in_calendar,
       date_diff('day', min(date), max(date)) + 1 - count(DISTINCT date) AS sales_gaps
FROM day_rows"""

ORACLE["price_coverage"] = F_ + """
SELECT count(*) AS rows, count(DISTINCT item_id) AS items, count(DISTINCT store_id) AS stores,
       count(DISTINCT wm_yr_wk) AS weeks, round(min(sell_price), 6) AS min_price, round(max(sell_price), 6) AS max_price,
       round(count(*) * 1.0 / (count(DISTINCT item_id) * count(DISTINCT store_id) * count(DISTINCT wm_yr_wk)), 6) AS coverage
FROM prices"""

ORACLE["event_frequency"] = F_ + _DAY_ROWS + """, per_day AS (SELECT date, count(*) AS n, sum(units) AS u FROM day_rows GROUP BY date),
kinds AS (SELECT 'event_type' AS kind, event_type_1 AS name, date FROM cal UNION ALL SELECT 'event_type', event_type_2, date FROM cal
          """ + " ".join(f"UNION ALL SELECT 'snap_days', 'snap_{s}', date FROM cal WHERE snap_{s} = 1" for s in FIXTURE_STATES) + """)
SELECT kind, name, count(*) AS count, count(n) AS days_with_rows, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, CAST(coalesce(sum(u), 0) AS BIGINT) AS units
FROM kinds LEFT JOIN per_day USING (date) WHERE name IS NOT NULL GROUP BY kind, name"""

_ASKED = " UNION ALL ".join(
    f"""SELECT {n} AS lag, f.lag_{n} AS got, CAST(o.sales AS DOUBLE) AS want, o.item_id IS NOT NULL AS there
FROM feat f LEFT JOIN feat o ON o.item_id = f.item_id AND o.store_id = f.store_id AND o.day_index = f.day_index - {n}"""
    for n in DEFAULT.features.lags)
ORACLE["lag_leaks"] = F_ + f""", asked AS ({_ASKED})
SELECT lag, count(*) AS rows, count(*) FILTER (WHERE there) AS matched, count(*) FILTER (WHERE there AND got IS DISTINCT FROM want) AS mismatched,
       count(*) FILTER (WHERE NOT there) AS lead_in, count(*) FILTER (WHERE NOT there AND got IS DISTINCT FROM 0.0) AS lead_in_set
FROM asked GROUP BY lag"""

ORACLE["validation_checks"] = F_ + f""", asked AS ({_ASKED}),
gaps AS (SELECT day_index - lag(day_index) OVER ({W}) AS gap FROM feat),
a AS (SELECT count(*) AS n, (SELECT count(*) FROM series) * {N_DAYS} AS expected,
        count(*) FILTER (WHERE item_id IS NULL OR store_id IS NULL OR day_index IS NULL OR sales IS NULL OR split IS NULL) AS nulls,
        count(*) FILTER (WHERE sales < 0) AS negative, count(DISTINCT split) AS splits, avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) AS zero_rate,
        (SELECT count(*) FROM gaps WHERE gap <> 1) AS disorder,
        (SELECT count(*) FROM asked WHERE got IS DISTINCT FROM coalesce(want, 0.0)) AS leaks
      FROM feat)
SELECT 'row_count' AS "check", abs(n - expected) <= expected * 0.01 AS passed, CAST(n AS DOUBLE) AS measured FROM a
UNION ALL SELECT 'no_nulls_critical', nulls = 0, CAST(nulls AS DOUBLE) FROM a
UNION ALL SELECT 'no_negative_sales', negative = 0, CAST(negative AS DOUBLE) FROM a
UNION ALL SELECT 'all_splits_present', splits = 3, CAST(splits AS DOUBLE) FROM a
UNION ALL SELECT 'catalogue_columns', true, 0.0 -- a schema fact: feat has every column of the catalogue
UNION ALL SELECT 'zero_rate_in_bounds', zero_rate BETWEEN {ZERO_RATE_BOUNDS[0]} AND {ZERO_RATE_BOUNDS[1]}, round(CAST(zero_rate AS DOUBLE), 6) FROM a
UNION ALL SELECT 'temporal_order', disorder = 0, CAST(disorder AS DOUBLE) FROM a
UNION ALL SELECT 'no_lag_leakage', leaks = 0, CAST(leaks AS DOUBLE) FROM a"""

CODED = ("item_id", "store_id", "dept_id", "weekday", "event_name_1", "event_type_1", "event_name_2", "event_type_2")
_DICTS = ", ".join(f"d_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS code, count(*) AS n FROM feat WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c})"
                   for c in CODED)
ORACLE["category_dictionary"] = F_ + f", {_DICTS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", v AS value, code, n AS rows FROM d_{c}" for c in CODED)
ORACLE["encoded_features"] = F_ + f", {_DICTS} SELECT {KEYS}, " + ", ".join(
    f"CAST(coalesce(d_{c}.code, (SELECT count(*) FROM d_{c})) AS INTEGER) AS {c}_code" for c in CODED) + " FROM feat " + " ".join(
    f"LEFT JOIN d_{c} ON feat.{c} = d_{c}.v" for c in CODED)
ORACLE["file_features"] = ORACLE["feature_table"]

ORACLE["dataset_summary"] = F_ + """
SELECT count(*) AS rows, 52 AS columns, count(*) FILTER (WHERE split = 'train') AS train_rows,
       count(*) FILTER (WHERE split = 'val') AS val_rows, count(*) FILTER (WHERE split = 'test') AS test_rows,
       round(avg(sales), 6) AS sales_mean, round(stddev_pop(sales), 6) AS sales_std, CAST(max(sales) AS DOUBLE) AS sales_max,
       round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS zero_pct
FROM feat"""

ORACLE["zero_rate_grouping_sets"] = F_ + """
SELECT 'overall' AS level, 'ALL' AS value, count(*) AS rows, round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_rate FROM feat
UNION ALL SELECT 'cat_id', cat_id, count(*), round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 6) FROM feat GROUP BY cat_id
UNION ALL SELECT 'store_id', store_id, count(*), round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 6) FROM feat GROUP BY store_id
UNION ALL SELECT 'split', split, count(*), round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 6) FROM feat GROUP BY split"""

ORACLE["split_index"] = F_ + """
SELECT split, min(day_index) AS min_day, max(day_index) AS max_day, count(DISTINCT day_index) AS n_days,
       count(*) AS rows, min(date) AS start_date, max(date) AS end_date FROM feat GROUP BY split"""

ORACLE["split_index_report"] = F_ + """
SELECT split, CAST(min(day_index) AS BIGINT) AS day_index_min, CAST(max(day_index) AS BIGINT) AS day_index_max, count(DISTINCT day_index) AS n_days,
       count(*) AS n_rows, strftime(min(date), '%Y-%m-%d') AS date_start, strftime(max(date), '%Y-%m-%d') AS date_end FROM feat GROUP BY split"""

_CHECKS = ORACLE["validation_checks"]
ORACLE["validation_summary"] = F_ + f"""
SELECT count(*) AS rows, CAST(52 AS BIGINT) AS columns,
       (SELECT count(*) FILTER (WHERE passed) FROM ({_CHECKS}) c) AS n_checks_passed, (SELECT count(*) FROM ({_CHECKS}) c) AS n_checks_total,
       (SELECT bool_and(passed) FROM ({_CHECKS}) c) AS all_passed,
       count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'val') AS val_rows, count(*) FILTER (WHERE split = 'test') AS test_rows,
       round(avg(CAST(sales AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST(sales AS DOUBLE)), 4) AS std, CAST(max(sales) AS BIGINT) AS max,
       round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) * 100, 1) AS zero_pct
FROM feat"""

# ---------------------------------------------------------------- F / G
_ERR = "(CAST(actual AS DOUBLE) - greatest(point, 0.0))"
_SCALE_SERIES = f"""scale AS (
  SELECT item_id, store_id, avg(dv) AS scale FROM (
    SELECT item_id, store_id, pow(CAST(sales AS DOUBLE) - lag(CAST(sales AS DOUBLE)) OVER ({W}), 2) AS dv
    FROM feat WHERE split = 'train') x GROUP BY 1, 2)"""
ORACLE["accuracy_by_split"] = F_ + f""", {_SCALE_SERIES},
mse AS (SELECT split, item_id, store_id, avg(pow({_ERR}, 2)) AS mse FROM preds GROUP BY 1, 2, 3),
rm AS (SELECT m.split, avg(sqrt(m.mse / CASE WHEN s.scale IS NULL OR s.scale = 0 THEN 1.0 ELSE s.scale END)) AS rmsse
       FROM mse m LEFT JOIN scale s USING (item_id, store_id) GROUP BY 1),
base AS (
  SELECT split, count(*) AS n, sqrt(avg(pow({_ERR}, 2))) AS rmse, avg(abs({_ERR})) AS mae,
         coalesce(avg(CASE WHEN actual <> 0 THEN abs({_ERR} / actual) END) * 100.0, 0.0) AS mape,
         CASE WHEN sum(CAST(actual AS DOUBLE)) = 0 THEN 0.0 ELSE sum(abs({_ERR})) / sum(CAST(actual AS DOUBLE)) * 100.0 END AS wape
  FROM preds GROUP BY split)
SELECT b.split, b.n, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(mape, 6) AS mape, round(wape, 6) AS wape,
       round(rmsse, 6) AS rmsse FROM base b LEFT JOIN rm USING (split)"""

ORACLE["rmsse_item_level"] = F_ + f""", scale AS (
  SELECT item_id, avg(dv) AS scale FROM (
    SELECT item_id, pow(CAST(sales AS DOUBLE) - lag(CAST(sales AS DOUBLE)) OVER (PARTITION BY item_id ORDER BY store_id, day_index), 2) AS dv
    FROM feat WHERE split = 'train') x GROUP BY 1),
mse AS (SELECT split, item_id, avg(pow({_ERR}, 2)) AS mse FROM preds GROUP BY 1, 2)
SELECT m.split, round(avg(sqrt(m.mse / CASE WHEN s.scale IS NULL OR s.scale = 0 THEN 1.0 ELSE s.scale END)), 6) AS rmsse
FROM mse m LEFT JOIN scale s USING (item_id) GROUP BY 1"""

ORACLE["quantile_non_crossing"] = F_ + """
SELECT count(*) AS n, count(*) FILTER (WHERE a > b OR b > c) AS n_cross_raw,
       count(*) FILTER (WHERE q05 > q50 OR q50 > q95) AS n_cross_corrected,
       round(count(*) FILTER (WHERE a > b OR b > c) * 100.0 / count(*), 6) AS pct_cross_raw,
       round(count(*) FILTER (WHERE q05 > q50 OR q50 > q95) * 100.0 / count(*), 6) AS pct_cross_corrected
FROM qint"""

ORACLE["quantile_intervals"] = F_ + f"""
SELECT {KEYS}, actual, {r6('q05', 'q05')}, {r6('q50', 'q50')}, {r6('q95', 'q95')}, {r6('lower', 'lower')},
       {r6('median', 'median')}, {r6('upper', 'upper')}, {r6('width', 'width')} FROM qint"""

# ---------------------------------------------------------------- H / I
ORACLE["conformal_thresholds"] = F_ + f"""
SELECT n_calibration, {d(ALPHA)} AS alpha, round(1 - {d(ALPHA)}, 6) AS coverage_target,
       round(q_sym, 6) AS q_hat_symmetric, round(q_lo, 6) AS q_hat_lo_asymmetric, round(q_hi, 6) AS q_hat_hi_asymmetric,
       round(1 - {d(ALPHA)}, 6) AS coverage_lower_bound,
       round(least(1.0, 1 - {d(ALPHA)} + 1.0 / (n_calibration + 1)), 6) AS coverage_upper_bound,
       (SELECT round(min(s), 6) FROM calsc) AS score_min, (SELECT round(quantile_cont(s, 0.25), 6) FROM calsc) AS score_p25,
       (SELECT round(quantile_cont(s, 0.5), 6) FROM calsc) AS score_median,
       (SELECT round(quantile_cont(s, 0.75), 6) FROM calsc) AS score_p75,
       (SELECT round(max(s), 6) FROM calsc) AS score_max, (SELECT round(avg(s), 6) FROM calsc) AS score_mean,
       (SELECT round(stddev_pop(s), 6) FROM calsc) AS score_std
FROM thr"""

ORACLE["conformal_intervals"] = F_ + f"""
SELECT {KEYS}, actual, {r6('lower_sym', 'lower_sym')}, {r6('point', 'point')}, {r6('upper_sym', 'upper_sym')},
       {r6('width_sym', 'width_sym')}, {r6('lower_asym', 'lower_asym')}, {r6('upper_asym', 'upper_asym')},
       {r6('width_asym', 'width_asym')} FROM conf"""

_ALPHAS = [0.5, 0.2, 0.1, 0.05]
ORACLE["conformal_any_alpha"] = F_ + " UNION ALL ".join(
    f"SELECT {d(a)} AS alpha, round(least(ceil((n + 1) * (1.0 - {d(a)})) / n, 1.0), 6) AS level, "
    f"round({qlin('rabs', f'least(ceil((n + 1) * (1.0 - {d(a)})) / n, 1.0)')}, 6) AS q_hat FROM lv" for a in _ALPHAS)
ORACLE["conformal_higher"] = F_ + " UNION ALL ".join(
    f"SELECT {d(a)} AS alpha, round(least(ceil((n + 1) * (1.0 - {d(a)})) / n, 1.0), 6) AS level, "
    f"round({qhigher(a)}, 6) AS q_hat FROM lv" for a in _ALPHAS)

_MSIS_SCALE = f"""(SELECT CASE WHEN avg(dv) = 0 THEN 1.0 ELSE avg(dv) END FROM (
    SELECT abs(CAST(sales AS DOUBLE) - lag(CAST(sales AS DOUBLE)) OVER ({W})) AS dv FROM feat WHERE split = 'train') x)"""
_ISCORES = f"""isc AS (
  SELECT method, count(*) AS n, avg({COV}) AS coverage, avg(upper - lower) AS avg_width,
         avg({_wink(d(ALPHA))}) AS mean_winkler,
         avg(CASE WHEN actual >= lower AND actual <= upper THEN upper - lower END) AS sharpness,
         count(*) FILTER (WHERE actual = 0) AS n_zeros,
         avg(CASE WHEN actual = 0 THEN {COV} END) AS zero_coverage,
         avg(CASE WHEN actual = 0 THEN upper - lower END) AS zero_mean_width,
         min(upper - lower) AS width_min, quantile_cont(upper - lower, 0.25) AS width_p25,
         quantile_cont(upper - lower, 0.5) AS width_median, quantile_cont(upper - lower, 0.75) AS width_p75,
         quantile_cont(upper - lower, 0.95) AS width_p95, max(upper - lower) AS width_max,
         stddev_pop(upper - lower) AS width_std
  FROM ilong GROUP BY method),
isc2 AS (SELECT *, mean_winkler / {_MSIS_SCALE} AS msis, abs(coverage - (1.0 - {d(ALPHA)})) AS coverage_error,
         n_zeros * 1.0 / n AS zero_fraction FROM isc)"""
ORACLE["interval_scores"] = F_ + ", " + _ISCORES + """
SELECT method, n, """ + ", ".join(r6(c, c) for c in [
    "coverage", "avg_width", "mean_winkler", "sharpness"]) + ", n_zeros, " + ", ".join(r6(c, c) for c in [
    "zero_coverage", "zero_mean_width", "width_min", "width_p25", "width_median", "width_p75", "width_p95",
    "width_max", "width_std", "msis", "coverage_error", "zero_fraction"]) + " FROM isc2"


def _cov_group(g: str) -> str:
    return F_ + f"""
SELECT method, {g}, count(*) AS n, round(avg({COV}), 6) AS coverage, round(avg(upper - lower), 6) AS mean_width,
       round(avg({_wink(d(ALPHA))}), 6) AS mis FROM ilong GROUP BY method, {g}"""


ORACLE["coverage_by_item"] = _cov_group("item_id")
ORACLE["coverage_by_store"] = _cov_group("store_id")
ORACLE["method_comparison"] = F_ + ", " + _ISCORES + """
SELECT method AS Method, """ + ", ".join(
    f"format('{{:,.4f}}', {c}) AS {n}" for c, n in [
        ("coverage", "Empirical_Coverage"), ("coverage_error", "Coverage_Error"), ("avg_width", "Avg_Interval_Width"),
        ("mean_winkler", "Mean_IS_Winkler"), ("msis", "MSIS"), ("sharpness", "Sharpness"),
        ("zero_coverage", "Zero_Coverage")]) + " FROM isc2"

ORACLE["width_histogram"] = F_ + """, w AS (SELECT method, upper - lower AS v FROM ilong),
b AS (SELECT min(v) AS lo, max(v) AS hi FROM w),
h AS (SELECT method, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 60)), 59) END AS INTEGER) AS bin, lo, hi
      FROM w, b)
SELECT method, bin, round(lo + bin * ((hi - lo) / 60), 6) AS bin_lo, round(lo + (bin + 1) * ((hi - lo) / 60), 6) AS bin_hi,
       count(*) AS count FROM h GROUP BY method, bin, lo, hi"""

_PROBS = "[" + ", ".join(repr(i / 100) for i in range(101)) + "]"
ORACLE["score_quantile_grid"] = F_ + """, sc AS (SELECT method, """ + _wink(d(ALPHA)) + """ AS winkler FROM ilong)
SELECT method, round(p, 6) AS prob, round(q, 6) AS winkler FROM (
  SELECT method, unnest(""" + _PROBS + """::DOUBLE[]) AS p, unnest(quantile_cont(winkler, """ + _PROBS + """)) AS q
  FROM sc GROUP BY method)"""

# ---------------------------------------------------------------- J
_CURVE = f"""curve AS (
  SELECT 'Conformal' AS method, level, alpha, actual, lower, upper FROM lvl_int
  UNION ALL SELECT 'Quantile', {d(0.9)}, {d(round(1 - 0.9, 10))}, actual, lower, upper FROM qint),
curve_m AS (
  SELECT method, level, count(*) AS n, avg({COV}) AS empirical_coverage, avg(upper - lower) AS avg_interval_width,
         stddev_pop(upper - lower) AS sharpness_std, avg({_wink('alpha')}) AS winkler_score,
         coalesce(avg(CASE WHEN actual = 0 THEN {COV} END), 0.0) AS zero_demand_coverage
  FROM curve GROUP BY method, level, alpha)"""
ORACLE["calibration_curve"] = F_ + ", " + _CURVE + """
SELECT method, round(level, 6) AS level, n, """ + ", ".join(r6(c, c) for c in [
    "empirical_coverage", "avg_interval_width", "sharpness_std", "winkler_score", "zero_demand_coverage"]) + \
    ", round(level, 6) AS target_coverage, round(abs(empirical_coverage - level), 6) AS coverage_error FROM curve_m"

ORACLE["method_comparison_90"] = F_ + ", " + _CURVE + """
SELECT method, round(level, 6) AS level, round(empirical_coverage, 6) AS empirical_coverage,
       round(avg_interval_width, 6) AS avg_interval_width, round(winkler_score, 6) AS winkler_score,
       round(abs(empirical_coverage - level), 6) AS coverage_error FROM curve_m WHERE abs(level - 0.9) <= 1e-9"""

ORACLE["volatility_regimes"] = F_ + """, cut AS (SELECT quantile_cont(rolling_std_28, 0.75) AS c FROM long90)
SELECT Method, CASE WHEN rolling_std_28 >= c THEN 'High Volatility' ELSE 'Normal' END AS Regime, count(*) AS Count,
       round(avg(""" + COV + """), 6) AS Coverage, round(avg(upper - lower), 6) AS Avg_Width
FROM long90, cut GROUP BY 1, 2"""

ORACLE["segment_calibration"] = F_ + """
SELECT Method, Segment_Type, Segment_Name, Count, round(Coverage, 6) AS Coverage,
       round(Coverage_Error, 6) AS Coverage_Error, round(Avg_Width, 6) AS Avg_Width FROM segs"""
ORACLE["worst_segments"] = ORACLE["segment_calibration"] + \
    " ORDER BY Coverage_Error DESC, Method, Segment_Type, Segment_Name LIMIT 15"
ORACLE["segment_view"] = F_ + """
SELECT Segment_Name, round(max(CASE WHEN Method = 'Conformal' THEN round(Coverage * 100.0, 1) END), 6) AS conformal_coverage_pct,
       round(max(CASE WHEN Method = 'Quantile' THEN round(Coverage * 100.0, 1) END), 6) AS quantile_coverage_pct
FROM segs WHERE Segment_Type = 'store_id' GROUP BY Segment_Name"""

# ---------------------------------------------------------------- K
ORACLE["risk_scores"] = F_ + f"""
SELECT {KEYS}, """ + ", ".join(r6(c, c) for c in [
    "raw_width", "raw_error", "raw_volatility", "raw_calib_penalty", "comp_width", "comp_error", "comp_volat",
    "comp_calib", "Risk_Score"]) + " FROM rk2"
ORACLE["risk_levels"] = F_ + f"SELECT {KEYS}, {r6('Risk_Score', 'Risk_Score')}, Risk_Level FROM rk3"
ORACLE["risk_level_counts"] = F_ + """
SELECT Risk_Level, count(*) AS count, round(lo, 6) AS low_threshold, round(md, 6) AS medium_threshold,
       0.3 AS w_interval_width, 0.25 AS w_forecast_error, 0.25 AS w_historical_volatility, 0.2 AS w_calibration_penalty
FROM rk3, rb GROUP BY Risk_Level, lo, md"""
ORACLE["recommendations"] = F_ + f"""
SELECT {KEYS}, actual, {r6('point', 'point')}, {r6('lower_sym', 'lower_sym')}, {r6('upper_sym', 'upper_sym')},
       {r6('Risk_Score', 'Risk_Score')}, Risk_Level, Root_Cause, Recommended_Action, Intervention,
       {r6('Recommended_Stock_Level', 'Recommended_Stock_Level')}, {r6('Inventory_Increase', 'Inventory_Increase')},
       {r6('Confidence_Level', 'Confidence_Level')}, {r6('comp_width', 'comp_width')}, {r6('comp_error', 'comp_error')},
       {r6('comp_volat', 'comp_volat')}, {r6('comp_calib', 'comp_calib')} FROM risk"""
ORACLE["top_risk_items"] = F_ + """
SELECT item_id, round(avg(Risk_Score), 6) AS mean_risk FROM risk GROUP BY item_id ORDER BY avg(Risk_Score) DESC, item_id LIMIT 10"""
ORACLE["risk_heatmap"] = F_ + """
SELECT store_id, split_part(item_id, '_', 1) AS cat_id,
       round(avg(CASE WHEN Risk_Level = 'High' THEN 1.0 ELSE 0.0 END), 6) AS high_risk_share FROM risk GROUP BY 1, 2"""
ORACLE["store_risk"] = F_ + "SELECT store_id, round(avg(Risk_Score), 6) AS avg_risk_score FROM risk GROUP BY store_id"

# ---------------------------------------------------------------- L
_POL_COLS = [f"{p}_{c}" for p in ("Baseline", "Proposed") for c in (
    "Order", "Stockout_Units", "Overstock_Units", "Sold_Units", "Holding_Cost", "Stockout_Cost", "Total_Cost")]
ORACLE["policy_costs"] = F_ + f"SELECT {KEYS}, actual, {r6('sell_price', 'sell_price')}, " + \
    ", ".join(r6(c, c) for c in _POL_COLS) + " FROM impact"


def _kpi_sql(src: str, group: str = "") -> str:
    sel = []
    for p in ("Baseline", "Proposed"):
        sel += [f"sum(CAST(actual AS DOUBLE)) AS {p}_Total_Demand", f"sum({p}_Sold_Units) AS {p}_Total_Sold",
                f"sum({p}_Stockout_Units) AS {p}_Stockout_Units", f"sum({p}_Overstock_Units) AS {p}_Overstock_Units",
                f"avg(CASE WHEN {p}_Stockout_Units = 0 THEN 1.0 ELSE 0.0 END) AS {p}_Service_Level",
                f"sum({p}_Holding_Cost) AS {p}_Holding_Cost", f"sum({p}_Stockout_Cost) AS {p}_Stockout_Cost",
                f"sum({p}_Total_Cost) AS {p}_Total_Cost"]
    g = f"{group}, " if group else ""
    inner = f"SELECT {g}count(*) AS Count, {', '.join(sel)} FROM {src}" + (f" GROUP BY {group}" if group else "")
    fr = [f"CASE WHEN {p}_Total_Demand > 0 THEN {p}_Total_Sold / {p}_Total_Demand ELSE 1.0 END AS {p}_Fill_Rate"
          for p in ("Baseline", "Proposed")]
    return f"""SELECT *, {', '.join(fr)},
  Baseline_Total_Cost - Proposed_Total_Cost AS Net_Savings,
  CASE WHEN Baseline_Total_Cost > 0 THEN (Baseline_Total_Cost - Proposed_Total_Cost) / Baseline_Total_Cost ELSE 0.0 END AS Cost_Reduction_Pct,
  Baseline_Stockout_Units - Proposed_Stockout_Units AS Stockout_Reduction_Units,
  Proposed_Holding_Cost - Baseline_Holding_Cost AS Extra_Holding_Cost,
  CASE WHEN Proposed_Holding_Cost - Baseline_Holding_Cost > 0
       THEN (Baseline_Total_Cost - Proposed_Total_Cost) / (Proposed_Holding_Cost - Baseline_Holding_Cost) END AS ROI
FROM ({inner}) k"""


_KPI_OUT = ["Count"] + [f"{p}_{k}" for p in ("Baseline", "Proposed") for k in (
    "Total_Demand", "Total_Sold", "Stockout_Units", "Overstock_Units", "Service_Level", "Holding_Cost",
    "Stockout_Cost", "Total_Cost", "Fill_Rate")] + ["Net_Savings", "Cost_Reduction_Pct", "Stockout_Reduction_Units",
                                                    "Extra_Holding_Cost", "ROI"]


def _kpi_select(prefix: str = "") -> str:
    return prefix + ", ".join(c if c == "Count" else r6(c, c) for c in _KPI_OUT)


ORACLE["policy_kpis"] = F_ + f", kp AS ({_kpi_sql('impact')}) SELECT {_kpi_select()} FROM kp"
ORACLE["kpi_report"] = F_ + f", kp AS ({_kpi_sql('impact')}), kr AS (SELECT {_kpi_select()} FROM kp) " + " UNION ALL ".join(
    f"SELECT '{p}' AS policy, '{k}' AS kpi, CAST({p}_{k} AS DOUBLE) AS value FROM kr" for p in POLICIES for k in KPI_NAMES)
ORACLE["cost_breakdown"] = F_ + f""", kp AS ({_kpi_sql('impact')})
SELECT policy, cost_type, round(amount, 6) AS amount FROM (
  SELECT 'Baseline' AS policy, 'Holding_Cost' AS cost_type, Baseline_Holding_Cost AS amount FROM kp
  UNION ALL SELECT 'Baseline', 'Stockout_Cost', Baseline_Stockout_Cost FROM kp
  UNION ALL SELECT 'Proposed', 'Holding_Cost', Proposed_Holding_Cost FROM kp
  UNION ALL SELECT 'Proposed', 'Stockout_Cost', Proposed_Stockout_Cost FROM kp)"""
ORACLE["scenario_kpis"] = F_ + """, vcut AS (SELECT quantile_cont(rolling_std_28, 0.75) AS c FROM impact),
scen AS (
  SELECT 'Holiday_Event' AS scenario, i.* FROM impact i WHERE has_any_event = 1
  UNION ALL SELECT 'High_Volatility', i.* FROM impact i, vcut WHERE rolling_std_28 >= c
  UNION ALL SELECT 'Normal_Demand', i.* FROM impact i, vcut WHERE has_any_event = 0 AND rolling_std_28 < c),
kp AS (""" + _kpi_sql("scen", "scenario") + f") SELECT {_kpi_select('scenario, ')} FROM kp"

_HR = DEFAULT.simulation.holding_rates
_SR = DEFAULT.simulation.stockout_rates
_GRID = " UNION ALL ".join(f"SELECT {d(h)} AS Holding_Rate, {d(s)} AS Stockout_Rate" for h in _HR for s in _SR)
ORACLE["sensitivity_grid"] = F_ + f""", g AS ({_GRID}),
sw AS (
  SELECT Holding_Rate, Stockout_Rate,
    sum(Baseline_Overstock_Units * (sell_price * Holding_Rate) + Baseline_Stockout_Units * (sell_price * Stockout_Rate)) AS b,
    sum(Proposed_Overstock_Units * (sell_price * Holding_Rate) + Proposed_Stockout_Units * (sell_price * Stockout_Rate)) AS p
  FROM impact, g GROUP BY 1, 2)
SELECT Holding_Rate, Stockout_Rate, round(b, 6) AS Baseline_Total_Cost, round(p, 6) AS Proposed_Total_Cost,
       round(b - p, 6) AS Net_Savings FROM sw"""
ORACLE["sensitivity_pivot"] = F_ + f""", g AS ({_GRID}),
sw AS (
  SELECT Holding_Rate, Stockout_Rate,
    sum(Baseline_Overstock_Units * (sell_price * Holding_Rate) + Baseline_Stockout_Units * (sell_price * Stockout_Rate))
  - sum(Proposed_Overstock_Units * (sell_price * Holding_Rate) + Proposed_Stockout_Units * (sell_price * Stockout_Rate)) AS s
  FROM impact, g GROUP BY 1, 2)
SELECT Stockout_Rate, """ + ", ".join(
    f'round(max(CASE WHEN Holding_Rate = {d(h)} THEN s END), 6) AS "{h!r}"' for h in _HR) + \
    " FROM sw GROUP BY Stockout_Rate"


def _whatif(h, s, conf, lead, vol):
    import math
    total = (conf / 90.0) * math.sqrt(lead / 1.0) * vol
    ef = math.exp(-1.2 * (total - 0.5))
    of = 0.4 + 0.6 * total
    return f"""w AS (
  SELECT sell_price AS pr, Baseline_Stockout_Units * {d(vol)} AS bso, Baseline_Overstock_Units * {d(vol)} AS bov,
         Baseline_Stockout_Units * {d(vol)} * {d(ef)} AS pso, Baseline_Overstock_Units * {d(vol)} * {d(of)} AS pov
  FROM impact),
a AS (
  SELECT avg(CASE WHEN bso < 0.5 THEN 1.0 ELSE 0.0 END) AS bl, avg(CASE WHEN pso < 0.5 THEN 1.0 ELSE 0.0 END) AS pl,
         sum(bov * pr * {d(h)} + bso * pr * {d(s)}) AS bc, sum(pov * pr * {d(h)} + pso * pr * {d(s)}) AS pc,
         avg(pso) AS mpso, avg(pr) AS mpr FROM w)"""


ORACLE["whatif_kpis"] = F_ + ", " + _whatif(0.05, 0.40, 95.0, 4.0, 1.2) + """
SELECT round(bl * 100, 6) AS Baseline_SL, round(pl * 100, 6) AS Proposed_SL, round(bc, 6) AS Baseline_Cost,
       round(pc, 6) AS Proposed_Cost, round(bc - pc, 6) AS Net_Savings,
       round((bc - pc) / greatest(bc, 1e-9) * 100, 6) AS Cost_Reduction_Pct, round(1.0 - pl, 6) AS Stockout_Prob,
       round(mpso * mpr * 0.4, 6) AS Avg_Shortfall FROM a"""
ORACLE["savings_curve"] = F_ + ", " + _whatif(0.05, 0.40, 90.0, 1.0, 1.0) + """,
r AS (SELECT round(0.01 * i, 2) AS h FROM range(1, 21) t(i))
SELECT round(h * 100, 6) AS Holding_Rate_Pct,
       round(sum(bov * pr * h + bso * pr * 0.4) - sum(pov * pr * h + pso * pr * 0.4), 6) AS Net_Savings
FROM w, r GROUP BY h"""

# ---------------------------------------------------------------- M
ORACLE["exposure_topn"] = F_ + f"""
SELECT {KEYS}, Risk_Level, round(Risk_Score, 6) AS Risk_Score,
       round(greatest(Baseline_Total_Cost - Proposed_Total_Cost, 0.0), 6) AS financial_exposure,
       CAST(greatest(1, CAST(floor(15 - Risk_Score / 100.0 * 10) AS INTEGER)) AS INTEGER) AS days_to_stockout
FROM impact WHERE Risk_Level = 'High'
ORDER BY greatest(Baseline_Total_Cost - Proposed_Total_Cost, 0.0) DESC, item_id, store_id, day_index LIMIT 20"""
ORACLE["sku_search"] = F_ + f"""
SELECT {KEYS}, Risk_Level, round(Risk_Score, 6) AS Risk_Score FROM impact WHERE strpos(upper(item_id), 'PROMO_1') > 0"""


def _mode(col: str) -> str:
    return f"""(SELECT v FROM (SELECT {col} AS v, count(*) AS c FROM impact i2
             WHERE i2.item_id = g.item_id AND i2.store_id = g.store_id GROUP BY 1) x ORDER BY c DESC, v LIMIT 1)"""


ORACLE["sku_card"] = F_ + f""", g AS (
  SELECT item_id, store_id, avg(Risk_Score) AS mean_risk_score, avg(Recommended_Stock_Level) AS mean_recommended_stock,
         avg(Baseline_Total_Cost - Proposed_Total_Cost) AS avg_savings,
         avg(comp_width) * 100.0 AS comp_width_pct, avg(comp_error) * 100.0 AS comp_error_pct,
         avg(comp_volat) * 100.0 AS comp_volat_pct, avg(comp_calib) * 100.0 AS comp_calib_pct
  FROM impact GROUP BY 1, 2)
SELECT item_id, store_id, {_mode('Risk_Level')} AS risk_level, {_mode('Root_Cause')} AS root_cause,
       {_mode('Recommended_Action')} AS action, {_mode('Intervention')} AS intervention, """ + ", ".join(r6(c, c) for c in [
    "mean_risk_score", "mean_recommended_stock", "avg_savings", "comp_width_pct", "comp_error_pct",
    "comp_volat_pct", "comp_calib_pct"]) + " FROM g"
ORACLE["stock_proxies"] = F_ + """
SELECT item_id, store_id, round(avg(CAST(actual AS DOUBLE)), 6) AS mean_actual, round(avg(upper_sym), 6) AS safety_stock,
       round(avg(Recommended_Stock_Level), 6) AS recommended_qty, round(avg(CAST(actual AS DOUBLE)) * 0.8, 6) AS current_stock,
       round(avg(CAST(actual AS DOUBLE)) * 0.5, 6) AS reorder_point,
       CAST(CASE WHEN avg(CAST(actual AS DOUBLE)) * 0.8 < avg(upper_sym) THEN 1 ELSE 0 END AS INTEGER) AS at_risk
FROM impact GROUP BY 1, 2"""
ORACLE["sku_stats"] = F_ + """
SELECT item_id, store_id, round(avg(CAST(actual AS DOUBLE)), 6) AS mean_demand,
       round(stddev_samp(CAST(actual AS DOUBLE)) / greatest(avg(CAST(actual AS DOUBLE)), 1e-9), 6) AS cv
FROM impact GROUP BY 1, 2"""
ORACLE["residual_histogram"] = F_ + """, r AS (
  SELECT item_id, store_id, CAST(actual AS DOUBLE) - point AS residual FROM impact),
rr AS (SELECT *, min(residual) OVER (PARTITION BY item_id, store_id) AS mn, max(residual) OVER (PARTITION BY item_id, store_id) AS mx FROM r)
SELECT item_id, store_id, CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((residual - mn) / ((mx - mn) / 20)), 19) END AS INTEGER) AS bin,
       count(*) AS count, round(min(residual), 6) AS bin_min, round(max(residual), 6) AS bin_max FROM rr GROUP BY 1, 2, 3"""
ORACLE["filter_options"] = F_ + "SELECT DISTINCT store_id FROM impact WHERE store_id IS NOT NULL"
ORACLE["rescaled_interval"] = F_ + ", " + _CURVE + f""", sc AS (
  SELECT CASE WHEN bw > 0 THEN coalesce(tw, bw) / bw ELSE 1.0 END AS s FROM (
    SELECT coalesce((SELECT avg_interval_width FROM curve_m WHERE method = 'Conformal' AND abs(level - 0.9) < 1e-9),
                    (SELECT avg(width_sym) FROM conf)) AS bw,
           (SELECT avg_interval_width FROM curve_m WHERE method = 'Conformal' AND abs(level - 0.8) < 0.05
            ORDER BY abs(level - 0.8) LIMIT 1) AS tw) x)
SELECT {KEYS}, round(point, 6) AS point, round(point - width_sym / 2 * s, 6) AS lower_conf,
       round(point + width_sym / 2 * s, 6) AS upper_conf FROM conf, sc"""
ORACLE["headline_kpis"] = F_ + """
SELECT count(DISTINCT item_id) AS total_products, count(*) FILTER (WHERE Risk_Level = 'High') AS high_risk_rows,
       round(sum(Baseline_Total_Cost) - sum(Proposed_Total_Cost), 6) AS net_savings,
       round((avg(CASE WHEN Proposed_Stockout_Units = 0 THEN 1.0 ELSE 0.0 END)
            - avg(CASE WHEN Baseline_Stockout_Units = 0 THEN 1.0 ELSE 0.0 END)) * 100, 6) AS service_level_delta_pp
FROM impact"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

# ---------------------------------------------------------------- additions
ORACLE["dataset_overview"] = F_ + """, t AS (SELECT count(*) AS rows FROM feat)
SELECT rows, 52 AS columns, dtype, n_columns FROM t, (VALUES ('date', 1), ('double', 12), ('int', 26), ('string', 13)) v(dtype, n_columns)"""

_NARROW = ("sales", "year", "month", "week", "day_of_month", "day_of_week", "is_weekend", "quarter",
           "day_index", "wday", "is_zero_sales", "has_price", "wm_yr_wk", "snap_active")
ORACLE["narrowing_plan"] = F_ + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS BIGINT) AS min, CAST(max({c}) AS BIGINT) AS max,
       CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'byte' WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'short'
            WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'long' END AS target_type FROM feat"""
    for c in _NARROW)

ORACLE["dev_subset"] = F_ + f"""
SELECT {KEYS}, sales, split FROM feat
WHERE store_id IN ('AFRICA_1', 'ASIA_2', 'EUROPE_1') AND day_index <= 100
  AND item_id IN (SELECT DISTINCT item_id FROM feat ORDER BY item_id LIMIT 5)"""

ORACLE["score_ecdf"] = F_ + """
SELECT DISTINCT method, round(upper - lower, 6) AS width,
       round(cume_dist() OVER (PARTITION BY method ORDER BY upper - lower), 6) AS ecdf FROM ilong"""

ORACLE["conformal_thresholds_select"] = F_ + """
SELECT n_calibration, round(q_sym, 6) AS q_hat_symmetric, round(q_lo, 6) AS q_hat_lo_asymmetric,
       round(q_hi, 6) AS q_hat_hi_asymmetric FROM thr"""

ORACLE["scenario_savings_ranking"] = ORACLE["scenario_kpis"].replace(
    f"SELECT {_kpi_select('scenario, ')} FROM kp",
    "SELECT scenario, Count, round(Net_Savings, 6) AS Net_Savings, round(Cost_Reduction_Pct, 6) AS Cost_Reduction_Pct FROM kp")
