"""Inventory policy back-test and business impact.

Costs are linear in the holding / stockout rates, so every rate grid
(L8 sensitivity sweep, L10 savings curve) is evaluated from four per-policy
sums gathered in ONE pass over the rows; the grid is applied to that
one-row aggregate.  No row is ever multiplied by the grid size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.config import SimulationConfig
from stockpulse.operators.quantiles import global_quantiles
from stockpulse.operators.risk import round_half_even

POLICIES = ("Baseline", "Proposed")


# ------------------------------------------------------------------ L1-L3
def order_policies(df: DataFrame) -> DataFrame:
    """L1: Baseline = round(point), Proposed = round(recommended stock);
    half-even rounding, floored at 0."""
    return (df.withColumn("Baseline_Order", F.greatest(round_half_even(F.col("point"), 0), F.lit(0.0)))
              .withColumn("Proposed_Order",
                          F.greatest(round_half_even(F.col("Recommended_Stock_Level"), 0), F.lit(0.0))))


def policy_costs(df: DataFrame, holding_rate=0.05, stockout_rate=0.40,
                 policies: Sequence[str] = POLICIES) -> DataFrame:
    """L2/L3: units and costs per policy (rates may be columns)."""
    h = holding_rate if isinstance(holding_rate, Column) else F.lit(float(holding_rate))
    s = stockout_rate if isinstance(stockout_rate, Column) else F.lit(float(stockout_rate))
    y = F.col("actual").cast("double")
    out = df
    for p in policies:
        o = F.col(f"{p}_Order")
        out = (out.withColumn(f"{p}_Stockout_Units", F.greatest(y - o, F.lit(0.0)))
                  .withColumn(f"{p}_Overstock_Units", F.greatest(o - y, F.lit(0.0)))
                  .withColumn(f"{p}_Sold_Units", F.least(y, o))
                  .withColumn(f"{p}_Holding_Cost", F.col(f"{p}_Overstock_Units") * (F.col("sell_price") * h))
                  .withColumn(f"{p}_Stockout_Cost", F.col(f"{p}_Stockout_Units") * (F.col("sell_price") * s))
                  .withColumn(f"{p}_Total_Cost", F.col(f"{p}_Holding_Cost") + F.col(f"{p}_Stockout_Cost")))
    return out


# ------------------------------------------------------------------ L4/L5
def kpi_aggs(p: str) -> list[Column]:
    y = F.col("actual").cast("double")
    return [
        F.sum(y).alias(f"{p}_Total_Demand"),
        F.sum(f"{p}_Sold_Units").alias(f"{p}_Total_Sold"),
        F.sum(f"{p}_Stockout_Units").alias(f"{p}_Stockout_Units"),
        F.sum(f"{p}_Overstock_Units").alias(f"{p}_Overstock_Units"),
        F.avg((F.col(f"{p}_Stockout_Units") == 0).cast("double")).alias(f"{p}_Service_Level"),
        F.sum(f"{p}_Holding_Cost").alias(f"{p}_Holding_Cost"),
        F.sum(f"{p}_Stockout_Cost").alias(f"{p}_Stockout_Cost"),
        F.sum(f"{p}_Total_Cost").alias(f"{p}_Total_Cost"),
    ]


def policy_kpis(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """L4 + L5 in one aggregate: KPIs of both policies and the comparison.

    Fill rate is 1.0 without demand; cost reduction 0 without baseline
    cost; ROI = savings / extra holding, NULL when extra holding <= 0 (the
    reference writes infinity)."""
    aggs = [F.count(F.lit(1)).alias("Count")]
    for p in POLICIES:
        aggs += kpi_aggs(p)
    a = df.groupBy(*by).agg(*aggs)
    for p in POLICIES:
        a = a.withColumn(f"{p}_Fill_Rate",
                         F.when(F.col(f"{p}_Total_Demand") > 0,
                                F.col(f"{p}_Total_Sold") / F.col(f"{p}_Total_Demand")).otherwise(F.lit(1.0)))
    sav = F.col("Baseline_Total_Cost") - F.col("Proposed_Total_Cost")
    extra = F.col("Proposed_Holding_Cost") - F.col("Baseline_Holding_Cost")
    return (a.withColumn("Net_Savings", sav)
             .withColumn("Cost_Reduction_Pct", F.when(F.col("Baseline_Total_Cost") > 0,
                                                      sav / F.col("Baseline_Total_Cost")).otherwise(F.lit(0.0)))
             .withColumn("Stockout_Reduction_Units", F.col("Baseline_Stockout_Units") - F.col("Proposed_Stockout_Units"))
             .withColumn("Extra_Holding_Cost", extra)
             .withColumn("ROI", F.when(extra > 0, sav / extra)))


KPI_NAMES = ("Total_Demand", "Total_Sold", "Stockout_Units", "Overstock_Units", "Fill_Rate",
             "Service_Level", "Holding_Cost", "Stockout_Cost", "Total_Cost")


def policy_kpis_long(kpis: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """L11 / report form: one row per (group, policy, KPI)."""
    cols = [f"{p}_{k}" for p in POLICIES for k in KPI_NAMES]
    ids = list(by) or ["_k"]
    base = kpis.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]) if by else \
        kpis.select(F.lit(0).alias("_k"), *[F.col(c).cast("double").alias(c) for c in cols])
    long = base.unpivot(ids, cols, "name", "value")
    return long.select(*by, F.split_part(F.col("name"), F.lit("_"), F.lit(1)).alias("policy"),
                       F.regexp_replace(F.col("name"), "^[A-Za-z]+_", "").alias("kpi"), "value")


# ------------------------------------------------------------------ L6/L7
def scenario_frame(df: DataFrame, pct: float = 0.75, mode: str = "select") -> DataFrame:
    """Overlapping scenarios - a row can be both Holiday_Event and
    High_Volatility (so scenario counts do not add up to the row count)."""
    cut = global_quantiles(df, "rolling_std_28", [pct], mode=mode).select("q0").scalar()
    v = F.col("rolling_std_28")
    ev = F.col("has_any_event")
    tags = F.array(F.when(ev == 1, F.lit("Holiday_Event")),
                   F.when(v >= cut, F.lit("High_Volatility")),
                   F.when((ev == 0) & (v < cut), F.lit("Normal_Demand")))
    # explode then drop the NULL tags (a scalar subquery may not sit inside
    # a higher-order function such as filter())
    return df.withColumn("scenario", F.explode(tags)).where(F.col("scenario").isNotNull())


def scenario_kpis(df: DataFrame, pct: float = 0.75, mode: str = "select") -> DataFrame:
    """KPI report per non-empty scenario (+ Count)."""
    return policy_kpis(scenario_frame(df, pct, mode), ["scenario"])


# ------------------------------------------------------------------ L8-L10
def cost_basis(df: DataFrame) -> DataFrame:
    """Per-policy sums that every rate grid needs (one pass)."""
    aggs = []
    for p in POLICIES:
        aggs += [F.sum(F.col(f"{p}_Overstock_Units") * F.col("sell_price")).alias(f"{p}_H"),
                 F.sum(F.col(f"{p}_Stockout_Units") * F.col("sell_price")).alias(f"{p}_S")]
    return df.agg(*aggs)


def sensitivity_grid(df: DataFrame, holding_rates: Sequence[float] = SimulationConfig().holding_rates,
                     stockout_rates: Sequence[float] = SimulationConfig().stockout_rates) -> DataFrame:
    """L8 (B10): baseline / proposed total cost and savings for every
    (holding, stockout) pair.  cost(h, s) = h * sum(overstock*price) +
    s * sum(stockout*price), so the grid is applied to a one-row
    aggregate (grid rows come from an inline array of config values)."""
    grid = F.array(*[F.struct(F.lit(float(h)).alias("Holding_Rate"), F.lit(float(s)).alias("Stockout_Rate"))
                     for h in holding_rates for s in stockout_rates])
    b = cost_basis(df).select("*", F.inline(grid))
    h, s = F.col("Holding_Rate"), F.col("Stockout_Rate")
    base = h * F.col("Baseline_H") + s * F.col("Baseline_S")
    prop = h * F.col("Proposed_H") + s * F.col("Proposed_S")
    return b.select("Holding_Rate", "Stockout_Rate", base.alias("Baseline_Total_Cost"),
                    prop.alias("Proposed_Total_Cost"), (base - prop).alias("Net_Savings"))


def sensitivity_pivot(grid: DataFrame, holding_rates: Sequence[float] = SimulationConfig().holding_rates) -> DataFrame:
    """Stockout rate x holding rate -> net savings."""
    from stockpulse.operators.panel import pivot_grid
    return pivot_grid(grid, "Stockout_Rate", "Holding_Rate", "Net_Savings", [float(h) for h in holding_rates])


def whatif_kpis(df: DataFrame, holding_rate: float = 0.05, stockout_rate: float = 0.40,
                confidence: float = 90.0, lead_time: float = 1.0, volatility: float = 1.0) -> DataFrame:
    """Dashboard what-if scaling of stockout / overstock units."""
    import math
    total = (confidence / 90.0) * math.sqrt(lead_time / 1.0) * volatility
    bso = F.col("Baseline_Stockout_Units") * volatility
    bov = F.col("Baseline_Overstock_Units") * volatility
    pso = bso * math.exp(-1.2 * (total - 0.5))
    pov = bov * (0.4 + 0.6 * total)
    price = F.col("sell_price")
    btc = bov * price * holding_rate + bso * price * stockout_rate
    ptc = pov * price * holding_rate + pso * price * stockout_rate
    a = df.agg(F.avg((bso < 0.5).cast("double")).alias("bl_svc"),
               F.avg((pso < 0.5).cast("double")).alias("pr_svc"),
               F.sum(btc).alias("Baseline_Cost"), F.sum(ptc).alias("Proposed_Cost"),
               F.avg(pso).alias("_pso"), F.avg(price).alias("_price"))
    return a.select(
        (F.col("bl_svc") * 100).alias("Baseline_SL"), (F.col("pr_svc") * 100).alias("Proposed_SL"),
        "Baseline_Cost", "Proposed_Cost", (F.col("Baseline_Cost") - F.col("Proposed_Cost")).alias("Net_Savings"),
        ((F.col("Baseline_Cost") - F.col("Proposed_Cost")) / F.greatest(F.col("Baseline_Cost"), F.lit(1e-9)) * 100)
        .alias("Cost_Reduction_Pct"),
        (1.0 - F.col("pr_svc")).alias("Stockout_Prob"),
        (F.col("_pso") * F.col("_price") * stockout_rate).alias("Avg_Shortfall"))


def savings_curve(df: DataFrame, stockout_rate: float = 0.40, confidence: float = 90.0,
                  lead_time: float = 1.0, volatility: float = 1.0, points: int = 20) -> DataFrame:
    """What-if net savings for holding rates 1 %..``points`` % - one
    pass (savings are linear in the holding rate)."""
    import math
    total = (confidence / 90.0) * math.sqrt(lead_time / 1.0) * volatility
    bso = F.col("Baseline_Stockout_Units") * volatility
    bov = F.col("Baseline_Overstock_Units") * volatility
    pso = bso * math.exp(-1.2 * (total - 0.5))
    pov = bov * (0.4 + 0.6 * total)
    price = F.col("sell_price")
    a = df.agg(F.sum(bov * price).alias("_bh"), F.sum(bso * price).alias("_bs"),
               F.sum(pov * price).alias("_ph"), F.sum(pso * price).alias("_ps"))
    rates = F.array(*[F.lit(round(0.01 * i, 2)) for i in range(1, points + 1)])
    a = a.select("*", F.explode(rates).alias("Holding_Rate"))
    h = F.col("Holding_Rate")
    sav = (h * F.col("_bh") + stockout_rate * F.col("_bs")) - (h * F.col("_ph") + stockout_rate * F.col("_ps"))
    return a.select((h * 100).alias("Holding_Rate_Pct"), sav.alias("Net_Savings"))


def cost_breakdown(kpis: DataFrame) -> DataFrame:
    """(policy, cost type, amount) long table."""
    cols = [f"{p}_{c}" for p in POLICIES for c in ("Holding_Cost", "Stockout_Cost")]
    long = kpis.select(F.lit(1).alias("_k"), *cols).unpivot(["_k"], cols, "name", "amount").drop("_k")
    return long.select(F.split_part(F.col("name"), F.lit("_"), F.lit(1)).alias("policy"),
                       F.regexp_replace(F.col("name"), "^[A-Za-z]+_", "").alias("cost_type"),
                       F.col("amount").cast("double").alias("amount"))


def scenario_savings_ranking(scen: DataFrame) -> DataFrame:
    """Scenarios ranked by net savings."""
    return scen.select("scenario", "Count", "Net_Savings", "Cost_Reduction_Pct") \
               .orderBy(F.desc("Net_Savings"), "scenario")
