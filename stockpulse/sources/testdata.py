"""Map the driver's TPC-H-ish tables onto the M5-shaped retail inputs.

Rules (see FIXTURES.md part 2):

* a shipment is a ``lineitem`` row; ``day_index`` counts days from
  ``PanelConfig.start_date`` (1-based), only days 1..n_days are kept;
* item  = part type, size parity and part-key parity, e.g. ``PROMO_2_002``;
* store = supplier region (spaces removed) and supplier-key parity;
* sales = whole shipped quantity per item-store-day, 0 where nothing shipped,
  over every series observed in the window x every day of the window;
* sell_price = max retail price per item-store-week (weeks without
  shipments have no price row, so the price fill is exercised);
* calendar = one row per day, events and SNAP days from a date rule.

Every table is derived by Spark from the given Parquet tables, so the work
grows with them.  The per-series day map is bounded by ``n_days`` entries
(the shipments are pre-aggregated per item-store-day before it is built), so
no group grows with the data volume.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.config import PanelConfig
from stockpulse.sources.tables import read_table

# Fixed values of the fixture rule: states in region-key order (k = 0..4);
# SNAP days of state k are the days of month (1+k)..(10+k).
FIXTURE_STATES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLEEAST")
# Fixed values of the fixture rule: (month, day, name, type) of primary events,
# the secondary event, and the first-Sunday-of-February sporting event.
FIXED_DATE_EVENTS = (
    (12, 25, "Christmas", "Religious"),
    (1, 1, "NewYear", "National"),
    (7, 4, "Independence", "National"),
    (2, 14, "Valentines", "Cultural"),
)
SECONDARY_EVENTS = ((1, 1, "Parade", "Cultural"),)
FEB_FIRST_SUNDAY_EVENT = ("Final", "Sporting")

SERIES_KEYS = ("item_id", "store_id")


def _start(cfg: PanelConfig) -> Column:
    return F.to_date(F.lit(cfg.start_date))


def _ts_bounds(cfg: PanelConfig):
    start = _dt.date.fromisoformat(cfg.start_date)
    end = start + _dt.timedelta(days=cfg.n_days)
    lo = F.lit(f"{start.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{end.isoformat()} 00:00:00").cast("timestamp_ntz")
    return lo, hi


def whole_window(spark: SparkSession, sf_dir: str) -> PanelConfig:
    """The window that spans all shipments: two values from the column statistics."""
    first, last = read_table(spark, sf_dir, "lineitem", ["l_shipdate"]).agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    return PanelConfig.spanning(first.date(), last.date()) if first else PanelConfig()


def item_id_expr(p_type="p_type", p_size="p_size", p_partkey="p_partkey") -> Column:
    return F.concat_ws(
        "_", F.col(p_type),
        (F.lit(1) + F.col(p_size) % 2).cast("string"),
        F.lpad((F.lit(1) + F.col(p_partkey) % 2).cast("string"), 3, "0"))


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type", "p_size", "p_retailprice"])
    return part.select("p_partkey", item_id_expr().alias("item_id"), "p_retailprice")


def supplier_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions
    nation = F.broadcast(read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"]))
    region = F.broadcast(read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"]))
    state = F.regexp_replace(F.col("r_name"), " ", "")
    return (sup.join(nation, sup.s_nationkey == nation.n_nationkey)
               .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
               .select("s_suppkey",
                       F.concat_ws("_", state, (F.lit(1) + F.col("s_suppkey") % 2).cast("string")).alias("store_id")))


def shipments(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """Shipments inside the window: item_id, store_id, day_index, quantity, retail price."""
    lo, hi = _ts_bounds(cfg)
    li = (read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"])
          .where((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi)))
    li = li.select("l_partkey", "l_suppkey", "l_quantity",
                   (F.datediff(F.to_date("l_shipdate"), _start(cfg)) + 1).alias("day_index"))
    return (li.join(part_items(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
              .join(supplier_stores(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
              .select("item_id", "store_id", "day_index", "l_quantity", "p_retailprice"))


def week_of(day_index: Column | str) -> Column:
    d = F.col(day_index) if isinstance(day_index, str) else day_index
    return (F.lit(1) + F.floor((d - 1) / 7)).cast("int")


def daily_shipments(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """Shipments summed per item-store-day (partial aggregation before the
    shuffle); carries the day's max retail price so the price fact and the
    sales panel share one scan and one exchange."""
    return (shipments(spark, sf_dir, cfg)
            .groupBy("item_id", "store_id", "day_index")
            .agg(F.sum("l_quantity").cast("int").alias("qty"),
                 F.max("p_retailprice").alias("max_price")))


def sell_prices(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig(),
                maps: DataFrame | None = None) -> DataFrame:
    """The price fact: one row per (store_id, item_id, wm_yr_wk) with shipments.

    Aggregated from the per-series day maps (already hash-partitioned by
    series), so this aggregate and the later price join need no exchange
    of their own and lineitem is scanned once for sales and prices."""
    m = maps if maps is not None else series_day_maps(spark, sf_dir, cfg)
    e = m.select("item_id", "store_id", F.explode("day_sales").alias("day_index", "v"))
    return (e.groupBy("store_id", "item_id", week_of("day_index").alias("wm_yr_wk"))
             .agg(F.max("v.max_price").alias("sell_price")))


def series_day_maps(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """One row per observed series with a ``day_index -> (qty, max_price)`` map.

    Shipments are summed per item-store-day first (map-side partial
    aggregation), so each map holds at most ``n_days`` entries whatever the
    shipment volume of a hot series.  The result is hash-partitioned by
    (item_id, store_id), the partitioning every series window reuses.
    """
    daily = daily_shipments(spark, sf_dir, cfg)
    return (daily.groupBy("item_id", "store_id")
                 .agg(F.map_from_entries(F.collect_list(
                     F.struct("day_index", F.struct("qty", "max_price")))).alias("day_sales")))


def daily_units(first_day: int, n_days: int) -> Column:
    """The units of days ``first_day`` .. ``first_day + n_days - 1`` as an array, from ``day_sales``; 0 where nothing shipped.

    The days in order, each after the zeros of the days that it skips: linear
    in the number of days, where a lookup of each day in the map is quadratic.
    """
    last = first_day + n_days - 1
    # map_filter keeps the days asked for; the day before them and the one after them close the gaps at the ends
    entries = f"array_sort(map_entries(map_filter(day_sales, (k, v) -> k between {first_day} and {last})))"
    return F.expr(f"""
        flatten(flatten(zip_with(
            array_append(transform({entries}, e -> struct(e.key AS day, coalesce(e.value.qty, 0) AS qty)), struct({last + 1} AS day, 0 AS qty)),
            array_prepend(transform({entries}, e -> e.key), {first_day - 1}),
            (e, before) -> array(array_repeat(0, e.day - before - 1), if(e.day > {last}, array(), array(e.qty))))))""")


def with_hierarchy(df: DataFrame) -> DataFrame:
    """Add id / dept_id / cat_id / state_id derived from item_id and store_id."""
    return (df.withColumn("id", F.concat_ws("_", "item_id", "store_id"))
              .withColumn("dept_id", F.substring_index("item_id", "_", 2))
              .withColumn("cat_id", F.split_part(F.col("item_id"), F.lit("_"), F.lit(1)))
              .withColumn("state_id", F.split_part(F.col("store_id"), F.lit("_"), F.lit(1))))


def sales_long(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig(),
               maps: DataFrame | None = None) -> DataFrame:
    """Dense long panel: id columns, d, day_index, sales (0 where nothing shipped)."""
    m = maps if maps is not None else series_day_maps(spark, sf_dir, cfg)
    # a series' days come from its own row: no join, and the series partitioning stays
    long = m.select("item_id", "store_id", F.posexplode(daily_units(1, cfg.n_days)).alias("at", "sales")).select(
        "item_id", "store_id", (F.col("at") + 1).alias("day_index"),
        F.concat(F.lit("d_"), (F.col("at") + 1).cast("string")).alias("d"), "sales")
    return with_hierarchy(long).select("id", "item_id", "dept_id", "cat_id", "store_id", "state_id",
                                       "d", "day_index", "sales")


def sales_wide(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig(),
               first_day: int | None = None, n_days: int | None = None,
               maps: DataFrame | None = None) -> DataFrame:
    """Wide sales table (6 id columns + d_<first>..d_<last>), as the raw M5 file.

    Built straight from the per-series map: one column per day, no pivot
    shuffle.  The column count is a parameter (defaults to the last
    ``wide_days`` days of the window).
    """
    n_days = n_days or cfg.wide_days
    first_day = first_day or (cfg.n_days - n_days + 1)
    m = with_hierarchy(maps if maps is not None else series_day_maps(spark, sf_dir, cfg))
    ids = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
    days = m.select(*ids, daily_units(first_day, n_days).alias("_units"))
    return days.selectExpr(*ids, *[f"coalesce(get(_units, {k}), 0) AS d_{first_day + k}" for k in range(n_days)])


def calendar(spark: SparkSession, cfg: PanelConfig = PanelConfig(),
             states=FIXTURE_STATES) -> DataFrame:
    """Calendar dimension: one row per day of the window (n_days rows)."""
    days = spark.range(1, cfg.n_days + 1).select(F.col("id").cast("int").alias("day_index"))
    date = F.date_add(_start(cfg), F.col("day_index") - 1)
    cal = days.select("day_index", date.alias("date"))
    m, dom = F.month("date"), F.dayofmonth("date")

    def _events(rules, first_sunday):
        name, typ = None, None
        for (mm, dd, n, t) in rules:
            cond = (m == mm) & (dom == dd)
            name = F.when(cond, n) if name is None else name.when(cond, n)
            typ = F.when(cond, t) if typ is None else typ.when(cond, t)
        if first_sunday:
            cond = (m == 2) & (dom <= 7) & (F.dayofweek("date") == 1)
            name, typ = name.when(cond, FEB_FIRST_SUNDAY_EVENT[0]), typ.when(cond, FEB_FIRST_SUNDAY_EVENT[1])
        return name, typ

    n1, t1 = _events(FIXED_DATE_EVENTS, True)
    n2, t2 = _events(SECONDARY_EVENTS, False)
    snaps = [F.when((dom >= 1 + k) & (dom <= 10 + k), 1).otherwise(0).alias(f"snap_{s}")
             for k, s in enumerate(states)]
    return cal.select(
        "date", week_of("day_index").alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        (F.dayofweek("date") % 7 + 1).alias("wday"),
        m.alias("month"), F.year("date").alias("year"),
        F.concat(F.lit("d_"), F.col("day_index").cast("string")).alias("d"),
        n1.alias("event_name_1"), t1.alias("event_type_1"),
        n2.alias("event_name_2"), t2.alias("event_type_2"),
        *snaps)


def m5_tables(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig(),
              maps: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three raw inputs of the pipeline, derived from the test tables.

    Pass a persisted ``series_day_maps`` frame as ``maps`` to build sales and
    prices from one scan of lineitem (a cached scan keeps the series hash
    partitioning, so the windows downstream still need no exchange)."""
    return {"calendar": calendar(spark, cfg), "prices": sell_prices(spark, sf_dir, cfg, maps),
            "sales_long": sales_long(spark, sf_dir, cfg, maps)}
