"""Table readers.

Readers take explicit schemas (no inference) and return lazy DataFrames;
column pruning and predicate pushdown into the Parquet scan are left to
Catalyst.
"""

from __future__ import annotations

import csv
import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TESTDATA_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                   "lineitem", "events", "documents", "embeddings", "pages",
                   "benchmark", "labels", "conversations")

# Raw M5-shaped input schemas (calendar, sell_prices; sales is wide and built
# from the id columns plus d_1..d_N integer columns).
CALENDAR_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("weekday", T.StringType()),
    T.StructField("wday", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("d", T.StringType()),
    T.StructField("event_name_1", T.StringType()),
    T.StructField("event_type_1", T.StringType()),
    T.StructField("event_name_2", T.StringType()),
    T.StructField("event_type_2", T.StringType()),
])
PRICES_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("sell_price", T.DoubleType()),
])
SALES_ID_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")


#: Columns of the raw files by type; every other column of a file is a string, d_<n> and snap_<state> columns are integers.
KNOWN_TYPES = {f.name: f.dataType for s in (CALENDAR_SCHEMA, PRICES_SCHEMA) for f in s.fields} | {c: T.StringType() for c in SALES_ID_COLUMNS}


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """A1: the schema of a CSV file from its header line alone, without a pass over its rows."""
    first = spark.read.text(path).first()
    names = next(csv.reader([first[0].lstrip("\ufeff")])) if first else []
    if len(set(names)) != len(names):
        raise ValueError(f"{path}: a column name is repeated")

    def kind(c: str) -> T.DataType:
        if c in KNOWN_TYPES:
            return KNOWN_TYPES[c]
        number = c.startswith("snap_") or (c.startswith("d_") and c[2:].isdigit())
        return T.IntegerType() if number else T.StringType()

    return T.StructType([T.StructField(c, kind(c)) for c in names])


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    """A3/A4: Parquet scan with an optional column list (pruned at the scan)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             nrows: int | None = None, date_columns: Iterable[str] = ()) -> DataFrame:
    """A1: header CSV scan with typed columns (by default those of the header) and an optional row limit."""
    df = spark.read.option("header", True).option("maxColumns", 100_000).option("enforceSchema", False) \
        .schema(schema if schema is not None else header_schema(spark, path)).csv(path)
    for c in date_columns:
        df = df.withColumn(c, F.to_date(c))
    return df.limit(nrows) if nrows else df


def check_inputs_exist(paths: Mapping[str, str]) -> None:
    """A2: fail before reading anything when any input is missing."""
    missing = [f"{k}: {p}" for k, p in paths.items() if not _exists(p)]
    if missing:
        raise FileNotFoundError("missing inputs: " + "; ".join(missing))


def _exists(path: str) -> bool:
    if "://" in path and not path.startswith("file://"):
        return True  # remote stores: let the reader raise
    return os.path.exists(path.replace("file://", ""))


#: Columns without which a raw table cannot be used.
NEEDED = {"calendar": ("d", "date", "wm_yr_wk"), "prices": ("store_id", "item_id", "wm_yr_wk", "sell_price"), "sales": ("item_id", "store_id")}


def load_m5_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """A2: calendar / sell_prices / sales (wide) readers with an up-front check.

    ``paths`` maps ``calendar``, ``prices`` and ``sales`` to CSV or Parquet
    paths. CSV schemas come from the header lines, so a wide sales file of any
    number of days and a calendar of any states are read once, typed. Missing
    files raise before any rows are read (missing columns: ``check_columns``).
    """
    if (gone := sorted(set(NEEDED) - set(paths))):
        raise ValueError("no path for: " + ", ".join(gone))
    check_inputs_exist(paths)
    return {k: spark.read.parquet(paths[k]) if paths[k].rstrip("/").endswith(".parquet") else load_csv(spark, paths[k]) for k in NEEDED}


def check_columns(raw: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    """A2: ``raw`` itself, or an error that names the columns which a raw table lacks."""
    gone = [f"{k}.{c}" for k, columns in NEEDED.items() for c in columns if c not in raw[k].columns]
    if gone:
        raise ValueError("missing columns: " + ", ".join(gone))
    return raw


def read_stage_output(spark: SparkSession, path: str, fmt: str = "parquet",
                      id_columns: Iterable[str] = ("item_id", "store_id")) -> DataFrame:
    """Read a stage output, ids cast to string, cat/dept derived from item_id."""
    r = spark.read
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", True)
    df = r.format(fmt).load(path)
    for c in id_columns:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("string"))
    if "item_id" in df.columns:
        df = (df.withColumn("cat_id", F.split_part(F.col("item_id"), F.lit("_"), F.lit(1)))
                .withColumn("dept_id", F.substring_index(F.col("item_id"), "_", 2)))
    return df
