"""Category dictionaries and model inputs.

A dictionary has, for every column, its distinct values in order with dense
codes from 0, as a categorical type has. The values of all columns are found
in one grouped pass, dealt to ranges, written, and numbered by a prefix sum
over the ranges; nothing is collected and no column's values meet in one task.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.session import ensure_checkpoint_dir

#: Largest number of values of a column whose dictionary is broadcast; larger ones are joined by a shuffle.
BROADCAST_VALUES = 100_000
#: Largest number of values of a column that is split into indicator columns for linear models.
INDICATOR_VALUES = 200


def _written(df: DataFrame, name: str) -> DataFrame:
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), "stockpulse", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def value_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code) of all distinct values that are not null, codes dense and in order of value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = _written(values.repartitionByRange(n, "column", "value").sortWithinPartitions("column", "value")
                     .withColumn("at", F.monotonically_increasing_id()), "dictionary")
    part = F.shiftright("at", 33)
    # one row for each range and column
    ranges = dealt.groupBy("column", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("column", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return _written(dealt.withColumn("part", part).join(ranges, ["column", "part"])
                    .select("column", "value", (F.col("base") + F.col("at") - F.col("first")).cast("long").alias("code"), "rows"), "dictionary-codes")


@dataclass
class Dictionary:
    """A written dictionary and the number of values of each column."""

    table: DataFrame
    sizes: dict[str, int] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> "Dictionary":
        table = value_dictionary(df, columns)
        found = {r[0]: r[1] for r in table.groupBy("column").count().collect()}  # a row for each column
        return cls(table, {c: found.get(c, 0) for c in columns})

    def encode(self, df: DataFrame, columns: Sequence[str] | None = None, suffix: str = "_code") -> DataFrame:
        """``df`` with ``<column>_code``; values not in the dictionary (nulls too) get the code after the last one.

        A column's dictionary is broadcast if it is checked to be small, else
        joined by a shuffle, in which Spark splits skewed values.
        """
        for c in columns or list(self.sizes):
            codes = self.table.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
            if self.sizes[c] <= BROADCAST_VALUES:
                codes = F.broadcast(codes)
            name = f"{c}{suffix}"
            kept = [F.col(f"`{x}`") for x in df.columns if x != name]
            nominal = {"ml_attr": {"type": "nominal", "name": name, "num_vals": self.sizes[c] + 1}}
            df = df.join(codes, F.col(c).cast("string") == F.col("_value"), "left") \
                .select(*kept, F.coalesce("_code", F.lit(self.sizes[c])).cast("int").alias(name, metadata=nominal))
        return df


def split_columns(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) of the model's input columns."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return [c for c in columns if c not in text], [c for c in columns if c in text]


def model_inputs(features: DataFrame, columns: Sequence[str], dictionary: Dictionary | None = None,
                 carry: Sequence[str] = ("item_id", "store_id", "day_index", "sales", "split")) -> tuple[DataFrame, list[str], list[str], Dictionary]:
    """the model's rows with all numeric inputs as doubles and all categorical ones as codes.

    The dictionary is fitted on the train split unless one is given. Returns
    (rows, numeric columns, code columns, dictionary).
    """
    numeric, text = split_columns(features, columns)
    dictionary = dictionary or Dictionary.fit(features.where(F.col("split") == "train"), text)
    coded = dictionary.encode(features, text)
    codes = [f"{c}_code" for c in text]
    inputs = [c for c in numeric if c not in carry]
    both = [c for c in numeric if c in carry]
    rows = coded.select(*carry, *[F.col(c).cast("double").alias(c) for c in inputs], *[F.col(c).cast("double").alias(f"{c}_num") for c in both], *codes)
    return rows, [*inputs, *[f"{c}_num" for c in both]], codes, dictionary


def indicators(codes: Sequence[str], dictionary: Dictionary, suffix: str = "_code") -> dict[str, int]:
    """Values of each code column that is to be split into indicators by a linear model (the others count as numbers)."""
    sizes = {c: dictionary.sizes[c.removesuffix(suffix)] + 1 for c in codes}
    return {c: n for c, n in sizes.items() if n <= INDICATOR_VALUES}


def indicator(code: str, value: int) -> Column:
    return (F.col(code) == value).cast("double")
