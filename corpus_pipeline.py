"""The corpus pipeline: documents in, packed training sequences out.

Language ID, line dedup, SimHash near-dedup, benchmark decontamination,
packing. Every stage reads what its predecessor wrote (Parquet in the shared
folder), so a lost executor never sets the pipeline back by more than a stage.

A document that a stage empties stays with its empty text; those whose
language is not known (no letters, or words of no clear language) go. Odd input
(nulls, empty and repeated rows, extra columns) is handled as the operators'
docstrings state. All stages but the last return the columns of documents,
n_chars made to fit a changed text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.llm import decontaminate, langid, lines, packing, simhash
from stockpulse.llm.common import with_length, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_length(lines.drop_recurring_lines(docs)).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return with_length(decontaminate.clean(docs, benchmark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Language ID and packing by a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
