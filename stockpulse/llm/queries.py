"""Registered queries of the training-data operators: each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stockpulse.llm import chat, decontaminate, langid, lines, minhash, ngram_lm, packing, prefix_trie, repair, simhash, spotsigs, token_files, toxicity
from stockpulse.llm.common import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_recurring_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return got.select("doc_id", "held_out", "score", "predicted", "n_matches", "n_quoted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.components(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    fixed = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.chat_digests(chat.read_chats(chat.format_chats(turns.union(fixed))))


def op5_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ngram_lm.held_out_scores(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", (fold(F.col("doc_id"), ngram_lm.FOLDS) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "order_score")


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing.pack(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = token_files.token_files(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return got.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      decontaminate.items_digest(F.col("items")).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = repair.repair(repair.damage(_table(spark, sf_dir, "conversations")))
    return got.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.components(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.encode(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuild(prefix_trie.in_order(turns)))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_toxicity, op3_simhash, op4_chat_format, op5_ngram_lm, op6_spotsigs, op7_packing,
                                    op8_language_id, op9_token_files, op10_decontaminate, op11_conversation_repair, op12_minhash, op13_prefix_trie, pipeline)}


def oracle_sql() -> dict[str, str]:
    sql = {"op1_line_dedup": lines.ORACLE_SQL}
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
