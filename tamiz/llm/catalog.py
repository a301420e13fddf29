"""Catalog queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tamiz.llm.common import table
from tamiz.llm.contamination import decontaminate
from tamiz.llm.dialogue_repair import damaged, repair
from tamiz.llm.html_template import extract
from tamiz.llm.jaccard_join import jaccard_join
from tamiz.llm.line_dedup import line_dedup
from tamiz.llm.mixing import taken
from tamiz.llm.packing import pack
from tamiz.llm.ppm import score
from tamiz.llm.pu_quality import classify
from tamiz.llm.quality_rules import quality_rules
from tamiz.llm.secrets import scan
from tamiz.llm.spelling import spelling_variants
from tamiz.llm.winnowing import compare_with_next
from tamiz.llm.oracles import SQL


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_lines", "lost_share")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return marked.select("doc_id", "n_lines", "removed_lines", F.length("clean_text").alias("clean_chars"),
                         F.sha2("clean_text", 256).alias("clean_sha256"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op11_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair(damaged(turns), ids=turns)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_mixing, op3_jaccard_join, op4_ppm, op5_quality_rules,
                                    op6_secrets, op7_packing, op8_line_dedup, op9_winnowing, op10_html,
                                    op11_contamination, op12_spelling, op13_dialogue)} | {
        "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
