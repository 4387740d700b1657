"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmart.llm import (
    chat, contamination, filter_audit, html_text, minhash, mixing, phrases, quality, secret_scan, sharding, simhash, site_lines,
    substrings,
)
from crossmart.llm.common import table
from crossmart.llm.statements import STATEMENTS


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines.without_boilerplate(table(spark, sf_dir, "pages"), site_lines.lines_of_html(F.col("html")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": lambda s, d: simhash.near_duplicates(table(s, d, "documents")),
    "op2_quality_rules": quality_rules,
    "op3_decontamination": decontamination,
    "op4_source_mixing": lambda s, d: mixing.mixed(table(s, d, "documents")),
    "op5_html_extraction": lambda s, d: html_text.extracted(table(s, d, "pages")),
    "op6_secret_scan": lambda s, d: secret_scan.secrets(table(s, d, "documents")),
    "op7_substring_dedup": lambda s, d: substrings.repeats(table(s, d, "documents")),
    "op8_sharding": lambda s, d: sharding.sharded(table(s, d, "documents")),
    "op9_chat_formatting": lambda s, d: chat.formatted(table(s, d, "conversations")),
    "op10_line_dedup": line_dedup,
    "op11_phrase_collocations": lambda s, d: phrases.collocations(table(s, d, "documents")),
    "op12_minhash_near_dedup": lambda s, d: minhash.near_duplicates(table(s, d, "documents")),
    "op13_filter_interactions": lambda s, d: filter_audit.interactions(table(s, d, "documents"), table(s, d, "labels")),
}


def oracle_sql() -> dict[str, str]:
    return dict(STATEMENTS)
