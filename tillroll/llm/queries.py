"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    bpe_rows, html_text, importance, line_rules, neardup, packing, quality, sharding, token_files, topk, toxicity, whitening, winnowing,
)
from tillroll.llm.shared import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(table(spark, sf_dir, "documents"), tokenizer_path("bytes"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_rows.digest(table(spark, sf_dir, "documents"), tokenizer_path("words"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.grouped(table(spark, sf_dir, "documents"), width=2)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("words"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_files, op2_bpe, op3_quality, op4_sharding, op5_topk, op6_minhash, op7_html_text, op8_toxicity, op9_line_rules, op10_packing,
        op11_winnowing, op12_importance, op13_whitening,
    )
}

ORACLE_SQL: dict[str, str] = {"op5_topk": topk.SQL, "op6_minhash": neardup.SQL, "op11_winnowing": winnowing.SQL, "op12_importance": importance.SQL}
