"""From raw documents to packed training sequences: four stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import line_rules, neardup, packing, quality
from tillroll.llm.shared import kept, table, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the whole table's labelled rows, takes for good text."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content lines."""
    model = line_rules.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return line_rules.accepted(docs, model)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return neardup.deduplicated(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, packed into sequences."""
    return packing.pack(docs, tokenizer_path("words"))


STAGES = [("quality", quality_stage), ("rules", rules_stage), ("dedup", dedup_stage), ("packing", packing_stage)]

# Fitted models, a component search and token ids are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's output is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
