"""Registration of queries, their output layout and their SQL.

A layout such as ``"YearMonth:s revenue:2 lines:l"`` names the output columns and their types once
for both engines: ``s`` text, ``i`` integer, ``l`` long, ``b`` boolean, ``t`` timestamp, ``d`` date,
``x`` double as is, and a digit for a double rounded to that many decimals. Sums of doubles depend
on their order, so they are rounded at the very end, and only here. Dates are shown as text, because
result readers disagree on their type.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.catalog.sql import PRELUDE
from tillroll.functions.ranks import numbered_copies
from tillroll.operators import customers, prepare, scaling, segments
from tillroll.plans.prediction import labelled_customers
from tillroll.session import pinned, written
from tillroll.schema import BASE_COLUMNS, MEASURES, TARGET
from tillroll.sources.retail_view import retail_lines

SPARK_TYPES = {"s": "string", "i": "int", "l": "bigint", "b": "boolean", "t": "timestamp_ntz", "d": "string", "x": "double"}
SQL_TYPES = {"s": "VARCHAR", "i": "INTEGER", "l": "BIGINT", "b": "BOOLEAN", "t": "TIMESTAMP", "d": "VARCHAR", "x": "DOUBLE"}


class Tables:
    """Lazy inputs shared by the queries."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw(self) -> DataFrame:
        return retail_lines(self.spark, self.folder)

    @cached_property
    def numbered(self) -> DataFrame:
        """All lines with equal ones numbered from 0 as ``copy``, written once because three row sets are made of them."""
        return written(numbered_copies(self.raw, "copy"))

    @cached_property
    def sets(self) -> dict[str, DataFrame]:
        return prepare.row_sets(self.raw)

    @property
    def full(self) -> DataFrame:
        return self.sets["full"]

    @property
    def positive(self) -> DataFrame:
        return self.sets["positive_sales"]

    @cached_property
    def measures(self) -> DataFrame:
        """The measures of positive sales, written once because the queries over them read them several times."""
        return written(self.positive.select(*MEASURES))

    @cached_property
    def priced(self) -> DataFrame:
        """Lines with a price: their keys and measures, written once because fences and flags read them several times."""
        return written(self.sets["valid_price"].select("InvoiceNo", "StockCode", *MEASURES))

    @cached_property
    def sales(self) -> DataFrame:
        """Positive sales with a known customer."""
        return prepare.with_customer(self.positive)

    @cached_property
    def sold(self) -> DataFrame:
        """``sales`` without the calendar columns, written once for those that read it several times."""
        return written(self.sales.select(*BASE_COLUMNS, "TotalAmount", "YearMonth"))

    @cached_property
    def dates(self) -> dict[str, int]:
        return customers.split_dates(self.sold)

    @cached_property
    def rfm(self) -> DataFrame:
        """The customer table, written once because the queries over it read it several times."""
        return pinned(customers.rfm(self.sales))

    @cached_property
    def grouped_rfm(self) -> DataFrame:
        """Customers with a rule-based cluster, so that formulas have exact expectations."""
        f = F.col("Frequency")
        return self.rfm.withColumn("Cluster", F.when(f < 7, 0).when(f < 9, 1).otherwise(2))

    @cached_property
    def scaled_rfm(self) -> DataFrame:
        return pinned(scaling.log_scaled_rfm(self.grouped_rfm))

    @cached_property
    def profiles(self) -> DataFrame:
        return segments.cluster_profiles(self.grouped_rfm)

    @cached_property
    def matrix(self) -> DataFrame:
        return labelled_customers(self.sold, self.dates)

    @cached_property
    def split_matrix(self) -> DataFrame:
        """Labelled customers with their part in training or test, written once for the fits."""
        return pinned(scaling.stratified_split(pinned(self.matrix), TARGET))

    @cached_property
    def scored(self) -> DataFrame:
        """Documents with a 0/1 label and a rule-based score and prediction."""
        chars = F.col("n_chars").cast("double")
        documents = self.table("documents").select("doc_id", (chars / (chars + 1000)).alias("score"))
        labels = self.table("labels").select("doc_id", F.col("quality").alias("label"))
        joined = labels.join(documents, "doc_id")
        return joined.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))

    @cached_property
    def vector_scored(self) -> DataFrame:
        """Vectors whose largest entry, by its position modulo ten, names one of ten classes."""
        from tillroll.operators.vectors import add_argmax

        v = add_argmax(self.table("embeddings"), "embedding", "place")
        return v.select("vec_id", "label", F.pmod("place", F.lit(10)).cast("int").alias("prediction"))


@dataclass
class Query:
    build: Callable[[Tables], DataFrame]
    layout: str | None
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Tables(spark, folder))
        return arranged(df, self.layout) if self.layout else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        columns = ", ".join(sql_column(*item.split(":")) for item in self.layout.split())
        return f"{PRELUDE}\nSELECT {columns} FROM (\n{self.sql.strip()}\n) AS answer"


def spark_column(name: str, kind: str) -> str:
    if kind.isdigit():
        value = f"round(double(`{name}`), {kind})"
        return f"CASE WHEN {value} = 0 THEN 0D ELSE {value} END AS `{name}`"
    return f"CAST(`{name}` AS {SPARK_TYPES[kind]}) AS `{name}`"


def sql_column(name: str, kind: str) -> str:
    if kind.isdigit():
        value = f"round(CAST(\"{name}\" AS DOUBLE), {kind})"
        return f"CASE WHEN {value} = 0 THEN CAST(0 AS DOUBLE) ELSE {value} END AS \"{name}\""
    return f'CAST("{name}" AS {SQL_TYPES[kind]}) AS "{name}"'


def arranged(df: DataFrame, layout: str) -> DataFrame:
    return df.selectExpr(*[spark_column(*item.split(":")) for item in layout.split()])


QUERIES: dict[str, Query] = {}


def query(name: str, layout: str | None = None, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(build, layout, sql)
        return build

    return register


def union(parts: dict[str, DataFrame], name: str) -> DataFrame:
    """Small result tables of one layout below each other, with a column that tells them apart."""
    out = None
    for key, df in parts.items():
        one = df.select(F.lit(key).alias(name), "*")
        out = one if out is None else out.unionByName(one)
    return out
