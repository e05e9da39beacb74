"""Profiles of a table: overview, numeric and categorical summaries, first and last rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillroll.functions.columns import amount_of, percent, records, row_count
from tillroll.functions.moments import unbiased_kurtosis, unbiased_skewness
from tillroll.functions.ranks import column_quantiles, melt, running_totals
from tillroll.schema import MEASURES, TEXT_COLUMNS, present

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
TAIL = {"p90": 0.90, "p95": 0.95, "p99": 0.99}


def dataset_overview(df: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Size, distinct entities, date range and revenue as one row.

    ``sales`` are the lines whose amounts count as revenue; by default all lines.
    """
    base = df.agg(
        row_count().alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.count_distinct("InvoiceNo").alias("n_invoices"),
        F.count_distinct("CustomerID").alias("n_customers"),
        F.count_distinct("StockCode").alias("n_products"),
        F.count_distinct("Country").alias("n_countries"),
        F.count_distinct("Description").alias("n_descriptions"),
        F.min(F.to_date("InvoiceDate")).alias("date_min"),
        F.max(F.to_date("InvoiceDate")).alias("date_max"),
    )
    lines = df if sales is None else sales
    revenue = lines.agg(F.coalesce(F.sum(amount_of(lines)), F.lit(0.0))).scalar()
    return base.withColumn("total_revenue", revenue)


def overview_rows(df: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """The overview as metric and text value."""
    one = dataset_overview(df, sales)
    return records(one, [{"metric": F.lit(c), "value": F.col(c).cast("string")} for c in one.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double")]


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, extended: bool = False) -> DataFrame:
    """Count, mean, sample deviation, range and quartiles of each column.

    ``extended`` adds P90, P95, P99 and bias-corrected skewness and kurtosis.
    """
    names = present(df, columns or numeric_columns(df))
    aggs = [
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    if extended:
        aggs += [unbiased_skewness("value").alias("skewness"), unbiased_kurtosis("value").alias("kurtosis")]
    shape = melt(df, names).groupBy("column").agg(*aggs)
    probs = {**QUARTILES, **(TAIL if extended else {})}
    # Both sides hold one row for each column.
    return shape.join(column_quantiles(df, names, probs), "column")


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("string", "boolean")]


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each value (null included) of several columns as ``column, value, count``."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(row_count().alias("count"))


def categorical_summary(df: DataFrame, top_n: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """The most frequent values of each text or flag column with their share of all rows.

    The rank filter lets Spark cut each partition to ``top_n`` rows before the shuffle.
    """
    counts = value_counts(df, present(df, columns or text_columns(df)))
    total = df.agg(row_count()).scalar()
    order = Window.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    top = counts.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= top_n)
    return top.withColumn("percentage", percent(F.col("count"), total))


def categorical_frequencies(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS, digits: int = 3) -> DataFrame:
    """All values of each column by falling count, their rounded share and its running sum."""
    counts = value_counts(df, present(df, columns))
    total = df.agg(row_count()).scalar()
    shares = counts.withColumn("percentage", F.bround(percent(F.col("count"), total), digits))
    order = [-F.col("count"), F.col("value")]
    summed = running_totals(shares, order, {"running": F.col("percentage")}, by=["column"])
    return summed.withColumn("cumulative_percentage", F.bround("running", digits)).drop("running")


def head_rows(df: DataFrame, n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """The first rows in a stated order; rows of a distributed table have none of their own."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in (order or df.columns)]).limit(n)


def tail_rows(df: DataFrame, n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    return df.orderBy(*[F.desc_nulls_last(c) for c in (order or df.columns)]).limit(n)


def amount_stats(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Thirteen statistics as rows, one column for each measure."""
    names = present(df, columns)
    summary = numeric_summary(df, names, extended=True)
    total = melt(df, names).groupBy("column").agg(F.sum("value").alias("sum"))
    wide = summary.join(total, "column").withColumn("iqr", F.col("q3") - F.col("q1"))
    metrics = ["count", "sum", "mean", "median", "std", "min", "max", "q1", "q3", "iqr", "p90", "p95", "p99"]
    long = wide.select("column", *[F.col(m).cast("double").alias(m) for m in metrics])
    long = long.unpivot(["column"], metrics, "metric", "value")
    return long.groupBy("metric").pivot("column", names).agg(F.first("value"))
