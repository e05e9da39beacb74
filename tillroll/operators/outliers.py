"""IQR fences, flags, heavy-tail figures, extreme rows and distribution shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.columns import holds, is_cancelled, number, percent, records, safe_divide
from tillroll.functions.ranks import column_quantiles, melt, quantiles
from tillroll.operators.explore import numeric_summary
from tillroll.schema import IQR_MULTIPLIER, MEASURES, present, require

# Percentiles of the heavy-tail table.
TAIL_PROBS = {"P50": 0.5, "P75": 0.75, "P90": 0.90, "P95": 0.95, "P99": 0.99, "P99_5": 0.995, "P99_9": 0.999}
# Columns of the extreme and example tables.
EXTREME_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice", "CustomerID", "Country"]
EXAMPLE_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice", "TotalAmount", "InvoiceDate", "Country",
]


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[number(df, c).alias(c) for c in columns])


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str] = MEASURES,
    multiplier: float = IQR_MULTIPLIER,
    positive_only: bool = True,
) -> DataFrame:
    """Quartiles, fences, centre, range and size of each column, one row per column."""
    names = present(df, columns)
    values = _numbers(df, names)
    basics = melt(values, names, positive=positive_only).groupBy("column").agg(
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count("value").alias("n"),
    )
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    out = basics.join(column_quantiles(values, names, probs, positive=positive_only), "column")
    iqr = F.col("q3") - F.col("q1")
    return out.select(
        "column",
        "q1",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - multiplier * iqr).alias("lower_bound"),
        (F.col("q3") + multiplier * iqr).alias("upper_bound"),
        "median",
        "mean",
        "min",
        "max",
        "n",
    )


def fences(bounds: DataFrame) -> Column:
    """All columns' fences as one scalar: a map from column name to lower and upper bound."""
    entry = F.struct("column", F.struct("lower_bound", "upper_bound"))
    return bounds.agg(F.map_from_entries(F.collect_list(entry))).scalar()


def _outside(df: DataFrame, name: str, positive_only: bool) -> Column:
    """Whether a value lies beyond its fence, read from the column ``_fences``."""
    x, fence = number(df, name), F.col("_fences").getItem(name)
    out = (x < fence.getField("lower_bound")) | (x > fence.getField("upper_bound"))
    return holds(out & (x > 0) if positive_only else out)


def flag_iqr_outliers(
    df: DataFrame,
    columns: Sequence[str] = MEASURES,
    multiplier: float = IQR_MULTIPLIER,
    positive_only: bool = True,
) -> DataFrame:
    """Add ``<column>_IsOutlier``. With ``positive_only`` values at or below zero are never flagged."""
    names = present(df, columns)
    fenced = df.withColumn("_fences", fences(iqr_bounds(df, names, multiplier, positive_only)))
    return fenced.withColumns({f"{c}_IsOutlier": _outside(df, c, positive_only) for c in names}).drop("_fences")


def outlier_summary(
    df: DataFrame,
    columns: Sequence[str] = MEASURES,
    multiplier: float = IQR_MULTIPLIER,
    positive_only: bool = True,
    pct_base: str = "all",
) -> DataFrame:
    """Fences, number and share of flagged rows per column.

    The share is of all rows, or of the column's positive values with ``pct_base="positive"``.
    """
    if pct_base not in ("all", "positive"):
        raise ValueError("pct_base is 'all' or 'positive'")
    names = present(df, columns)
    bounds = iqr_bounds(df, names, multiplier, positive_only)
    counts = df.withColumn("_fences", fences(bounds)).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_outside(df, c, positive_only)).alias(f"{c}_out") for c in names],
        *[F.count_if(number(df, c) > 0).alias(f"{c}_pos") for c in names],
    )
    rows = [
        {
            "column": F.lit(c),
            "outlier_count": F.col(f"{c}_out"),
            "outlier_pct": percent(F.col(f"{c}_out"), F.col("_rows" if pct_base == "all" else f"{c}_pos")),
        }
        for c in names
    ]
    return bounds.join(records(counts, rows), "column")


def outlier_impact(flagged: DataFrame, column: str, flag: str | None = None) -> DataFrame:
    """Count, centre, spread, range and sum of a column with and without its flagged rows."""
    flag = flag or f"{column}_IsOutlier"
    require(flagged, [column, flag])
    x = number(flagged, column).cast("double")
    both = flagged.select(
        x.alias("With outliers"), F.when(~F.coalesce(F.col(flag), F.lit(False)), x).alias("Without outliers")
    )
    names = both.columns
    totals = melt(both, names).groupBy("column").agg(F.sum("value").alias("sum"))
    out = numeric_summary(both, names).join(totals, "column")
    return out.select(F.col("column").alias("subset"), "count", "mean", "median", "std", "min", "max", "sum")


def heavy_tail(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Upper percentiles of the positive values and how far the tail reaches beyond them."""
    names = present(df, columns)
    values = _numbers(df, names)
    basics = melt(values, names, positive=True).groupBy("column").agg(
        F.avg("value").alias("mean"), F.max("value").alias("max")
    )
    out = basics.join(column_quantiles(values, names, TAIL_PROBS, positive=True), "column")
    return out.select(
        "column",
        "mean",
        F.col("P50").alias("median"),
        *TAIL_PROBS,
        safe_divide(F.col("P99"), F.col("P50")).alias("p99_to_p50"),
        safe_divide(F.col("max"), F.col("P99")).alias("max_to_p99"),
    )


def extreme_values(df: DataFrame, column: str, n: int = 10, largest: bool = True) -> DataFrame:
    """The rows with the ``n`` largest or smallest values; ties go by the remaining columns."""
    require(df, [column])
    shown = present(df, dict.fromkeys([*EXTREME_COLUMNS, column]))
    x = number(df, column)
    order = [x.desc() if largest else x.asc(), *[F.asc_nulls_first(c) for c in shown]]
    return df.filter(x.isNotNull()).select(*shown).orderBy(*order).limit(n)


def anomaly_examples(full: DataFrame, sales: DataFrame, n: int = 5) -> dict[str, DataFrame]:
    """Largest quantity and amount among sales, strongest cancellations, first lines without a price.

    "First" follows date and invoice, since distributed rows have no file order.
    """
    shown = present(full, EXAMPLE_COLUMNS)
    ties = [F.asc_nulls_first(c) for c in shown]

    def top(df: DataFrame, *order: Column) -> DataFrame:
        return df.select(*shown).orderBy(*order, *ties).limit(n)

    return {
        "largest_quantity": top(sales, F.desc("Quantity")),
        "highest_totalamount": top(sales, F.desc("TotalAmount")),
        "cancellation_examples": top(full.filter(is_cancelled()), F.asc("Quantity")),
        "zero_or_negative_price": top(
            full.filter(number(full, "UnitPrice") <= 0), F.asc("InvoiceDate"), F.asc("InvoiceNo")
        ),
    }


def histogram(df: DataFrame, column: str, bins: int = 50, positive: bool = True, log: bool = False) -> DataFrame:
    """Counts in equal bins between the smallest and largest value, empty bins included.

    Each row also carries mean and exact median of the values (a plot's marks).
    """
    x = number(df, column).cast("double")
    values = df.select((F.log1p(x) if log else x).alias("x")).filter(x > 0 if positive or log else x.isNotNull())
    span = values.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high"), F.avg("x").alias("mean"))).scalar()
    low, width = F.col("s.low"), (F.col("s.high") - F.col("s.low")) / F.lit(bins)
    place = F.when(width > 0, F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    placed = values.withColumn("s", span).select(place.cast("long").alias("bin"))
    median = quantiles(values, {"median": 0.5}, value="x").select("median").scalar()
    counted = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    out = every.join(counted, "bin", "left").withColumn("s", span)
    return out.select(
        "bin",
        (low + F.col("bin") * width).alias("bin_low"),
        (low + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.col("s.mean").alias("mean"),
        median.alias("median"),
    )


def box_stats(df: DataFrame, columns: Sequence[str] = MEASURES, multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """Quartiles of the positive values, whisker ends inside the fences, and points beyond them."""
    names = present(df, columns)
    bounds = iqr_bounds(df, names, multiplier, positive_only=True)
    aggs = []
    for c in names:
        x, fence = number(df, c).cast("double"), F.col("_fences").getItem(c)
        inside = (x > 0) & x.between(fence.getField("lower_bound"), fence.getField("upper_bound"))
        aggs += [
            F.min(F.when(inside, x)).alias(f"{c}_low"),
            F.max(F.when(inside, x)).alias(f"{c}_high"),
            F.count_if((x > 0) & ~inside).alias(f"{c}_out"),
        ]
    rows = [
        {
            "column": F.lit(c),
            "whisker_low": F.col(f"{c}_low"),
            "whisker_high": F.col(f"{c}_high"),
            "beyond": F.col(f"{c}_out"),
        }
        for c in names
    ]
    ends = records(df.withColumn("_fences", fences(bounds)).agg(*aggs), rows)
    return bounds.select("column", "min", "q1", "median", "q3", "max").join(ends, "column")
