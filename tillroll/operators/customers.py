"""Customer tables: recency/frequency/monetary, behaviour features, temporal cut-off and target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.columns import amount_of, line_amount, number, safe_divide, whole_days
from tillroll.functions.ranks import values_at
from tillroll.operators.explore import numeric_summary
from tillroll.operators.prepare import Instant, instant, sales_lines
from tillroll.schema import (
    CATEGORICAL_FEATURES,
    NUMERIC_FEATURES,
    RFM_COLUMNS,
    SPLIT_QUANTILE,
    TARGET,
    require,
)


def _need_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")


def rfm(sales: DataFrame, reference: Instant | None = None, require_rows: bool = False) -> DataFrame:
    """Per customer: whole days since the last purchase, distinct invoices, summed amount.

    The reference time defaults to one day after the last purchase of any known customer.
    ``require_rows`` raises ValueError on empty input; it runs a job, so it is off by default.
    """
    require(sales, ["CustomerID", "InvoiceNo", "InvoiceDate", "Quantity", "UnitPrice", "TotalAmount"])
    known = sales.filter(F.col("CustomerID").isNotNull())
    if require_rows:
        _need_rows(known, "lines with a customer")
    if reference is None:
        latest = known.agg(F.max("InvoiceDate")).scalar()
        reference = latest + F.make_dt_interval(days=F.lit(1))
    return known.groupBy("CustomerID").agg(
        whole_days(instant(reference), F.max("InvoiceDate")).alias("Recency"),
        F.count_distinct("InvoiceNo").alias("Frequency"),
        F.coalesce(F.sum(amount_of(sales)), F.lit(0.0)).alias("Monetary"),
    )


def rfm_distribution(table: DataFrame) -> DataFrame:
    """Describe figures with bias-corrected skewness and kurtosis of each RFM column."""
    require(table, RFM_COLUMNS)
    return numeric_summary(table, RFM_COLUMNS, extended=True).drop("p90", "p95", "p99")


def rfm_means(table: DataFrame) -> DataFrame:
    return table.agg(*[F.avg(c).alias(c) for c in RFM_COLUMNS])


def customer_mode(df: DataFrame, column: str = "Country") -> DataFrame:
    """Each customer's most frequent non-null value, the smallest among ties, null if there is none.

    Values are counted before customers are: a customer with most of the lines shrinks to one row
    per value on the map side, where a mode aggregate would keep a growing buffer per customer.
    """
    known = df.filter(F.col("CustomerID").isNotNull())
    counts = known.groupBy("CustomerID", column).agg(F.count(column).alias("n"))
    first = F.min_by(F.col(column), F.struct(-F.col("n"), F.col(column)))
    return counts.groupBy("CustomerID").agg(first.alias(column))


def customer_features(
    lines: DataFrame, historical_end: Instant, historical_start: Instant | None = None, require_rows: bool = False
) -> DataFrame:
    """Behaviour of each customer strictly before the cut-off, in the published column order.

    The cut-off filter is applied here whatever the caller did before, so no later line can leak in.
    """
    require(lines, ["CustomerID", "InvoiceNo", "StockCode", "Quantity", "UnitPrice", "InvoiceDate", "Country"])
    end = instant(historical_end)
    past = lines.filter((F.col("InvoiceDate") < end) & F.col("CustomerID").isNotNull())
    if require_rows:
        _need_rows(past, "lines before the cut-off")
    start = past.agg(F.min("InvoiceDate")).scalar() if historical_start is None else instant(historical_start)
    days = F.greatest(F.lit(1).cast("long"), whole_days(end, start))
    quantity = number(past, "Quantity")
    table = past.groupBy("CustomerID").agg(
        whole_days(end, F.max("InvoiceDate")).alias("Recency"),
        F.count_distinct("InvoiceNo").alias("Frequency"),
        F.coalesce(F.sum(line_amount(past)), F.lit(0.0)).alias("Monetary"),
        F.count_distinct("StockCode").alias("UniqueProducts"),
        F.avg(quantity).alias("AvgQuantity"),
        F.coalesce(F.sum(quantity), F.lit(0)).alias("TotalQuantity"),
    )
    # Both sides are aggregates by customer and so already partitioned alike.
    table = table.join(customer_mode(past), "CustomerID").withColumns(
        {
            "AOV": safe_divide(F.col("Monetary"), F.col("Frequency")),
            "PurchaseFrequency": safe_divide(F.col("Frequency"), days),
        }
    )
    return table.select("CustomerID", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES)


def temporal_split(df: DataFrame, column: str = "InvoiceDate", quantile: float = SPLIT_QUANTILE) -> DataFrame:
    """Cut-off dates as one row.

    The history ends at the distinct timestamp with zero-based index ``floor(quantile * n)``. If that
    is the first one, it ends at the same share of the time range instead. The future runs from there
    to the last timestamp.
    """
    micros = df.filter(F.col(column).isNotNull()).select(F.unix_micros(column).alias("value")).distinct()
    index = f"greatest(0, least(floor(double({quantile!r}) * n), n - 1))"
    picked = values_at(micros, [], {"first": "0", "cut": index, "last": "n - 1"}).withColumnRenamed("n", "n_dates")
    spread = (F.col("first") + (F.col("last") - F.col("first")) * F.lit(quantile)).cast("long")
    cut = F.when(F.col("cut") <= F.col("first"), spread).otherwise(F.col("cut"))
    dates = picked.withColumn("cut", cut).select(
        F.timestamp_micros("first").alias("historical_start"),
        F.timestamp_micros("cut").alias("historical_end"),
        F.timestamp_micros("cut").alias("future_start"),
        F.timestamp_micros("last").alias("future_end"),
        "n_dates",
    )
    return dates.withColumns(
        {
            "days_historical": whole_days(F.col("historical_end"), F.col("historical_start")),
            "days_future": whole_days(F.col("future_end"), F.col("future_start")),
        }
    )


def split_dates(df: DataFrame, column: str = "InvoiceDate", quantile: float = SPLIT_QUANTILE) -> dict[str, int]:
    """The cut-off as plain values: one row is fetched. Needs two distinct dates.

    Instants are microseconds since 1970, free of any session or driver time zone.
    """
    dates = temporal_split(df, column, quantile)
    times = ["historical_start", "historical_end", "future_start", "future_end"]
    row = dates.withColumns({c: F.unix_micros(c) for c in times}).first().asDict()
    if not row["n_dates"]:
        raise ValueError(f"no dates in {column}")
    if row["n_dates"] < 2:
        raise ValueError("a split needs at least two distinct dates")
    return row


def future_target(
    df: DataFrame,
    historical_end: Instant,
    future_start: Instant,
    future_end: Instant,
    filter_sales: bool = True,
    require_rows: bool = False,
) -> DataFrame:
    """1 for each past customer who also buys in the future window, else 0.

    One aggregation answers both questions (bought before? bought in the window?), so neither a set
    of ids nor a join is needed. Customers seen only in the future are left out.
    """
    lines = sales_lines(df) if filter_sales else df.filter(F.col("CustomerID").isNotNull())
    t = F.col("InvoiceDate")
    seen = lines.filter(t.isNotNull()).groupBy("CustomerID").agg(
        F.max(t < instant(historical_end)).alias("past"),
        F.max((t >= instant(future_start)) & (t <= instant(future_end))).alias("future"),
    )
    out = seen.filter("past").select("CustomerID", F.col("future").cast("int").alias(TARGET))
    if require_rows:
        _need_rows(out, "customers before the cut-off")
    return out


def membership_label(ids: DataFrame, members: DataFrame, key: str, name: str = TARGET) -> DataFrame:
    """1 for ids that occur among ``members``, else 0; the join strategy follows the sizes."""
    marked = members.select(F.col(key).alias("_member")).distinct()
    joined = ids.join(marked, F.col(key) == F.col("_member"), "left")
    return joined.withColumn(name, F.col("_member").isNotNull().cast("int")).drop("_member")


def design_matrix(features: DataFrame, target: DataFrame) -> DataFrame:
    """Features and label of each customer."""
    return features.join(target, "CustomerID")


def lost_in_join(features: DataFrame, target: DataFrame) -> int:
    """Feature rows without a label; zero by construction."""
    return features.join(target, "CustomerID", "left_anti").count()


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share (%) of each label."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("percentage", F.col("count") / total * 100)
