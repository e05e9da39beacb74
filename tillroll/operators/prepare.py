"""Coercions, derived columns, filters and duplicate removal on invoice lines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.columns import holds, is_cancelled, line_amount, number, records, stripped, to_number, to_time, year_month
from tillroll.schema import RFM_COLUMNS, check_columns, present

Instant = Column | datetime | int | str


def ensure_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as numbers, unparseable values as null; absent names are skipped."""
    return df.withColumns({c: to_number(c) for c in present(df, columns)})


def ensure_datetime(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    typed = [c for c in present(df, columns) if types[c] != "timestamp"]
    return df.withColumns({c: to_time(c) for c in typed}) if typed else df


def ensure_string(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as text without outer white space; null stays null."""
    return df.withColumns({c: stripped(c) for c in present(df, columns)})


def add_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("TotalAmount", line_amount(df))


def add_time_parts(df: DataFrame, column: str = "InvoiceDate", dow: str = "DayOfWeek", names: bool = True) -> DataFrame:
    """Calendar columns of a timestamp; weekdays count from Monday = 0. Null dates give nulls."""
    t = F.col(column)
    parts = {
        "Year": F.year(t),
        "Month": F.month(t),
        "Day": F.dayofmonth(t),
        "Hour": F.hour(t),
        dow: F.weekday(t),
        "YearMonth": year_month(t),
    }
    if names:
        parts[f"{dow}Name"] = F.date_format(t, "EEEE")
        parts["Date"] = F.to_date(t)
    return df.withColumns(parts)


def flag_cancellations(df: DataFrame) -> DataFrame:
    return df.withColumn("IsCancellation", is_cancelled())


def flag_quantities(df: DataFrame) -> DataFrame:
    q = number(df, "Quantity")
    return df.withColumns({"IsNegativeQuantity": holds(q < 0), "IsZeroQuantity": holds(q == 0)})


def flag_prices(df: DataFrame) -> DataFrame:
    p = number(df, "UnitPrice")
    return df.withColumns({"IsNegativePrice": holds(p < 0), "IsZeroPrice": holds(p == 0)})


def drop_duplicate_lines(df: DataFrame) -> DataFrame:
    """Keep one of each group of rows equal in all columns, nulls equal.

    Planned as an aggregation on all columns, so copies collapse before the shuffle.
    """
    return df.dropDuplicates()


def valid_price(df: DataFrame) -> DataFrame:
    return df.filter(number(df, "UnitPrice") > 0)


def _cancelled(df: DataFrame) -> Column:
    return F.col("IsCancellation") if "IsCancellation" in df.columns else is_cancelled()


def positive_quantity_sales(df: DataFrame) -> DataFrame:
    """Lines that are no cancellation and have a positive quantity. The price is not tested."""
    return df.filter(~_cancelled(df) & (number(df, "Quantity") > 0))


def with_customer(df: DataFrame) -> DataFrame:
    return df.filter(F.col("CustomerID").isNotNull())


def sales_lines(df: DataFrame) -> DataFrame:
    """Sales of known customers in a single filter: not cancelled, quantity and price positive."""
    positive = (number(df, "Quantity") > 0) & (number(df, "UnitPrice") > 0)
    return df.filter(~is_cancelled() & positive & F.col("CustomerID").isNotNull())


def before(df: DataFrame, end: Instant, column: str = "InvoiceDate") -> DataFrame:
    """Rows strictly earlier than the cut-off."""
    return df.filter(F.col(column) < instant(end))


def leak_counts(df: DataFrame, end: Instant, column: str = "InvoiceDate") -> DataFrame:
    """How many dated rows the cut-off keeps and how many it drops."""
    t = F.col(column)
    return df.agg(
        F.count_if(t < instant(end)).alias("kept_rows"),
        F.count_if(t >= instant(end)).alias("dropped_rows"),
    )


def instant(t: Instant) -> Column:
    """A column as it is, a number as microseconds since 1970, a datetime or text as a timestamp."""
    if isinstance(t, Column):
        return t
    return F.timestamp_micros(F.lit(t)) if isinstance(t, int) else F.lit(t).cast("timestamp")


def derive(df: DataFrame, dow: str = "DayOfWeek") -> DataFrame:
    """Amount, calendar and cancellation columns in one projection."""
    return flag_cancellations(add_time_parts(add_amount(df), dow=dow))


def row_sets(df: DataFrame, dow: str = "DayOfWeek") -> dict[str, DataFrame]:
    """The nested row sets: ``full`` (one of each line), ``valid_price`` and ``positive_sales``.

    Duplicates go first, on the narrow base columns; derived columns depend only on those, so the
    result is the same as deriving before and the shuffle is smaller.
    """
    check_columns(df)
    full = derive(drop_duplicate_lines(df), dow)
    priced = valid_price(full)
    return {"full": full, "valid_price": priced, "positive_sales": positive_quantity_sales(priced)}


def prepare_all(df: DataFrame, dow: str = "DayOfWeek") -> dict[str, DataFrame]:
    sets = row_sets(df, dow)
    return {"engineered": sets["full"], **sets}


def clean_dataset(df: DataFrame, dow: str = "DOW") -> tuple[DataFrame, DataFrame]:
    """All distinct lines with derived columns, and the sales among them with a known customer."""
    sets = row_sets(df, dow)
    return sets["full"], with_customer(sets["positive_sales"])


def add_log1p(df: DataFrame, columns: Sequence[str] = RFM_COLUMNS) -> DataFrame:
    check_columns(df, columns)
    return df.withColumns({f"Log_{c}": F.log1p(F.col(c).cast("double")) for c in columns})


def row_set_counts(df: DataFrame, names: Sequence[str] = ("full", "valid_price", "positive_sales")) -> DataFrame:
    """Rows of the three nested sets as a small table: each distinct line is counted under all sets it is in."""
    check_columns(df)
    priced = holds(number(df, "UnitPrice") > 0)
    sold = priced & holds(~_cancelled(df)) & holds(number(df, "Quantity") > 0)
    n = drop_duplicate_lines(df).agg(F.count(F.lit(1)).alias("a"), F.count_if(priced).alias("b"), F.count_if(sold).alias("c"))
    return records(n, [{"dataset": F.lit(name), "rows": F.col(c)} for name, c in zip(names, "abc")])
