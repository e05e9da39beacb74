"""Checks and audit tables. Counts over one table share a single aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.columns import is_cancelled, number, percent, records, row_count, stripped, to_time
from tillroll.schema import (
    BASE_COLUMNS,
    BLANK_TEXTS,
    DATE_COLUMNS,
    NULL_INVOICE_TEXTS,
    NUMERIC_COLUMNS,
    TEXT_COLUMNS,
    check_columns,
    present,
)


def is_missing(df: DataFrame, name: str) -> Column:
    null = F.col(name).isNull()
    return null | F.isnan(name) if dict(df.dtypes)[name] in ("double", "float") else null


def data_types(df: DataFrame) -> DataFrame:
    """Column, type and non-null count, in column order."""
    filled = df.agg(*[F.count_if(~is_missing(df, c)).alias(c) for c in df.columns])
    rows = [
        {"position": F.lit(i), "column": F.lit(c), "dtype": F.lit(t), "non_null_count": F.col(c)}
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return records(filled, rows).orderBy("position")


def missing_values(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Missing count and share of each column, most affected first."""
    gaps = [F.count_if(is_missing(df, c)).alias(c) for c in df.columns]
    counts = df.agg(row_count().alias("_rows"), *gaps)

    def share(c: str) -> Column:
        p = percent(F.col(c), F.col("_rows"))
        return p if digits is None else F.bround(p, digits)

    rows = [
        {
            "column": F.lit(c),
            "missing_count": F.col(c),
            "missing_pct": share(c),
            "non_missing_count": F.col("_rows") - F.col(c),
        }
        for c in df.columns
    ]
    return records(counts, rows).orderBy(F.desc("missing_count"), "column")


def line_groups(df: DataFrame) -> DataFrame:
    """Each distinct row with its number of copies. Copies collapse before the shuffle."""
    return df.groupBy(*df.columns).agg(row_count().alias("copies"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows, repeats of an earlier row, and their share."""
    totals = line_groups(df).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"), row_count().alias("distinct_rows"))
    repeats = F.col("rows") - F.col("distinct_rows")
    return totals.select("rows", "distinct_rows", repeats.alias("duplicates"), percent(repeats, F.col("rows")).alias("duplicate_pct"))


def duplicate_examples(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, in the order of all columns, among rows that occur more than once."""
    order = [F.asc_nulls_last(c) for c in df.columns]
    groups = line_groups(df).filter("copies > 1").orderBy(*order).limit(n)
    shown = F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(n)).cast("int"))
    return groups.select(*df.columns, F.explode(shown).alias("copy")).orderBy(*order, "copy").limit(n)


def unique_values(df: DataFrame, approx: bool = False, digits: int | None = None) -> DataFrame:
    """Distinct non-null values of each column and their share of the rows."""
    count = F.approx_count_distinct if approx else F.count_distinct
    counts = df.agg(row_count().alias("_rows"), *[count(F.col(c)).alias(c) for c in df.columns])

    def share(c: str) -> Column:
        p = percent(F.col(c), F.col("_rows"))
        return p if digits is None else F.bround(p, digits)

    rows = [{"column": F.lit(c), "unique_count": F.col(c), "unique_pct": share(c)} for c in df.columns]
    return records(counts, rows)


def invalid_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Per column: values that are no number, and the numbers' signs."""
    names = present(df, columns)
    aggs = []
    for c in names:
        x = number(df, c)
        aggs += [
            F.count_if(x.isNull() & ~is_missing(df, c)).alias(f"{c}_bad"),
            F.count_if(x < 0).alias(f"{c}_neg"),
            F.count_if(x == 0).alias(f"{c}_zero"),
            F.count_if(x > 0).alias(f"{c}_pos"),
        ]
    rows = [
        {
            "column": F.lit(c),
            "non_numeric_count": F.col(f"{c}_bad"),
            "negative_count": F.col(f"{c}_neg"),
            "zero_count": F.col(f"{c}_zero"),
            "positive_count": F.col(f"{c}_pos"),
        }
        for c in names
    ]
    return records(df.agg(*aggs), rows)


def sign_counts(df: DataFrame, columns: Sequence[str] = ("Quantity", "UnitPrice")) -> DataFrame:
    return invalid_numeric(df, columns).drop("non_numeric_count")


def date_parsing(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Per column: values that do not parse as a timestamp, earliest and latest value."""
    names = present(df, columns)
    types = dict(df.dtypes)
    aggs = []
    for c in names:
        t = F.col(c) if types[c] == "timestamp" else to_time(c)
        aggs += [
            F.count_if(t.isNull() & F.col(c).isNotNull()).alias(f"{c}_bad"),
            F.min(t).alias(f"{c}_min"),
            F.max(t).alias(f"{c}_max"),
        ]
    rows = [
        {
            "column": F.lit(c),
            "unparseable_count": F.col(f"{c}_bad"),
            "min_date": F.col(f"{c}_min"),
            "max_date": F.col(f"{c}_max"),
        }
        for c in names
    ]
    return records(df.agg(*aggs), rows)


def suspicious_invoices(df: DataFrame, column: str = "InvoiceNo") -> DataFrame:
    """Cancellations, empty numbers, and numbers that are not digits behind an optional prefix."""
    text = F.col(column).cast("string")
    empty = text.isNull() | stripped(column).isin(NULL_INVOICE_TEXTS)
    return df.agg(
        F.count_if(is_cancelled(column)).alias("cancellation_invoices"),
        F.count_if(empty).alias("empty_invoice_numbers"),
        F.count_if(~empty & ~text.rlike("^C?[0-9]+$")).alias("non_standard_invoice_format"),
    )


def blank_strings(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Null, empty or null-like texts of each column."""
    names = present(df, columns)
    blanks = df.agg(*[F.count_if(F.col(c).isNull() | stripped(c).isin(BLANK_TEXTS)).alias(c) for c in names])
    return records(blanks, [{"column": F.lit(c), "blank_count": F.col(c)} for c in names])


def entity_counts(df: DataFrame) -> DataFrame:
    """Distinct invoices, customers, products and countries."""
    return df.agg(
        F.count_distinct("InvoiceNo").alias("n_invoices"),
        F.count_distinct("CustomerID").alias("n_customers"),
        F.count_distinct("StockCode").alias("n_products"),
        F.count_distinct("Country").alias("n_countries"),
    )


def quality_summary(df: DataFrame) -> DataFrame:
    """Ten headline quality figures as metric and value, from one grouping of the table."""
    check_columns(df)
    copies, qty, price = F.col("copies"), number(df, "Quantity"), number(df, "UnitPrice")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0))

    # Value columns behind the grouping keep their names, so the conditions read as before.
    facts = line_groups(df.select(*BASE_COLUMNS)).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        row_count().alias("distinct_rows"),
        rows_where(F.col("CustomerID").isNull()).alias("no_customer"),
        rows_where(F.col("Description").isNull()).alias("no_text"),
        rows_where(qty < 0).alias("negative_quantity"),
        rows_where(price <= 0).alias("bad_price"),
        rows_where(is_cancelled()).alias("cancelled"),
    )
    total = F.col("rows")
    values = {
        "total_rows": total,
        "total_columns": F.lit(len(df.columns)),
        "exact_duplicates": total - F.col("distinct_rows"),
        "missing_customer_count": F.col("no_customer"),
        "missing_customer_pct": percent(F.col("no_customer"), total),
        "missing_description_count": F.col("no_text"),
        "missing_description_pct": percent(F.col("no_text"), total),
        "negative_quantity_count": F.col("negative_quantity"),
        "price_not_positive_count": F.col("bad_price"),
        "cancellation_lines": F.col("cancelled"),
    }
    return records(facts, [{"metric": F.lit(k), "value": v.cast("double")} for k, v in values.items()])


def full_validation(df: DataFrame) -> dict[str, DataFrame]:
    from tillroll.sources.transactions import shape_table

    return {
        "shape": shape_table(df),
        "data_types": data_types(df),
        "missing_values": missing_values(df, digits=2),
        "duplicates": duplicate_count(df),
        "unique_values": unique_values(df, digits=2),
        "invalid_numeric": invalid_numeric(df),
        "date_parsing": date_parsing(df),
        "sign_counts": sign_counts(df),
        "suspicious_invoices": suspicious_invoices(df),
        "blank_strings": blank_strings(df),
        "entity_counts": entity_counts(df),
    }
