"""Business tables by month, hour, weekday, product and country.

Every table is one hash aggregation with partial aggregation before the shuffle, so a key that
holds a large share of the lines costs its mappers one row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.functions.columns import amount_of, is_cancelled, number, percent, safe_divide, year_month
from tillroll.functions.ranks import melt, quantiles, running_totals

NO_TEXT = "(no description)"
LABEL_LENGTH = 60


def _lines() -> Column:
    return F.count("InvoiceNo")


def _invoices() -> Column:
    return F.count_distinct("InvoiceNo")


def _customers() -> Column:
    return F.count_distinct("CustomerID")


def _units() -> Column:
    return F.coalesce(F.sum("Quantity"), F.lit(0))


def _revenue(df: DataFrame) -> Column:
    return F.coalesce(F.sum(amount_of(df)), F.lit(0.0))


def _with_month(df: DataFrame) -> DataFrame:
    return df if "YearMonth" in df.columns else df.withColumn("YearMonth", year_month())


def invoice_monthly_volume(df: DataFrame) -> DataFrame:
    """Distinct invoices, lines and quantity per month; undated lines are left out."""
    dated = _with_month(df).filter(F.col("YearMonth").isNotNull())
    out = dated.groupBy("YearMonth").agg(
        _invoices().alias("invoice_count"), _lines().alias("transaction_count"), _units().alias("total_quantity")
    )
    return out.orderBy("YearMonth")


def monthly_transaction_volume(df: DataFrame) -> DataFrame:
    dated = _with_month(df).filter(F.col("YearMonth").isNotNull())
    out = dated.groupBy("YearMonth").agg(
        _lines().alias("transaction_lines"),
        _invoices().alias("unique_invoices"),
        _customers().alias("unique_customers"),
        _units().alias("total_quantity"),
    )
    return out.orderBy("YearMonth")


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Revenue, mean and median line amount, lines, invoices and revenue per invoice by month."""
    dated = _with_month(sales).withColumn("amount", amount_of(sales)).filter(F.col("YearMonth").isNotNull())
    totals = dated.groupBy("YearMonth").agg(
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("revenue"),
        F.avg("amount").alias("avg_order_value"),
        _lines().alias("lines"),
        _invoices().alias("unique_invoices"),
    )
    middle = quantiles(melt(dated, ["amount"], ["YearMonth"]), {"median_order_value": 0.5}, ["YearMonth"])
    # Both sides hold one row for each calendar month.
    out = totals.join(middle, "YearMonth", "left").withColumn(
        "revenue_per_invoice", safe_divide(F.col("revenue"), F.col("unique_invoices"))
    )
    return out.orderBy("YearMonth")


def best_and_worst(table: DataFrame, key: str, value: str) -> DataFrame:
    """Key and value of the largest and the smallest row; the smallest key wins ties."""
    high = F.min(F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))
    low = F.min(F.struct(F.col(value).alias("v"), F.col(key).alias("k")))
    ends = table.agg(high.alias("high"), low.alias("low"))
    return ends.select(
        F.col("high.k").alias("best"),
        (-F.col("high.v")).alias("best_value"),
        F.col("low.k").alias("worst"),
        F.col("low.v").alias("worst_value"),
    )


def transactions_by_hour(df: DataFrame) -> DataFrame:
    timed = df.withColumn("Hour", F.hour("InvoiceDate")).filter(F.col("Hour").isNotNull())
    return timed.groupBy("Hour").agg(_lines().alias("lines"), _invoices().alias("unique_invoices")).orderBy("Hour")


def transactions_by_weekday(df: DataFrame) -> DataFrame:
    """Lines and invoices per weekday, Monday first."""
    t = F.col("InvoiceDate")
    timed = df.withColumns({"DayOfWeek": F.weekday(t), "DayOfWeekName": F.date_format(t, "EEEE")})
    out = timed.filter(t.isNotNull()).groupBy("DayOfWeek", "DayOfWeekName")
    return out.agg(_lines().alias("lines"), _invoices().alias("unique_invoices")).orderBy("DayOfWeek")


def rows_per_month(df: DataFrame) -> DataFrame:
    dated = _with_month(df).filter(F.col("YearMonth").isNotNull())
    return dated.groupBy("YearMonth").agg(F.count(F.lit(1)).alias("rows")).orderBy("YearMonth")


def cancellation_split(df: DataFrame) -> DataFrame:
    """Lines, and lines with a negative quantity, by cancellation flag."""
    flagged = df.withColumn("IsCancellation", is_cancelled())
    return flagged.groupBy("IsCancellation").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(number(df, "Quantity") < 0).alias("negative_quantity")
    )


def _product_label() -> Column:
    return F.substring(F.coalesce("Description", F.lit(NO_TEXT)), 1, LABEL_LENGTH)


def _product_table(sales: DataFrame) -> DataFrame:
    return sales.groupBy("StockCode", "Description").agg(
        _units().alias("total_quantity"), _lines().alias("lines"), _revenue(sales).alias("revenue")
    )


def _product_order(by: str) -> list[Column]:
    return [F.desc(by), F.asc_nulls_first("StockCode"), F.asc_nulls_first("Description")]


def top_products_by_quantity(sales: DataFrame, top_n: int = 20) -> DataFrame:
    """Best sellers by units; a missing code or text is a product of its own."""
    top = _product_table(sales).orderBy(*_product_order("total_quantity")).limit(top_n)
    return top.withColumn("Description", _product_label())


def top_products_by_revenue(sales: DataFrame, top_n: int = 20) -> DataFrame:
    table = _product_table(sales)
    table = table.withColumn("avg_unit_price", safe_divide(F.col("revenue"), F.col("total_quantity")))
    return table.orderBy(*_product_order("revenue")).limit(top_n).withColumn("Description", _product_label())


def best_products(sales: DataFrame, top_n: int = 10) -> DataFrame:
    """Products with code and text, by revenue, with units and distinct invoices."""
    named = sales.filter(F.col("StockCode").isNotNull() & F.col("Description").isNotNull())
    table = named.groupBy("StockCode", "Description").agg(
        _revenue(sales).alias("revenue"), _units().alias("quantity_sold"), _invoices().alias("transactions")
    )
    return table.orderBy(*_product_order("revenue")).limit(top_n)


def ranking_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Sizes of two top lists, of their intersection and of both differences.

    The lists are top-n tables, so both sides of the join have at most n rows.
    """
    a = left.select(F.col(key).alias("k")).distinct().withColumn("in_left", F.lit(1))
    b = right.select(F.col(key).alias("j")).distinct().withColumn("in_right", F.lit(1))
    both = a.join(b, F.col("k").eqNullSafe(F.col("j")), "full")
    in_left, in_right = F.col("in_left").isNotNull(), F.col("in_right").isNotNull()
    return both.agg(
        F.count_if(in_left).alias("in_first"),
        F.count_if(in_right).alias("in_second"),
        F.count_if(in_left & in_right).alias("in_both"),
        F.count_if(in_left & ~in_right).alias("only_first"),
        F.count_if(~in_left & in_right).alias("only_second"),
    )


def country_distribution(df: DataFrame) -> DataFrame:
    """Rows per country (null included) and share of all rows."""
    table = df.groupBy("Country").agg(F.count(F.lit(1)).alias("transaction_count"))
    return _share(table, "transaction_count", "percentage").orderBy(F.desc("transaction_count"), "Country")


def _share(table: DataFrame, value: str, name: str) -> DataFrame:
    """Share of the table total. The table has one row per country, so one task suffices."""
    return table.withColumn(name, percent(F.col(value), F.sum(value).over(Window.partitionBy(F.lit(0)))))


def top_countries_by_transactions(df: DataFrame, top_n: int | None = None) -> DataFrame:
    table = df.groupBy("Country").agg(
        _lines().alias("lines"),
        _invoices().alias("unique_invoices"),
        _customers().alias("unique_customers"),
        F.count_distinct("StockCode").alias("unique_products"),
        F.count(F.lit(1)).alias("_rows"),
    )
    share = percent(F.col("lines"), F.sum("_rows").over(Window.partitionBy(F.lit(0))))
    out = table.withColumn("lines_pct", share).drop("_rows").orderBy(F.desc("lines"), "Country")
    return out.limit(top_n) if top_n else out


def country_revenue(sales: DataFrame, top_n: int | None = None) -> DataFrame:
    amount = amount_of(sales)
    table = sales.groupBy("Country").agg(
        _revenue(sales).alias("revenue"),
        _lines().alias("lines"),
        F.avg(number(sales, "UnitPrice")).alias("avg_unit_price"),
        F.avg(amount).alias("avg_total_amount"),
        _customers().alias("unique_customers"),
    )
    out = _share(table, "revenue", "revenue_pct").orderBy(F.desc("revenue"), "Country")
    return out.limit(top_n) if top_n else out


def monthly_sales(sales: DataFrame) -> DataFrame:
    """Revenue, distinct invoices, items and customers per month."""
    dated = _with_month(sales).filter(F.col("YearMonth").isNotNull())
    out = dated.groupBy("YearMonth").agg(
        _revenue(sales).alias("revenue"),
        _invoices().alias("transactions"),
        _units().alias("items_sold"),
        _customers().alias("unique_customers"),
    )
    return out.orderBy("YearMonth")


def busiest_countries(sales: DataFrame, top_n: int = 10) -> DataFrame:
    """Named countries by distinct invoices, with revenue and customers."""
    table = (
        sales.filter(F.col("Country").isNotNull())
        .groupBy("Country")
        .agg(_invoices().alias("transactions"), _revenue(sales).alias("revenue"), _customers().alias("unique_customers"))
    )
    return table.orderBy(F.desc("transactions"), "Country").limit(top_n)


def product_revenue(sales: DataFrame) -> DataFrame:
    coded = sales.filter(F.col("StockCode").isNotNull())
    return coded.groupBy("StockCode").agg(_revenue(sales).alias("revenue"))


def revenue_concentration(sales: DataFrame, shares: Sequence[float] = (0.01, 0.10, 0.20)) -> DataFrame:
    """Products and the cumulative revenue share (%) at zero-based index ``int(n * share)``.

    Products are ordered by falling revenue, then code. The 1 % figure needs 100 products.
    """
    ranked = running_totals(
        product_revenue(sales),
        [-F.col("revenue"), F.col("StockCode")],
        {"running": F.col("revenue"), "place": F.lit(1)},
    )
    total = ranked.agg(F.struct(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("n"))).scalar()
    n = F.col("t.n")
    picks = []
    for s in shares:
        at = F.col("place") == F.floor(n * F.lit(s)) + 1
        share = F.max(F.when(at, F.col("running"))) / F.max("t.revenue") * 100
        name = f"top_{round(s * 100)}_pct_share"
        picks.append((F.when(F.max(n) >= 100, share) if s < 0.10 else share).alias(name))
    return ranked.withColumn("t", total).agg(F.count(F.lit(1)).alias("products"), *picks)


def gini(table: DataFrame, value: str = "revenue") -> DataFrame:
    """Gini coefficient of the positive values: one minus twice the area under the Lorenz curve.

    With ascending ranks i the area has the closed form ``2 * sum(i * x) / (n * sum(x)) - (n + 1) / n``;
    equal values share one row, so the running count is all that has to be spread over partitions.
    """
    ties = table.filter(F.col(value) > 0).groupBy(F.col(value).alias("x")).agg(F.count(F.lit(1)).alias("c"))
    ranked = running_totals(ties, [F.col("x")], {"upto": F.col("c")})
    rank_sum = F.col("c") * (F.col("upto") * 2 - F.col("c") + 1) / 2
    sums = ranked.agg(
        F.sum(F.col("x") * rank_sum).alias("weighted"),
        F.sum(F.col("x") * F.col("c")).alias("total"),
        F.sum("c").alias("n"),
    )
    g = 2 * F.col("weighted") / (F.col("n") * F.col("total")) - (F.col("n") + 1) / F.col("n")
    return sums.select(F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") >= 2, g).alias("gini"))
