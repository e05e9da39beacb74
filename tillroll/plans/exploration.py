"""Whole studies: each returns its result tables by name, still lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.operators import explore, outliers, relations, sales, validate
from tillroll.operators.prepare import prepare_all
from tillroll.schema import MEASURES, TEXT_COLUMNS, present


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """Overview, types, summaries, gaps, duplicates, countries, months and end rows of a raw table."""
    return {
        "overview": explore.overview_rows(df),
        "data_types": validate.data_types(df),
        "numeric_summary": explore.numeric_summary(df),
        "categorical_summary": explore.categorical_summary(df),
        "missing_values": validate.missing_values(df, digits=4),
        "duplicates": validate.duplicate_count(df),
        "duplicate_examples": validate.duplicate_examples(df),
        "country_distribution": sales.country_distribution(df),
        "monthly_volume": sales.invoice_monthly_volume(df),
        "head": explore.head_rows(df),
        "tail": explore.tail_rows(df),
    }


def descriptive(full: DataFrame, positive: DataFrame) -> dict[str, DataFrame]:
    return {
        "overview": explore.overview_rows(full),
        "frequencies": explore.categorical_frequencies(full, present(full, TEXT_COLUMNS)),
        "amount_stats": explore.amount_stats(positive),
        "numeric_summary": explore.numeric_summary(positive, MEASURES),
        "numeric_summary_extended": explore.numeric_summary(positive, MEASURES, extended=True),
    }


def temporal(full: DataFrame, positive: DataFrame) -> dict[str, DataFrame]:
    revenue = sales.monthly_revenue(positive)
    hours = sales.transactions_by_hour(full)
    return {
        "monthly_volume": sales.monthly_transaction_volume(full),
        "monthly_revenue": revenue,
        "best_month": sales.best_and_worst(revenue, "YearMonth", "revenue"),
        "hourly": hours,
        "peak_hour": sales.best_and_worst(hours, "Hour", "lines"),
        "weekday": sales.transactions_by_weekday(full),
    }


def product(positive: DataFrame) -> dict[str, DataFrame]:
    units = sales.top_products_by_quantity(positive, 20)
    revenue = sales.top_products_by_revenue(positive, 20)
    return {
        "top_quantity": units,
        "top_revenue": revenue,
        "ranking_comparison": product_overlap(positive, 10),
        "revenue_concentration": sales.revenue_concentration(positive),
        "gini": sales.gini(sales.product_revenue(positive)),
    }


def product_overlap(positive: DataFrame, top_n: int = 10) -> DataFrame:
    return sales.ranking_overlap(
        sales.top_products_by_quantity(positive, top_n), sales.top_products_by_revenue(positive, top_n), "StockCode"
    )


def geographic(full: DataFrame, positive: DataFrame, top_n: int = 40) -> dict[str, DataFrame]:
    return {
        "country_transactions": sales.top_countries_by_transactions(full, top_n),
        "country_revenue": sales.country_revenue(positive, top_n),
        "ranking_comparison": country_overlap(full, positive, 10),
    }


def country_overlap(full: DataFrame, positive: DataFrame, top_n: int = 10) -> DataFrame:
    return sales.ranking_overlap(
        sales.top_countries_by_transactions(full, top_n), sales.country_revenue(positive, top_n), "Country"
    )


def relationship(positive: DataFrame) -> dict[str, DataFrame]:
    return {
        "correlation_matrix": relations.correlation_matrix(positive),
        "quantity_vs_amount": relations.pair_study(positive, "Quantity", "TotalAmount"),
        "price_vs_quantity": relations.pair_study(positive, "UnitPrice", "Quantity"),
    }


def anomaly(full: DataFrame, positive: DataFrame) -> dict[str, DataFrame]:
    return {
        "iqr_summary": outliers.outlier_summary(positive, pct_base="positive"),
        "heavy_tail": outliers.heavy_tail(positive),
        **outliers.anomaly_examples(full, positive),
    }


def explore_raw(df: DataFrame) -> dict[str, dict[str, DataFrame]]:
    """All studies of a raw table, from its nested row sets."""
    sets = prepare_all(df)
    full, positive = sets["full"], sets["positive_sales"]
    return {
        "descriptive": descriptive(full, positive),
        "temporal": temporal(full, positive),
        "product": product(positive),
        "geographic": geographic(full, positive),
        "relationship": relationship(positive),
        "anomaly": anomaly(full, positive),
    }


def short_summary(clean: DataFrame, positive: DataFrame) -> dict[str, DataFrame]:
    """Seven summary tables of cleaned lines and customer sales."""
    return {
        "overview": explore.overview_rows(clean, positive),
        "missingness": validate.missing_values(clean),
        "monthly_volume": sales.monthly_sales(positive),
        "top10_products_by_revenue": sales.best_products(positive),
        "top10_countries_by_transactions": sales.busiest_countries(positive),
        "numeric_correlation_matrix": relations.correlation_matrix(positive),
        "numeric_summaries": explore.numeric_summary(positive, MEASURES),
    }
