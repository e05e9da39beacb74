from datetime import datetime

import pytest

from tillroll.operators import explore, validate


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_counts_of_gaps_duplicates_and_values(dirty):
    missing = by(validate.missing_values(dirty, digits=2), "column")
    assert missing["CustomerID"].missing_count == 1 and missing["CustomerID"].missing_pct == 16.67
    assert missing["Country"].non_missing_count == 5
    assert tuple(validate.duplicate_count(dirty).first())[:3] == (6, 5, 1)
    assert by(validate.unique_values(dirty), "column")["InvoiceNo"].unique_count == 5
    assert by(validate.unique_values(dirty, approx=True), "column")["Country"].unique_count == 2
    examples = validate.duplicate_examples(dirty).collect()
    assert len(examples) == 2 and {r.InvoiceNo for r in examples} == {"1001"}


def test_types(dirty):
    rows = validate.data_types(dirty).collect()
    assert [r.column for r in rows] == dirty.columns
    assert rows[3].dtype == "bigint" and rows[2].non_null_count == 5


def test_signs(dirty):
    signs = by(validate.sign_counts(dirty), "column")
    assert tuple(signs["Quantity"])[1:] == (1, 1, 4)
    assert tuple(signs["UnitPrice"])[1:] == (1, 1, 4)


def test_unparseable_values_are_counted(spark):
    df = spark.createDataFrame([("1", "2011-01-01"), ("x", "no"), (None, None)], "Quantity string, InvoiceDate string")
    assert validate.invalid_numeric(df).first().non_numeric_count == 1
    dates = validate.date_parsing(df).first()
    assert dates.unparseable_count == 1 and dates.min_date == datetime(2011, 1, 1)


def test_suspicious_invoices_and_blanks(spark):
    df = spark.createDataFrame([("C12",), ("12",), ("A12",), (" ",), (None,), ("nan",)], "InvoiceNo string")
    assert tuple(validate.suspicious_invoices(df).first()) == (1, 3, 1)
    assert validate.blank_strings(df).first().blank_count == 3


def test_quality_summary(dirty):
    got = {r.metric: r.value for r in validate.quality_summary(dirty).collect()}
    assert len(got) == 10
    assert got["exact_duplicates"] == 1 and got["price_not_positive_count"] == 2 and got["cancellation_lines"] == 1


def test_full_validation_parts(dirty):
    assert len(validate.full_validation(dirty)) == 11


def test_numeric_summary(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    row = explore.numeric_summary(df, extended=True).first()
    assert (row["count"], row["mean"], row.q1, row.median, row.q3) == (10, 5.5, 3.25, 5.5, 7.75)
    assert row["std"] == pytest.approx(3.0276503540974917)
    assert row.skewness == pytest.approx(0.0) and row.kurtosis == pytest.approx(-1.2)


def test_nan_and_null_do_not_count(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    row = explore.numeric_summary(df).first()
    assert row["count"] == 2 and row["max"] == 3.0
    assert validate.missing_values(df).first().missing_count == 2


def test_categories_keep_null_and_sum_up(dirty):
    rows = explore.categorical_frequencies(dirty, ["Country"]).orderBy("cumulative_percentage").collect()
    assert [r["count"] for r in rows] == [3, 2, 1]
    assert rows[-1].value is None and rows[-1].cumulative_percentage == pytest.approx(100, abs=0.01)
    top = explore.categorical_summary(dirty, 1).collect()
    assert {r.column for r in top} == {"InvoiceNo", "StockCode", "Description", "Country"}


def test_head_and_tail_follow_the_stated_order(dirty):
    assert [r.InvoiceNo for r in explore.head_rows(dirty, 2, ["InvoiceNo"]).collect()] == ["1001", "1001"]
    assert explore.tail_rows(dirty, 1, ["InvoiceNo"]).first().InvoiceNo == "C1002"


def test_overview(dirty):
    row = explore.dataset_overview(dirty).first()
    assert (row.rows, row.n_invoices, row.n_customers, row.n_countries) == (6, 5, 2, 2)
    assert {r.metric for r in explore.overview_rows(dirty).collect()} >= {"rows", "total_revenue"}
