from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillroll.operators import cleaning, prepare
from tillroll.schema import BASE_COLUMNS, MissingColumnsError, check_columns


def test_duplicates_go_and_nulls_are_equal(spark, dirty):
    assert prepare.drop_duplicate_lines(dirty).count() == 5
    nulls = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, v int")
    assert prepare.drop_duplicate_lines(nulls).count() == 2


def test_flags_are_two_valued(spark, dirty):
    flagged = prepare.flag_prices(prepare.flag_quantities(prepare.flag_cancellations(dirty)))
    row = flagged.agg(
        *[F.count_if(c).alias(c) for c in ("IsCancellation", "IsNegativeQuantity", "IsZeroQuantity", "IsNegativePrice", "IsZeroPrice")]
    ).first()
    assert tuple(row) == (1, 1, 1, 1, 1)
    gaps = spark.createDataFrame([(None, None, None)], "InvoiceNo string, Quantity long, UnitPrice double")
    got = prepare.flag_prices(prepare.flag_quantities(prepare.flag_cancellations(gaps))).first()
    assert got.IsCancellation is False and got.IsNegativeQuantity is False and got.IsZeroPrice is False


def test_positive_quantity_ignores_the_price(dirty):
    assert prepare.positive_quantity_sales(dirty).count() == 4
    assert prepare.valid_price(dirty).count() == 4


def test_row_sets_are_nested(dirty):
    sets = prepare.row_sets(dirty)
    assert [sets[k].count() for k in ("full", "valid_price", "positive_sales")] == [5, 3, 1]
    assert {"TotalAmount", "DayOfWeekName", "YearMonth", "Date", "IsCancellation"} <= set(sets["full"].columns)
    assert set(prepare.prepare_all(dirty)) == {"engineered", "full", "valid_price", "positive_sales"}


def test_time_parts(spark):
    df = spark.createDataFrame([(datetime(2011, 1, 3, 10, 15),), (None,)], "InvoiceDate timestamp")
    row, empty = prepare.add_time_parts(df).collect()
    assert (row.Year, row.Month, row.Day, row.Hour, row.DayOfWeek) == (2011, 1, 3, 10, 0)
    assert (row.DayOfWeekName, row.YearMonth, str(row.Date)) == ("Monday", "2011-01", "2011-01-03")
    assert empty.YearMonth is None
    assert "DOWName" in prepare.add_time_parts(df, dow="DOW").columns


def test_coercion_turns_bad_values_into_null(spark):
    df = spark.createDataFrame([("1", "2011-02-01 10:00", " a\t"), ("x", "bad-date", None), (None, "1/3/2011 8:05", "b\n")], "a string, d string, s string")
    assert [r.a for r in prepare.ensure_numeric(df, ["a", "absent"]).collect()] == [1.0, None, None]
    assert [r.d for r in prepare.ensure_datetime(df, ["d"]).collect()] == [datetime(2011, 2, 1, 10), None, datetime(2011, 1, 3, 8, 5)]
    assert [r.s for r in prepare.ensure_string(df, ["s"]).collect()] == ["a", None, "b"]


def test_clean_dataset_keeps_known_customers(dirty):
    clean, sales = prepare.clean_dataset(dirty)
    assert clean.count() == 5 and sales.count() == 1
    assert "DOWName" in clean.columns
    assert prepare.sales_lines(dirty).count() == 2  # the repeated line twice


def test_history_is_strictly_before_the_cut(spark):
    df = spark.createDataFrame([(datetime(2011, 1, d),) for d in (1, 2, 3)], "InvoiceDate timestamp")
    assert prepare.before(df, datetime(2011, 1, 2)).count() == 1
    assert tuple(prepare.leak_counts(df, datetime(2011, 1, 2)).first()) == (1, 2)


def test_log1p_and_missing_columns(spark, dirty):
    df = spark.createDataFrame([(0, 1, 9.0)], "Recency long, Frequency long, Monetary double")
    row = prepare.add_log1p(df).first()
    assert row.Log_Recency == 0 and row.Log_Monetary == pytest.approx(2.302585, abs=1e-6)
    with pytest.raises(MissingColumnsError):
        prepare.add_log1p(df, ["Nope"])
    with pytest.raises(MissingColumnsError):
        check_columns(dirty.drop("Country"))
    assert check_columns(dirty.withColumn("Extra", F.lit(1))) == (True, ["Extra"])


def test_cleaning_log_matches_the_sets(dirty):
    log = {r.step_no: r for r in cleaning.cleaning_log(dirty).collect()}
    assert (log[1].rows_before, log[1].rows_removed, log[1].rows_after) == (6, 1, 5)
    assert (log[5].rows_before, log[5].rows_after) == (5, 3)
    assert log[7].rows_after == 1
    sets = cleaning.cleaned_sets(dirty)
    assert [sets[k].count() for k in ("flagged", "cleaned", "positive_sales")] == [5, 3, 1]


def test_decisions_and_before_after(dirty):
    table = {r.issue: r for r in cleaning.cleaning_decisions(dirty).collect()}
    assert len(table) == 7
    assert table["Exact duplicate rows"]["count"] == 1
    assert table["UnitPrice <= 0"]["count"] == 2
    assert table["Missing Description"]["count"] == 1
    assert table["Not in positive sales"]["count"] == 2
    assert table["Not in positive sales"].of_which_not_cancelled == 1
    sets = cleaning.cleaned_sets(dirty)
    rows = {r.dataset: r for r in cleaning.before_after(dirty, sets["cleaned"], sets["positive_sales"]).collect()}
    raw = rows["Raw dataset"]
    assert (raw.row_count, raw.column_count, raw.duplicate_rows, raw.cancellations) == (6, len(BASE_COLUMNS), 1, 1)
    assert raw.total_missing == 3 and raw.amount_median == 0.0
    assert rows["Positive-sales analytical"].amount_sum == 10.0


def test_empty_input_has_empty_results(spark, dirty):
    none = dirty.limit(0)
    assert prepare.row_sets(none)["full"].count() == 0
    assert cleaning.cleaning_log(none).agg(F.sum("rows_after")).first()[0] == 0


def test_before_after_from_numbered_lines(dirty):
    """One grouping of the raw lines gives the figures of all three sets: no later shuffle goes by the base columns."""
    from tillroll.functions.ranks import numbered_copies
    from tillroll.session import written

    plain = cleaning.cleaned_sets(dirty)
    lines = written(numbered_copies(dirty, "copy"))
    sets = cleaning.cleaned_sets(lines, "copy")
    got = cleaning.before_after(lines, sets["cleaned"], sets["positive_sales"], "copy")
    want = cleaning.before_after(dirty, plain["cleaned"], plain["positive_sales"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "InvoiceNo" not in [c for line in got._jdf.queryExecution().toString().splitlines() if "hashpartitioning" in line for c in line.split("#")]
