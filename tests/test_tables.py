import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import outliers, prepare, relations, sales
from tillroll.plans import exploration


@pytest.fixture(scope="module")
def sold(spark):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(500):
        day = 1 + int(rng.integers(28))
        rows.append(
            (f"{i // 3}", f"S{int(rng.integers(5))}", None if i % 50 == 0 else f"text {i % 5}" * 12, int(rng.poisson(5) + 1),
             f"2011-0{1 + i % 9}-{day:02d} {int(rng.integers(24)):02d}:00:00", float(rng.uniform(1, 10)),
             1.0 * (i % 17), ["UK", "DE", None][i % 3])
        )
    df = spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Description string, Quantity long, d string, UnitPrice double, c double, Country string")
    df = df.select("*", F.to_timestamp("d").alias("InvoiceDate"), F.col("c").cast("long").alias("CustomerID")).drop("d", "c")
    return prepare.derive(df).cache()


def test_months_hours_weekdays(sold):
    month = sales.monthly_revenue(sold).collect()
    assert [r.YearMonth for r in month] == sorted(r.YearMonth for r in month) and sum(r.lines for r in month) == 500
    pdf = sold.toPandas()
    want = pdf.groupby("YearMonth")["TotalAmount"].median()
    assert [r.median_order_value for r in month] == pytest.approx(list(want))
    days = sales.transactions_by_weekday(sold).collect()
    assert [r.DayOfWeekName for r in days][:2] == ["Monday", "Tuesday"] and sum(r.lines for r in days) == 500
    assert sum(r.lines for r in sales.transactions_by_hour(sold).collect()) == 500
    best = sales.best_and_worst(sales.monthly_sales(sold), "YearMonth", "revenue").first()
    assert best.best == max(month, key=lambda r: r.revenue).YearMonth


def test_products_keep_or_drop_missing_text(sold):
    top = sales.top_products_by_quantity(sold, 100)
    assert top.filter(F.col("Description") == sales.NO_TEXT).count() > 0
    assert top.agg(F.max(F.length("Description"))).first()[0] == 60
    assert sales.best_products(sold, 100).filter("Description IS NULL").count() == 0
    assert sales.top_products_by_revenue(sold, 3).count() == 3


def test_countries(sold):
    rows = sales.top_countries_by_transactions(sold).collect()
    assert sum(r.lines_pct for r in rows) == pytest.approx(100) and None in [r.Country for r in rows]
    assert None not in [r.Country for r in sales.busiest_countries(sold).collect()]
    assert sum(r.revenue_pct for r in sales.country_revenue(sold).collect()) == pytest.approx(100)
    both = exploration.country_overlap(sold, sold, 2).first()
    assert both.in_first == both.in_both + both.only_first and both.in_second == both.in_both + both.only_second


def test_gini_and_concentration(spark):
    equal = spark.createDataFrame([(str(i), 5.0) for i in range(20)], "StockCode string, revenue double")
    assert sales.gini(equal).first().gini == pytest.approx(0.0)
    values = [1.0, 1.0, 2.0, 3.0, 10.0, -4.0]
    some = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "StockCode string, revenue double")
    y = np.sort([v for v in values if v > 0])
    lorenz = np.concatenate([[0], np.cumsum(y) / y.sum()])
    area = ((lorenz[1:] + lorenz[:-1]) / 2 / len(y)).sum()
    assert sales.gini(some).first().gini == pytest.approx(1 - 2 * area)
    lines = spark.createDataFrame([(f"P{i}", 1, float(i + 1)) for i in range(100)], "StockCode string, Quantity long, UnitPrice double")
    got = sales.revenue_concentration(lines).first()
    assert got.products == 100 and got.top_1_pct_share == pytest.approx((100 + 99) / 50.5)
    assert sales.revenue_concentration(lines.limit(50)).first().top_1_pct_share is None


def test_iqr_on_one_to_ten(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    row = outliers.iqr_bounds(df, ["x"]).first()
    assert (row.q1, row.q3, row.lower_bound, row.upper_bound) == (3.25, 7.75, -3.5, 14.5)
    assert (row.median, row["mean"], row["min"], row["max"], row.n) == (5.5, 5.5, 1.0, 10.0, 10)


def test_extremes_are_flagged(spark):
    rng = np.random.default_rng(42)
    values = [float(v) for v in rng.normal(10, 2, 1000)] + [100.0, -999.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    flagged = outliers.flag_iqr_outliers(df, ["x"])
    assert flagged.filter("x = 100").first().x_IsOutlier is True
    assert flagged.filter("x = -999").first().x_IsOutlier is False
    assert flagged.filter("x IS NULL").first().x_IsOutlier is False
    assert outliers.flag_iqr_outliers(df, ["x"], positive_only=False).filter("x = -999").first().x_IsOutlier is True
    every = outliers.outlier_summary(df, ["x"]).first()
    positive = outliers.outlier_summary(df, ["x"], pct_base="positive").first()
    assert every.outlier_count == positive.outlier_count and every.outlier_pct < positive.outlier_pct
    impact = {r.subset: r for r in outliers.outlier_impact(flagged, "x").collect()}
    assert impact["With outliers"]["count"] == 1002 and impact["Without outliers"]["max"] < 100


def test_tail_histogram_box(sold):
    row = {r.column: r for r in outliers.heavy_tail(sold).collect()}["TotalAmount"]
    values = sold.select("TotalAmount").toPandas()["TotalAmount"]
    assert row.P99_9 == pytest.approx(values.quantile(0.999)) and row.P99 == pytest.approx(values.quantile(0.99))
    bins = outliers.histogram(sold, "TotalAmount", 50).orderBy("bin").collect()
    want, edges = np.histogram(values, 50)
    assert [r["count"] for r in bins] == list(want) and bins[-1].bin_high == pytest.approx(edges[-1])
    assert outliers.histogram(sold, "TotalAmount", 10, log=True).agg(F.sum("count")).first()[0] == 500
    box = {r.column: r for r in outliers.box_stats(sold).collect()}["Quantity"]
    assert box["min"] <= box.whisker_low <= box.q1 <= box.median <= box.q3 <= box.whisker_high <= box["max"]


def test_extreme_rows_and_examples(sold):
    top = outliers.extreme_values(sold, "TotalAmount", 3).collect()
    assert [r.TotalAmount for r in top] == sorted((r.TotalAmount for r in sold.collect()), reverse=True)[:3]
    assert outliers.extreme_values(sold, "Quantity", 2, largest=False).first().Quantity == 1
    examples = outliers.anomaly_examples(sold, sold)
    assert set(examples) == {"largest_quantity", "highest_totalamount", "cancellation_examples", "zero_or_negative_price"}
    assert examples["cancellation_examples"].count() == 0


def test_correlations(sold):
    pdf = sold.select("Quantity", "UnitPrice", "TotalAmount").toPandas()
    got = {(r.col1, r.col2): r.correlation for r in relations.correlation_matrix(sold).collect()}
    assert len(got) == 9 and got["Quantity", "Quantity"] == pytest.approx(1)
    assert got["UnitPrice", "Quantity"] == pytest.approx(pdf["UnitPrice"].corr(pdf["Quantity"]))
    rho = {(r.col1, r.col2): r.correlation for r in relations.spearman(sold).collect()}
    assert rho["Quantity", "TotalAmount"] == pytest.approx(pdf["Quantity"].rank().corr(pdf["TotalAmount"].rank()))
    study = relations.pair_study(sold, "Quantity", "TotalAmount", 100).first()
    assert study.sample_rows == 100 and study.x_p99 == pytest.approx(pdf["Quantity"].quantile(0.99))
    assert relations.scatter_sample(sold, "Quantity", "TotalAmount", 100).count() == 100
    clipped = relations.clip_p99(sold, "Quantity", "TotalAmount")
    keep = pdf[(pdf.Quantity <= pdf.Quantity.quantile(0.99)) & (pdf.TotalAmount <= pdf.TotalAmount.quantile(0.99))]
    line = relations.regression_line(clipped, "Quantity", "TotalAmount").first()
    slope, intercept = np.polyfit(keep.Quantity, keep.TotalAmount, 1)
    assert line.n == len(keep) and line.slope == pytest.approx(slope) and line.intercept == pytest.approx(intercept)


def test_scatter_sample_draws_copies_like_other_rows(spark):
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN 1.0 ELSE CAST(id AS DOUBLE) + 2 END AS x", "CASE WHEN id % 2 = 0 THEN 1.0 ELSE 5.0 END AS y")
    for seed in (42, 43, 44):
        got = relations.scatter_sample(rows, "x", "y", 1000, seed)
        assert got.count() == 1000
        assert 420 < got.filter("x = 1").count() < 580
    assert relations.scatter_sample(rows, "x", "y").count() == 20_000
