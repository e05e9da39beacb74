from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillroll.operators import customers, prepare
from tillroll.plans.prediction import labelled_customers
from tillroll.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES, MissingColumnsError

COLUMNS = "CustomerID long, InvoiceNo string, InvoiceDate timestamp, Quantity long, UnitPrice double, TotalAmount double"


@pytest.fixture(scope="module")
def lines(spark):
    d = datetime
    rows = [
        (1, "a", d(2011, 1, 1), 1, 20.0, 20.0), (1, "b", d(2011, 2, 1), 1, 30.0, 30.0), (1, "c", d(2011, 3, 1), 1, 35.0, 35.0),
        (2, "d", d(2011, 2, 10), 2, 10.0, 20.0), (2, "e", d(2011, 2, 21), 3, 10.0, 30.0),
        (3, "f", d(2011, 1, 5), 3, 10.0, 30.0), (None, "g", d(2011, 9, 9), 1, 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_rfm_values(lines):
    got = {r.CustomerID: tuple(r)[1:] for r in customers.rfm(lines).collect()}
    assert got == {1: (1, 3, 85.0), 2: (9, 2, 50.0), 3: (56, 1, 30.0)}
    later = {r.CustomerID: r.Recency for r in customers.rfm(lines, datetime(2011, 3, 11)).collect()}
    assert later == {1: 10, 2: 18, 3: 65}


def test_rfm_errors(lines):
    with pytest.raises(MissingColumnsError):
        customers.rfm(lines.drop("TotalAmount"))
    with pytest.raises(ValueError):
        customers.rfm(lines.filter("CustomerID IS NULL"), require_rows=True)


def test_recency_counts_whole_days(spark):
    df = spark.createDataFrame([(1, "a", datetime(2011, 1, 1, 23), 1, 1.0, 1.0)], COLUMNS)
    assert customers.rfm(df, datetime(2011, 1, 2, 1)).first().Recency == 0
    assert customers.rfm(df, datetime(2011, 1, 2, 23)).first().Recency == 1


def test_mode_takes_the_smallest_of_equals(spark):
    rows = [(1, "UK"), (1, "DE"), (2, None), (3, "FR"), (3, "FR"), (3, "AT")]
    df = spark.createDataFrame(rows, "CustomerID long, Country string")
    assert {r.CustomerID: r.Country for r in customers.customer_mode(df).collect()} == {1: "DE", 2: None, 3: "FR"}


def test_later_lines_do_not_reach_the_features(buyers):
    cut = datetime(2011, 2, 1)
    past = prepare.before(buyers, cut)
    table = customers.customer_features(buyers, cut)
    assert table.columns == ["CustomerID", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, customers.customer_features(past, cut).collect()))
    assert table.count() == 40
    with pytest.raises(ValueError):
        customers.customer_features(buyers, datetime(2000, 1, 1), require_rows=True)


def test_feature_values(spark):
    d = datetime
    rows = [
        ("a", "P1", 2, d(2011, 1, 1), 3.0, 7, "UK"), ("a", "P2", 4, d(2011, 1, 1), 1.0, 7, "UK"),
        ("b", "P1", 6, d(2011, 1, 6), 5.0, 7, "DE"), ("c", "P9", 99, d(2011, 1, 11), 5.0, 7, "DE"),
    ]
    df = spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Quantity long, InvoiceDate timestamp, UnitPrice double, CustomerID long, Country string")
    r = customers.customer_features(df, d(2011, 1, 11)).first()
    assert (r.Recency, r.Frequency, r.Monetary, r.UniqueProducts, r.TotalQuantity) == (5, 2, 40.0, 2, 12)
    assert (r.AOV, r.AvgQuantity, r.PurchaseFrequency, r.Country) == (20.0, 4.0, 0.2, "UK")


def test_split_takes_the_ranked_timestamp(spark):
    times = [datetime(2011, 1, 1) + timedelta(hours=i) for i in range(8)]
    df = spark.createDataFrame([(t,) for t in times + times[:3] + [None]], "InvoiceDate timestamp")
    row = customers.temporal_split(df).first()
    assert row.historical_end == times[6] == row.future_start and row.future_end == times[7]
    assert row.n_dates == 8 and row.days_historical == 0
    two = spark.createDataFrame([(times[0],), (times[0] + timedelta(days=8),)], "InvoiceDate timestamp")
    assert customers.temporal_split(two, quantile=0.25).first().historical_end == times[0] + timedelta(days=2)
    for bad in (df.limit(0), spark.createDataFrame([(times[0],)], "InvoiceDate timestamp")):
        with pytest.raises(ValueError):
            customers.split_dates(bad)


def test_target(buyers):
    dates = customers.split_dates(buyers)
    got = customers.future_target(buyers, dates["historical_end"], dates["future_start"], dates["future_end"])
    labels = {r.CustomerID: r.FuturePurchased for r in got.collect()}
    assert len(labels) == 40 and None not in labels
    assert all(labels[1000 + c] == (1 if c % 2 == 0 else 0) for c in range(40))
    only_future = buyers.filter(F.col("InvoiceDate") >= F.timestamp_micros(F.lit(dates["future_start"])))
    assert customers.future_target(only_future, dates["historical_end"], dates["future_start"], dates["future_end"]).count() == 0


def test_membership_and_join(spark, buyers):
    ids = spark.createDataFrame([(1,), (2,)], "k long")
    members = spark.createDataFrame([(2,), (2,), (3,)], "k long")
    assert {r.k: r.FuturePurchased for r in customers.membership_label(ids, members, "k").collect()} == {1: 0, 2: 1}
    matrix = labelled_customers(buyers)
    assert matrix.count() == 40 and matrix.columns[-1] == "FuturePurchased"
    shares = customers.label_distribution(matrix, "FuturePurchased").collect()
    assert sum(r.percentage for r in shares) == pytest.approx(100)
    assert customers.lost_in_join(matrix.drop("FuturePurchased"), matrix.select("CustomerID", "FuturePurchased")) == 0


def test_recommendation_facts_read_lines_once(spark):
    """All five tables come from the sales lines as they were written: the plan joins no order tables again."""
    from tillroll.catalog.all import QUERIES

    facts = QUERIES["recommendation_facts"].run(spark, "/root/testdata/sf0.001")
    assert "lineitem" not in facts._jdf.queryExecution().toString() and "o_orderkey" not in facts._jdf.queryExecution().toString()
