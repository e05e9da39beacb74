import pytest
from pyspark.sql import functions as F

from tillroll.operators import cleaning
from tillroll.plans import exploration, report
from tillroll.schema import BASE_COLUMNS, TRANSACTION_SCHEMA, DatasetNotFoundError, MissingColumnsError
from tillroll.session import pinned
from tillroll.sources import sinks, transactions
from tillroll.sources.spread import spread
from tillroll.streaming.ingest import append_to_table, stream_transactions


def test_scans_agree_over_formats(spark, dirty, tmp_path):
    dirty.write.parquet(f"{tmp_path}/p")
    dirty.write.json(f"{tmp_path}/j")
    text = dirty.withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))
    text.write.option("header", True).option("emptyValue", '""').csv(f"{tmp_path}/c")
    want = sorted(map(str, dirty.collect()))
    assert sorted(map(str, transactions.scan_transactions(spark, f"{tmp_path}/p").collect())) == want
    assert sorted(map(str, transactions.scan_transactions(spark, f"{tmp_path}/j", "json").collect())) == want
    csv = transactions.scan_transactions(spark, f"{tmp_path}/c", "csv")
    assert csv.schema == TRANSACTION_SCHEMA and csv.agg(F.sum("Quantity")).first()[0] == 14


def test_scan_errors(spark, dirty, tmp_path):
    for fmt in ("parquet", "csv"):
        with pytest.raises(DatasetNotFoundError):
            transactions.scan_transactions(spark, f"{tmp_path}/none", fmt)
    with pytest.raises(DatasetNotFoundError):
        transactions.path_exists(spark, f"{tmp_path}/none")
    assert transactions.path_exists(spark, str(tmp_path))
    dirty.drop("Country").write.option("header", True).csv(f"{tmp_path}/short")
    dirty.drop("Country").write.parquet(f"{tmp_path}/shortp")
    with pytest.raises(MissingColumnsError):
        transactions.scan_transactions(spark, f"{tmp_path}/short", "csv")
    with pytest.raises(MissingColumnsError):
        transactions.scan_transactions(spark, f"{tmp_path}/shortp")


def test_nan_becomes_null_and_shape(spark, tmp_path):
    row = ("1", "A", None, 1, None, float("nan"), None, None)
    spark.createDataFrame([row], TRANSACTION_SCHEMA).write.parquet(f"{tmp_path}/n")
    df = transactions.scan_transactions(spark, f"{tmp_path}/n")
    assert df.first().UnitPrice is None and transactions.table_shape(df) == (1, 8)
    assert tuple(transactions.shape_table(df).first()) == (1, 8)


def test_file_order(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/r")
    rows = transactions.with_file_order(spark.read.parquet(f"{tmp_path}/r")).orderBy("_file", "_row").collect()
    assert [r.id for r in rows] == list(range(100))


def test_sinks(spark, dirty, tmp_path):
    sets = cleaning.run_cleaning(dirty, f"{tmp_path}/out")
    months = spark.read.parquet(f"{tmp_path}/out/flagged")
    assert months.count() == 5 and "YearMonth" in months.columns
    log = spark.read.option("header", True).csv(f"{tmp_path}/out/cleaning_log")
    assert log.count() == 8
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/cleaning_decision_table").count() == 7
    paths = sinks.save_cleaned(sets["flagged"], sets["cleaned"], sets["positive_sales"], f"{tmp_path}/csv", "csv")
    assert spark.read.option("header", True).csv(paths["cleaned"]).count() == 3


def test_small_inputs_are_spread(spark):
    assert spread(spark.range(100).coalesce(1), "id").rdd.getNumPartitions() == 4
    wide = spark.range(100).repartition(9)
    assert spread(wide, "id") is wide


def test_checkpoint_keeps_rows(spark):
    assert pinned(spark.range(50)).count() == 50


def test_stream_gives_the_batch_rows(spark, dirty, tmp_path):
    dirty.write.parquet(f"{tmp_path}/in")
    stream = stream_transactions(spark, f"{tmp_path}/in")
    append_to_table(stream, f"{tmp_path}/table", f"{tmp_path}/state").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/table")
    assert out.count() == 6 and out.filter("IsCancellation").count() == 1
    assert set(BASE_COLUMNS) <= set(out.columns)


def test_studies_return_their_tables(dirty, buyers):
    assert len(exploration.profile(dirty)) == 11
    studies = exploration.explore_raw(buyers)
    assert set(studies) == {"descriptive", "temporal", "product", "geographic", "relationship", "anomaly"}
    assert studies["temporal"]["best_month"].count() == 1
    both = studies["product"]["ranking_comparison"].first()
    assert 0 < both.in_first <= 10 and both.in_first == both.in_both + both.only_first


def test_full_report(buyers, tmp_path):
    out = report.full_report(buyers, f"{tmp_path}/r", k_values=(2, 3), n_init=1, cv_folds=0, trees=3, mlp_iterations=5)
    assert len(out["summary"]) == 7 and len(out["recommendations"]) >= 5
    assert out["segments"]["best_k"] in (2, 3) and "eda_overview" in out["paths"]
    assert {r.topic for r in out["facts"].collect()} >= {"top_segment", "outreach_pct", "country_budget", "baseline_gap"}


def test_file_ends(spark, tmp_path):
    for i, (a, b) in enumerate([(0, 3), (3, 20), (20, 22)]):
        spark.range(a, b, 1, 1).write.mode("append").parquet(f"{tmp_path}/part={i}")
    df = spark.read.parquet(*[f"{tmp_path}/part={i}" for i in range(3)])
    got = sorted(tuple(r) for r in transactions.file_ends(df, 5).select("part", "place", "id").collect())
    assert got == sorted([("head", i + 1, i) for i in range(5)] + [("tail", i + 1, 21 - i) for i in range(5)])
