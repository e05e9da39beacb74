"""Queries over lines: scans, coercions, flags, filters, row sets, audit and cleaning tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.catalog.registry import query, union
from tillroll.catalog.sql import counted, long_measures
from tillroll.operators import cleaning, explore, prepare, validate
from tillroll.schema import BASE_COLUMNS, MEASURES
from tillroll.sources import transactions
from tillroll.sources.transactions import coerce, shape_table

BASE = "InvoiceNo:s StockCode:s Description:s Quantity:l InvoiceDate:t UnitPrice:x CustomerID:l Country:s"
KEYS = "InvoiceNo:s StockCode:s Quantity:l"


@query("scan_transactions", BASE, "SELECT * FROM t_raw")
def scan_transactions(t):
    return coerce(t.raw)


@query("dataset_shape", "rows:l columns:l", "SELECT count(*) AS rows, 8 AS columns FROM t_raw")
def dataset_shape(t):
    return shape_table(t.raw)


@query(
    "scan_vectors",
    "label:i vectors:l entries:l total:3",
    """SELECT label, count(*) AS vectors, sum(len(embedding)) AS entries, sum(list_sum(embedding)) AS total
       FROM embeddings GROUP BY label""",
)
def scan_vectors(t):
    from tillroll.sources.transactions import scan_vectors as scan

    v = scan(t.spark, f"{t.folder}/embeddings.parquet")
    total = F.aggregate(F.col("embedding"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return v.groupBy("label").agg(
        F.count(F.lit(1)).alias("vectors"), F.sum(F.size("embedding")).alias("entries"), F.sum(total).alias("total")
    )


def _texts(t):
    """Lines whose price and date are text, unreadable on some of them, and whose country is padded."""
    price = F.when(F.col("Description").isNull(), "n/a").otherwise(F.col("UnitPrice").cast("string"))
    date = F.when(F.col("Quantity") == 0, "bad-date").otherwise(F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))
    return t.raw.withColumns(
        {"UnitPrice": price, "InvoiceDate": date, "Country": F.concat(F.lit(" \t"), "Country", F.lit("\n "))}
    )


@query(
    "ensure_numeric",
    f"{KEYS} UnitPrice:x",
    "SELECT * EXCLUDE (UnitPrice), CASE WHEN Description IS NOT NULL THEN UnitPrice END AS UnitPrice FROM t_raw",
)
def ensure_numeric(t):
    return prepare.ensure_numeric(_texts(t), ["UnitPrice", "Quantity", "Absent"])


@query(
    "ensure_datetime",
    f"{KEYS} InvoiceDate:t",
    "SELECT * EXCLUDE (InvoiceDate), CASE WHEN Quantity <> 0 THEN InvoiceDate END AS InvoiceDate FROM t_raw",
)
def ensure_datetime(t):
    return prepare.ensure_datetime(_texts(t), ["InvoiceDate"])


@query("ensure_string", f"{KEYS} Country:s Description:s", "SELECT * FROM t_raw")
def ensure_string(t):
    return prepare.ensure_string(_texts(t), ["Country", "Description"])


@query("total_amount", f"{KEYS} UnitPrice:x TotalAmount:x", "SELECT *, Quantity * UnitPrice AS TotalAmount FROM t_raw")
def total_amount(t):
    return prepare.add_amount(t.raw)


@query(
    "temporal_features",
    f"{KEYS} Year:i Month:i Day:i Hour:i DayOfWeek:i DayOfWeekName:s YearMonth:s Date:d",
    "SELECT * FROM t_full",
)
def temporal_features(t):
    return prepare.add_time_parts(prepare.drop_duplicate_lines(t.raw))


@query("flag_cancellations", f"{KEYS} IsCancellation:b", "SELECT *, InvoiceNo LIKE 'C%' AS IsCancellation FROM t_raw")
def flag_cancellations(t):
    return prepare.flag_cancellations(t.raw)


@query(
    "flag_quantities",
    f"{KEYS} IsNegativeQuantity:b IsZeroQuantity:b",
    "SELECT *, Quantity < 0 AS IsNegativeQuantity, Quantity = 0 AS IsZeroQuantity FROM t_raw",
)
def flag_quantities(t):
    return prepare.flag_quantities(t.raw)


@query(
    "flag_prices",
    f"{KEYS} IsNegativePrice:b IsZeroPrice:b",
    "SELECT *, UnitPrice < 0 AS IsNegativePrice, UnitPrice = 0 AS IsZeroPrice FROM t_raw",
)
def flag_prices(t):
    return prepare.flag_prices(t.raw)


@query("valid_price", BASE, "SELECT * FROM t_raw WHERE UnitPrice > 0")
def valid_price(t):
    return prepare.valid_price(t.raw)


@query("positive_sales_root", BASE, "SELECT * FROM t_raw WHERE InvoiceNo NOT LIKE 'C%' AND Quantity > 0")
def positive_sales_root(t):
    return prepare.positive_quantity_sales(t.raw)


@query(
    "analytical_datasets",
    "dataset:s rows:l",
    """SELECT 'full' AS dataset, count(*) AS rows FROM t_full
       UNION ALL SELECT 'valid_price', count(*) FROM t_valid
       UNION ALL SELECT 'positive_sales', count(*) FROM t_pos""",
)
def analytical_datasets(t):
    return prepare.row_set_counts(t.raw)


@query("positive_sales_cid", f"{BASE} TotalAmount:x", "SELECT * FROM t_sales")
def positive_sales_cid(t):
    return t.sales


@query(
    "sales_lines",
    BASE,
    """SELECT * FROM t_raw WHERE InvoiceNo NOT LIKE 'C%' AND Quantity > 0 AND UnitPrice > 0
       AND CustomerID IS NOT NULL""",
)
def sales_lines(t):
    return prepare.sales_lines(t.raw)


@query(
    "clean_dataset",
    f"{BASE} TotalAmount:x Year:i Month:i Day:i Hour:i DOW:i DOWName:s YearMonth:s Date:d IsCancellation:b",
    """SELECT *, DayOfWeek AS "DOW", DayOfWeekName AS "DOWName" FROM t_sales""",
)
def clean_dataset(t):
    return prepare.clean_dataset(t.raw)[1]


@query(
    "historical_filter",
    "kept_rows:l dropped_rows:l",
    """SELECT count(*) FILTER (WHERE InvoiceDate < cut) AS kept_rows,
              count(*) FILTER (WHERE InvoiceDate >= cut) AS dropped_rows FROM t_sales, t_split""",
)
def historical_filter(t):
    return prepare.leak_counts(t.sales, t.dates["historical_end"])


@query(
    "log1p_features",
    "CustomerID:l Log_Recency:6 Log_Frequency:6 Log_Monetary:6",
    """SELECT CustomerID, ln(1 + Recency) AS "Log_Recency", ln(1 + Frequency) AS "Log_Frequency",
              ln(1 + Monetary) AS "Log_Monetary" FROM t_rfm""",
)
def log1p_features(t):
    return prepare.add_log1p(t.rfm)


@query(
    "run_full_cleaning",
    "dataset:s rows:l",
    """SELECT 'flagged' AS dataset, count(*) AS rows FROM t_full
       UNION ALL SELECT 'cleaned', count(*) FROM t_valid
       UNION ALL SELECT 'positive_sales', count(*) FROM t_pos""",
)
def run_full_cleaning(t):
    return prepare.row_set_counts(t.raw, list(cleaning.cleaned_sets(t.raw)))


@query("dedup", BASE, "SELECT DISTINCT * FROM t_raw")
def dedup(t):
    return prepare.drop_duplicate_lines(t.raw)


_TYPES = {
    "InvoiceNo": "string", "StockCode": "string", "Description": "string", "Quantity": "bigint",
    "InvoiceDate": "timestamp", "UnitPrice": "double", "CustomerID": "bigint", "Country": "string",
}


@query(
    "data_types",
    "position:i column:s dtype:s non_null_count:l",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{k}' AS dtype, count({c}) AS non_null_count FROM t_raw"
        for i, (c, k) in enumerate(_TYPES.items())
    ),
)
def data_types(t):
    return validate.data_types(t.raw)


@query(
    "missing_values",
    "column:s missing_count:l missing_pct:4 non_missing_count:l",
    counted(
        BASE_COLUMNS,
        "t_raw",
        "count(*) - count({c}) AS missing_count, 100.0 * (count(*) - count({c})) / count(*) AS missing_pct, "
        "count({c}) AS non_missing_count",
    ),
)
def missing_values(t):
    return validate.missing_values(t.raw)


@query(
    "duplicate_count",
    "rows:l distinct_rows:l duplicates:l duplicate_pct:4",
    """SELECT *, rows - distinct_rows AS duplicates, 100.0 * (rows - distinct_rows) / rows AS duplicate_pct
       FROM (SELECT (SELECT count(*) FROM t_raw) AS rows, (SELECT count(*) FROM t_full) AS distinct_rows)""",
)
def duplicate_count(t):
    return validate.duplicate_count(t.raw)


@query(
    "duplicate_examples",
    f"{BASE} copy:i",
    """SELECT * FROM (
         SELECT *, row_number() OVER (PARTITION BY InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
                                                   CustomerID, Country) AS copy,
                count(*) OVER (PARTITION BY InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
                                            CustomerID, Country) AS copies FROM t_raw)
       WHERE copies > 1
       ORDER BY InvoiceNo NULLS LAST, StockCode NULLS LAST, Description NULLS LAST, Quantity NULLS LAST,
                InvoiceDate NULLS LAST, UnitPrice NULLS LAST, CustomerID NULLS LAST, Country NULLS LAST, copy LIMIT 20""",
)
def duplicate_examples(t):
    return validate.duplicate_examples(t.raw)


@query(
    "unique_values",
    "column:s unique_count:l unique_pct:4",
    counted(
        BASE_COLUMNS, "t_raw", "count(DISTINCT {c}) AS unique_count, 100.0 * count(DISTINCT {c}) / count(*) AS unique_pct"
    ),
)
def unique_values(t):
    return validate.unique_values(t.raw)


@query(
    "invalid_numeric",
    "column:s non_numeric_count:l negative_count:l zero_count:l positive_count:l",
    """SELECT 'UnitPrice' AS "column", count(*) FILTER (WHERE Description IS NULL) AS non_numeric_count,
              count(*) FILTER (WHERE UnitPrice < 0 AND Description IS NOT NULL) AS negative_count,
              count(*) FILTER (WHERE UnitPrice = 0 AND Description IS NOT NULL) AS zero_count,
              count(*) FILTER (WHERE UnitPrice > 0 AND Description IS NOT NULL) AS positive_count FROM t_raw
       UNION ALL """
    + counted(
        ["Quantity", "CustomerID"],
        "t_raw",
        "0, count(*) FILTER (WHERE {c} < 0), count(*) FILTER (WHERE {c} = 0), count(*) FILTER (WHERE {c} > 0)",
    ),
)
def invalid_numeric(t):
    return validate.invalid_numeric(_texts(t))


@query(
    "sign_counts",
    "column:s negative_count:l zero_count:l positive_count:l",
    counted(
        ["Quantity", "UnitPrice"],
        "t_raw",
        "count(*) FILTER (WHERE {c} < 0) AS negative_count, count(*) FILTER (WHERE {c} = 0) AS zero_count, "
        "count(*) FILTER (WHERE {c} > 0) AS positive_count",
    ),
)
def sign_counts(t):
    return validate.sign_counts(t.raw)


@query(
    "date_parsing",
    "column:s unparseable_count:l min_date:t max_date:t",
    """SELECT 'InvoiceDate' AS "column", count(*) FILTER (WHERE Quantity = 0) AS unparseable_count,
              min(InvoiceDate) FILTER (WHERE Quantity <> 0) AS min_date,
              max(InvoiceDate) FILTER (WHERE Quantity <> 0) AS max_date FROM t_raw""",
)
def date_parsing(t):
    return validate.date_parsing(_texts(t))


@query(
    "suspicious_invoices",
    "cancellation_invoices:l empty_invoice_numbers:l non_standard_invoice_format:l",
    """SELECT count(*) FILTER (WHERE InvoiceNo LIKE 'C%') AS cancellation_invoices,
              count(*) FILTER (WHERE Quantity = 0) AS empty_invoice_numbers,
              count(*) FILTER (WHERE Quantity <> 0 AND UnitPrice < 0) AS non_standard_invoice_format
       FROM t_raw WHERE Quantity <> 0 OR InvoiceNo NOT LIKE 'C%'""",
)
def suspicious_invoices(t):
    number = F.when(F.col("Quantity") == 0, "  ").when(F.col("UnitPrice") < 0, F.concat("InvoiceNo", F.lit("-X")))
    return validate.suspicious_invoices(t.raw.withColumn("InvoiceNo", number.otherwise(F.col("InvoiceNo"))))


@query(
    "blank_strings",
    "column:s blank_count:l",
    """SELECT 'Country' AS "column", count(*) FILTER (WHERE Quantity = 0) AS blank_count FROM t_raw
       UNION ALL """
    + counted(["InvoiceNo", "StockCode", "Description"], "t_raw", "count(*) FILTER (WHERE {c} IS NULL)"),
)
def blank_strings(t):
    country = F.when(F.col("Quantity") == 0, " nan\t").otherwise(F.col("Country"))
    return validate.blank_strings(t.raw.withColumn("Country", country))


@query(
    "entity_counts",
    "n_invoices:l n_customers:l n_products:l n_countries:l",
    """SELECT count(DISTINCT InvoiceNo) AS n_invoices, count(DISTINCT CustomerID) AS n_customers,
              count(DISTINCT StockCode) AS n_products, count(DISTINCT Country) AS n_countries FROM t_raw""",
)
def entity_counts(t):
    return validate.entity_counts(t.raw)


@query(
    "quality_summary",
    "metric:s value:4",
    """SELECT unnest(['total_rows', 'total_columns', 'exact_duplicates', 'missing_customer_count',
                      'missing_customer_pct', 'missing_description_count', 'missing_description_pct',
                      'negative_quantity_count', 'price_not_positive_count', 'cancellation_lines']) AS metric,
              unnest([rows, 8.0, rows - (SELECT count(*) FROM t_full), no_customer, 100.0 * no_customer / rows,
                      no_text, 100.0 * no_text / rows, negative, bad_price, cancelled]::DOUBLE[]) AS value
       FROM (SELECT CAST(count(*) AS DOUBLE) AS rows, count(*) FILTER (WHERE CustomerID IS NULL) AS no_customer,
                    count(*) FILTER (WHERE Description IS NULL) AS no_text,
                    count(*) FILTER (WHERE Quantity < 0) AS negative, count(*) FILTER (WHERE UnitPrice <= 0) AS bad_price,
                    count(*) FILTER (WHERE InvoiceNo LIKE 'C%') AS cancelled FROM t_raw)""",
)
def quality_summary(t):
    return validate.quality_summary(t.raw)


@query(
    "dataset_overview",
    "rows:l n_invoices:l n_customers:l n_products:l n_countries:l n_descriptions:l date_min:d date_max:d total_revenue:2",
    """SELECT count(*) AS rows, count(DISTINCT InvoiceNo) AS n_invoices, count(DISTINCT CustomerID) AS n_customers,
              count(DISTINCT StockCode) AS n_products, count(DISTINCT Country) AS n_countries,
              count(DISTINCT Description) AS n_descriptions, min("Date") AS date_min, max("Date") AS date_max,
              (SELECT sum(TotalAmount) FROM t_pos) AS total_revenue FROM t_full""",
)
def dataset_overview(t):
    return explore.dataset_overview(t.full, t.positive)


_SHAPE = """count(*) AS "count", avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
            quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3"""
_TAIL = """quantile_cont(value, 0.9) AS p90, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99,
           skewness(value) AS skewness, kurtosis(value) AS kurtosis"""


@query(
    "numeric_summary",
    "column:s count:l mean:4 std:4 min:4 max:4 q1:4 median:4 q3:4",
    f'SELECT "column", {_SHAPE} FROM ({long_measures("t_pos")}) GROUP BY "column"',
)
def numeric_summary(t):
    return explore.numeric_summary(t.measures, MEASURES)


@query(
    "numeric_summary_ext",
    "column:s count:l mean:4 std:4 min:4 max:4 q1:4 median:4 q3:4 p90:4 p95:4 p99:4 skewness:6 kurtosis:6",
    f'SELECT "column", {_SHAPE}, {_TAIL} FROM ({long_measures("t_pos")}) GROUP BY "column"',
)
def numeric_summary_ext(t):
    return explore.numeric_summary(t.measures, MEASURES, extended=True)


_TEXT_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS \"count\" FROM t_full GROUP BY {c}"
    for c in ("InvoiceNo", "StockCode", "Description", "Country")
)


@query(
    "categorical_summary",
    "column:s position:i value:s count:l percentage:4",
    f"""SELECT *, 100.0 * "count" / (SELECT count(*) FROM t_full) AS percentage
        FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value NULLS FIRST) AS position
              FROM ({_TEXT_COUNTS})) WHERE position <= 10""",
)
def categorical_summary(t):
    return explore.categorical_summary(t.full, 10, ["InvoiceNo", "StockCode", "Description", "Country"])


@query(
    "categorical_frequencies",
    "column:s value:s count:l percentage:3 cumulative_percentage:3",
    f"""SELECT *, sum(percentage) OVER (PARTITION BY "column" ORDER BY "count" DESC, value NULLS FIRST
                                        ROWS UNBOUNDED PRECEDING) AS cumulative_percentage
        FROM (SELECT *, round_even(100.0 * "count" / (SELECT CAST(count(*) AS DOUBLE) FROM t_full), 3) AS percentage
              FROM ({_TEXT_COUNTS}))""",
)
def categorical_frequencies(t):
    return explore.categorical_frequencies(t.full)


@query(
    "head_tail",
    f"part:s {BASE}",
    """SELECT * FROM (SELECT 'head' AS part, * FROM t_raw ORDER BY InvoiceDate, InvoiceNo, StockCode, Quantity, UnitPrice LIMIT 10)
       UNION ALL SELECT * FROM (SELECT 'tail', * FROM t_raw
         ORDER BY InvoiceDate DESC, InvoiceNo DESC, StockCode DESC, Quantity DESC, UnitPrice DESC LIMIT 10)""",
)
def head_tail(t):
    order = ["InvoiceDate", "InvoiceNo", "StockCode", "Quantity", "UnitPrice"]
    return union({"head": explore.head_rows(t.raw, 10, order), "tail": explore.tail_rows(t.raw, 10, order)}, "part")


_ENDS = "l_orderkey:l l_linenumber:i l_partkey:l l_quantity:x"


@query(
    "file_ends",
    f"part:s place:i {_ENDS}",
    """SELECT 'head' AS part, r AS place, * FROM (SELECT *, row_number() OVER () AS r FROM lineitem) WHERE r <= 10
       UNION ALL
       SELECT 'tail', (SELECT count(*) FROM lineitem) - r + 1, * FROM (SELECT *, row_number() OVER () AS r FROM lineitem)
       WHERE r > (SELECT count(*) FROM lineitem) - 10""",
)
def file_ends(t):
    return transactions.file_ends(t.table("lineitem"))


_FACTS = """SELECT (SELECT count(*) FROM t_raw) AS n_raw, (SELECT count(*) FROM t_full) AS n_full,
                   (SELECT count(*) FROM t_valid) AS n_clean, (SELECT count(*) FROM t_pos) AS n_pos"""


@query(
    "cleaning_log",
    "step_no:i rows_before:l rows_removed:l rows_after:l",
    f"""SELECT step_no, a AS rows_before, a - b AS rows_removed, b AS rows_after
        FROM (SELECT unnest(range(8)) AS step_no,
                     unnest([n_raw, n_raw, n_full, n_full, n_full, n_full, n_clean, n_clean]) AS a,
                     unnest([n_raw, n_full, n_full, n_full, n_full, n_clean, n_clean, n_pos]) AS b FROM ({_FACTS}))""",
)
def cleaning_log(t):
    return cleaning.cleaning_log(t.raw)


@query(
    "cleaning_decisions",
    "issue:s count:l of_which_not_cancelled:l treatment:s reason:s impact:s",
    f"""SELECT unnest(['Exact duplicate rows', 'UnitPrice <= 0', 'Negative Quantity', 'Cancellation invoices',
                       'Missing CustomerID', 'Missing Description', 'Not in positive sales']) AS issue,
               unnest([n_raw - n_full, (SELECT count(*) FROM t_raw WHERE UnitPrice <= 0),
                       (SELECT count(*) FROM t_raw WHERE Quantity < 0),
                       (SELECT count(*) FROM t_raw WHERE InvoiceNo LIKE 'C%'),
                       (SELECT count(*) FROM t_raw WHERE CustomerID IS NULL),
                       (SELECT count(*) FROM t_raw WHERE Description IS NULL), n_clean - n_pos]) AS "count",
               unnest([NULL, NULL, NULL, NULL, NULL, NULL,
                       (SELECT count(*) FROM t_valid WHERE NOT IsCancellation AND NOT Quantity > 0)]) AS of_which_not_cancelled,
               unnest(['dropped', 'flagged, dropped_from cleaned', 'flagged, dropped_from positive_sales', 'flagged, dropped_from positive_sales',
                       'kept', 'kept', 'dropped_from positive_sales']) AS treatment,
               unnest(['row_number over the base columns > 1', 'IsZeroPrice or IsNegativePrice', 'IsNegativeQuantity', 'IsCancellation',
                       'CustomerID is null', 'Description is null', 'IsCancellation or Quantity <= 0']) AS reason,
               unnest(['full, cleaned, positive_sales', 'cleaned, positive_sales', 'positive_sales', 'positive_sales',
                       'customer tables', 'none', 'positive_sales']) AS impact
        FROM ({_FACTS})""",
)
def cleaning_decisions(t):
    return cleaning.cleaning_decisions(t.raw)


def _metrics(name: str, table: str, columns: int, duplicates: str) -> str:
    return f"""SELECT '{name}' AS dataset, count(*) AS row_count, {columns} AS column_count,
        2 * count(*) - count(CustomerID) - count(Description) AS total_missing,
        count(*) - count(CustomerID) AS missing_customer, count(*) - count(Description) AS missing_description,
        {duplicates} AS duplicate_rows, count(*) FILTER (WHERE Quantity < 0) AS negative_quantity,
        count(*) FILTER (WHERE Quantity = 0) AS zero_quantity, count(*) FILTER (WHERE UnitPrice <= 0) AS price_not_positive,
        count(*) FILTER (WHERE InvoiceNo LIKE 'C%') AS cancellations, avg(Quantity * UnitPrice) AS amount_mean,
        quantile_cont(Quantity * UnitPrice, 0.5) AS amount_median, stddev_samp(Quantity * UnitPrice) AS amount_std,
        sum(Quantity * UnitPrice) AS amount_sum FROM {table}"""


@query(
    "before_after",
    "dataset:s row_count:l column_count:l total_missing:l missing_customer:l missing_description:l duplicate_rows:l "
    "negative_quantity:l zero_quantity:l price_not_positive:l cancellations:l amount_mean:4 amount_median:4 amount_std:4 "
    "amount_sum:2",
    " UNION ALL ".join(
        [
            _metrics("Raw dataset", "t_raw", 8, "count(*) - (SELECT count(*) FROM t_full)"),
            _metrics("Cleaned (quality)", "t_valid", 20, "0"),
            _metrics("Positive-sales analytical", "t_pos", 20, "0"),
        ]
    ),
)
def before_after(t):
    sets = cleaning.cleaned_sets(t.numbered, "copy")
    return cleaning.before_after(t.numbered, sets["cleaned"], sets["positive_sales"], "copy")
