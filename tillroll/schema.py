"""Column names, the invoice-line schema and the errors raised on bad input."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, types as T

# The eight columns every invoice-line table must have.
BASE_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.LongType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Country", T.StringType()),
    ]
)

# The same columns before coercion: delimited files are read as text and coerced once.
RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in BASE_COLUMNS])

# Column groups by name.
NUMERIC_COLUMNS = ["Quantity", "UnitPrice", "CustomerID"]
TEXT_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Country"]
DATE_COLUMNS = ["InvoiceDate"]
ID_COLUMNS = ["InvoiceNo", "StockCode", "CustomerID"]
MEASURES = ["Quantity", "UnitPrice", "TotalAmount"]
RFM_COLUMNS = ["Recency", "Frequency", "Monetary"]

# Customer feature columns in their published order.
NUMERIC_FEATURES = [
    "Recency",
    "Frequency",
    "Monetary",
    "AOV",
    "UniqueProducts",
    "AvgQuantity",
    "TotalQuantity",
    "PurchaseFrequency",
]
CATEGORICAL_FEATURES = ["Country"]
TARGET = "FuturePurchased"

# Cancellation prefix, fence width, seed, cut-off rank, sweep range.
CANCEL_PREFIX = "C"
IQR_MULTIPLIER = 1.5
SEED = 42
SPLIT_QUANTILE = 0.75
K_RANGE = range(2, 11)
# Texts that count as missing.
BLANK_TEXTS = ["", "nan", "None", "NaN"]
NULL_INVOICE_TEXTS = ["", "nan", "None"]


class DatasetNotFoundError(FileNotFoundError):
    """The path given to a scan does not exist or is not readable data."""


class MissingColumnsError(ValueError):
    """A table lacks columns that the operation needs."""


def check_columns(df: DataFrame, expected: Sequence[str] = BASE_COLUMNS) -> tuple[bool, list[str]]:
    """Raise if a column is missing; otherwise return ``(True, extra columns)``. Runs no job."""
    present = set(df.columns)
    missing = [c for c in expected if c not in present]
    if missing:
        raise MissingColumnsError(f"missing columns {missing}; table has {df.columns}")
    return True, [c for c in df.columns if c not in set(expected)]


def require(df: DataFrame, columns: Iterable[str]) -> None:
    check_columns(df, list(columns))


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The given columns that the table has, in the given order."""
    have = set(df.columns)
    return [c for c in columns if c in have]
