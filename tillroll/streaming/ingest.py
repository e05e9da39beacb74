"""The row-wise part of the cleaning job over a growing folder of invoice-line files.

Coercion, derived columns, flags and filters look at one line at a time, so the same functions
serve a stream. Duplicate removal and all tables stay batch jobs over the written data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.prepare import add_amount, add_time_parts, flag_cancellations, flag_prices, flag_quantities
from tillroll.schema import RAW_TEXT_SCHEMA, TRANSACTION_SCHEMA
from tillroll.sources.transactions import coerce


def stream_transactions(spark: SparkSession, folder: str, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """Invoice lines from files as they arrive, coerced and flagged."""
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True).schema(RAW_TEXT_SCHEMA)
    else:
        reader = reader.schema(TRANSACTION_SCHEMA)
    lines = coerce(reader.load(folder))
    return add_time_parts(add_amount(flag_prices(flag_quantities(flag_cancellations(lines)))), names=False)


def append_to_table(lines: DataFrame, folder: str, checkpoint: str, once: bool = True):
    """Append the stream to a Parquet folder by month; restarts continue from ``checkpoint``."""
    writer = lines.writeStream.format("parquet").outputMode("append").partitionBy("YearMonth")
    writer = writer.option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
