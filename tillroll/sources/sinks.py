"""Writers for report tables and cleaned row sets."""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_table(df: DataFrame, folder: str, name: str, single_file: bool = False, fmt: str = "csv") -> str:
    """Write one result table with a header; returns its path.

    ``single_file`` suits report tables of a few rows; row-level data keeps its partitions.
    """
    path = f"{folder.rstrip('/')}/{name}"
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def save_tables(tables: dict[str, DataFrame], folder: str, single_file: bool = False, fmt: str = "csv") -> dict[str, str]:
    """Write each table of a result set under its name; one file each only on request."""
    return {name: save_table(df, folder, name, single_file, fmt) for name, df in tables.items()}


def save_cleaned(
    flagged: DataFrame, cleaned: DataFrame, positive: DataFrame, folder: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Write the three row sets of the cleaning job.

    Parquet output is partitioned by month so that later date filters read only their months. Rows
    are first spread by month and invoice: a month's rows land in a few files each, and a month
    that holds much of the data still has many writers.
    """
    paths = {}
    for name, df in {"flagged": flagged, "cleaned": cleaned, "positive_sales": positive}.items():
        path = f"{folder.rstrip('/')}/{name}"
        if fmt == "parquet":
            spread = df.repartitionByRange("YearMonth", "InvoiceNo")
            spread.write.mode("overwrite").partitionBy("YearMonth").parquet(path)
        else:
            df.write.mode("overwrite").option("header", True).csv(path)
        paths[name] = path
    return paths


def save_cleaning_log(log: DataFrame, folder: str) -> str:
    return save_table(log, folder, "cleaning_log", single_file=True)
