"""Scans of invoice lines and of labelled vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from tillroll.functions.columns import to_number, to_time
from tillroll.functions.ranks import running_totals
from tillroll.schema import (
    BASE_COLUMNS,
    RAW_TEXT_SCHEMA,
    TRANSACTION_SCHEMA,
    DatasetNotFoundError,
    check_columns,
)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path exists on whichever file system its scheme names; otherwise raise."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        raise DatasetNotFoundError(f"no data at {path}")
    return True


def coerce(df: DataFrame) -> DataFrame:
    """Give the base columns their types once; values that do not parse become null.

    Columns that already have the right type pass through, so a typed Parquet scan keeps its
    filter pushdown. Other columns are kept behind the base ones.
    """
    types = dict(df.dtypes)
    out = []
    for field in TRANSACTION_SCHEMA.fields:
        name, want = field.name, field.dataType.simpleString()
        if types.get(name) == want and want != "double":
            out.append(F.col(name))
        elif want == "timestamp":
            zoneless = types[name] == "timestamp_ntz"
            out.append((F.col(name).cast("timestamp") if zoneless else to_time(name)).alias(name))
        elif want == "string":
            out.append(F.col(name).cast("string").alias(name))
        elif want == "bigint":
            out.append(to_number(name).try_cast("bigint").alias(name))
        else:
            out.append(to_number(name, want).alias(name))
    extra = [F.col(c) for c in df.columns if c not in BASE_COLUMNS]
    return df.select(*out, *extra)


def scan_transactions(
    spark: SparkSession, path: str, fmt: str = "parquet", validate: bool = True, header: bool = True
) -> DataFrame:
    """Invoice lines from Parquet, ORC, JSON or delimited text, with types applied.

    Delimited text is read under a fixed text schema: nothing is inferred, so no extra pass is made.
    """
    try:
        if fmt == "csv":
            if header and validate:
                names = spark.read.option("header", True).csv(path).columns
                check_names(names)
                raw = spark.read.option("header", True).schema(text_schema(names)).csv(path)
            else:
                raw = spark.read.option("header", header).schema(RAW_TEXT_SCHEMA).csv(path)
        else:
            raw = spark.read.format(fmt).load(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err.getCondition() or ""):
            raise DatasetNotFoundError(f"no data at {path}") from err
        raise
    if validate:
        check_columns(raw)
    return coerce(raw)


def check_names(names: list[str]) -> None:
    from tillroll.schema import MissingColumnsError

    missing = [c for c in BASE_COLUMNS if c not in names]
    if missing:
        raise MissingColumnsError(f"missing columns {missing}; file has {names}")


def text_schema(names: list[str]) -> str:
    return ", ".join(f"`{n}` string" for n in names)


def table_shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def shape_table(df: DataFrame) -> DataFrame:
    """Row and column count as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def scan_vectors(spark: SparkSession, path: str, vector: str = "embedding", label: str = "label") -> DataFrame:
    """Samples with an array column and an integer label."""
    df = spark.read.parquet(path)
    check_columns(df, [vector, label])
    return df


def with_file_order(df: DataFrame) -> DataFrame:
    """Add the position of each row in its Parquet file, for jobs that need file order."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def file_ends(df: DataFrame, n: int = 10) -> DataFrame:
    """The first and last ``n`` rows in file order, as ``part`` ("head", "tail"), ``place`` from 1 and the columns.

    Files follow each other by path. Row counts of the files (one row each) tell which files
    hold wanted rows. ``df`` must be a plain scan.
    """
    placed = with_file_order(df)
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"))
    upto = running_totals(sizes, [F.col("_file")], {"_upto": F.col("rows")})
    total = sizes.agg(F.sum("rows")).scalar()
    spans = upto.select("_file", (F.col("_upto") - F.col("rows")).alias("_start"), "_upto", total.alias("_all"))
    # files without rows are not listed, so at most 2 n are left
    wanted = spans.filter((F.col("_start") < n) | (F.col("_upto") > F.col("_all") - n))
    rows = placed.join(F.broadcast(wanted), "_file").withColumn("_at", F.col("_start") + F.col("_row"))
    out = None
    for part, keep, place in (("head", F.col("_at") < n, F.col("_at") + 1), ("tail", F.col("_at") >= F.col("_all") - n, F.col("_all") - F.col("_at"))):
        one = rows.filter(keep).select(F.lit(part).alias("part"), place.cast("int").alias("place"), *df.columns)
        out = one if out is None else out.unionByName(one)
    return out
