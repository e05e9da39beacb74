"""Where intermediate tables go, bounded work units of a batch, and running offsets."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

TOKENIZER_NAMES = {"bytes": "byte_bpe_50k.json", "words": "word_bpe_49k.json"}

# Prefix sums over group numbers go through groups of this many neighbours first.
FAN_IN = 1024


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file (see TOKENIZER_NAMES)."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_NAMES[name])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    named = "file://" + tempfile.mkdtemp(prefix="tillroll-llm-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def new_place(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again, so that lineage ends there."""
    path = new_place(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_parts(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a text column in parts of about ``most`` bytes.

    Yields (first row, bytes, offsets); a single longer text makes a part of its own. Null: empty.
    """
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    row, rows = 0, len(column)
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        last = min(max(last, row + 1), rows)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def records(docs: DataFrame) -> DataFrame:
    """Whole rows as ``record``; the text is sent beside it only where it has to be cast to a string."""
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    return docs.select(record) if ("text", "string") in docs.dtypes else docs.select(record, F.col("text").cast("string").alias("text"))


def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The text column of rows, or that of their records."""
    return batch["text"] if "text" in batch.schema.names else batch["record"].field("text")


def with_offsets(counts: DataFrame, group: str, number: str, to: str) -> DataFrame:
    """Add to each group number the sum of ``number`` over all smaller group numbers.

    Group numbers are whole and not negative, one row each. Sums go over FAN_IN neighbours first, so
    the last step sees one row per FAN_IN groups.
    """
    block = F.floor(F.col(group) / FAN_IN)
    blocks = counts.groupBy(block.alias("_block")).agg(F.sum(number).alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("_block", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum(number).over(Window.partitionBy("_block").orderBy(group).rowsBetween(Window.unboundedPreceding, -1))
    return (
        counts.withColumn("_block", block)
        .withColumn("_inside", F.coalesce(inside, F.lit(0)))
        .join(blocks, "_block")
        .withColumn(to, (F.col("_before") + F.col("_inside")).cast("long"))
        .drop("_block", "_inside", "_before")
    )


def crc_of_id(column: str = "doc_id") -> Column:
    """Unsigned crc32 of the id as decimal text: what held-out rows are chosen by."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
