"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass 1 scatters rows uniformly over memory-sized buckets by a seeded hash. Pass 2 puts each bucket in
a fixed order, permutes it with Spark's ``shuffle`` (an inside-out Fisher-Yates) seeded by seed and
bucket, and writes it. A row's place in the shuffled whole is its bucket's offset plus its place in
the bucket; shards take places in turn, so their row counts differ by one at most (law ``rows``).

Every run with one seed and bucket size gives the same order, whatever the input's layout; a lost
executor's buckets come out the same again. Null ids and texts are values like others, a repeated
row stays repeated, ties of hash and id are ordered by the text, and an empty table gives no rows.
Extra columns are carried unread inside one struct, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.shared import new_place, with_offsets

SEED = 20_260
BUCKET_BYTES = 16 << 20


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes and one more; null counts as no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shuffled(rows: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(bucket, place, record): all rows, shuffled and written to the shared folder bucket by bucket."""
    total = rows.agg(F.sum(size_of(text))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    mark = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    scattered = (
        rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("record"), mark.alias("mark"))
        .withColumn("bucket", F.pmod("mark", F.lit(buckets)).cast("int"))
        .repartitionById(buckets, F.col("bucket"))
        .sortWithinPartitions("bucket", "mark", f"record.`{key}`", f"record.`{text}`")
    )
    permuted = scattered.groupBy("bucket").agg(F.shuffle(F.collect_list("record"), F.lit(seed)).alias("records"))
    out = permuted.select("bucket", F.posexplode("records").alias("place", "record"))
    path = new_place(rows.sparkSession, "shuffled")
    out.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path)


def shard_places(written: DataFrame, shards: int, keep: dict[str, Column]) -> DataFrame:
    """The columns of ``keep`` with shard and slot for each row of ``shuffled``."""
    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))
    offsets = with_offsets(counts, "bucket", "n", "offset").select("bucket", "offset")
    slim = written.select("bucket", "place", *[c.alias(k) for k, c in keep.items()])
    whole = F.col("offset") + F.col("place")
    return slim.join(offsets, "bucket").select(
        *keep, F.pmod(whole, F.lit(shards)).cast("int").alias("shard"), F.floor(whole / shards).cast("long").alias("slot")
    )


def write_shards(rows: DataFrame, path: str, shards: int, key: str = "doc_id", text: str = "text", seed: int = SEED) -> None:
    """Whole rows in folders ``shard=0`` .., each with its slot; rows inside a file are in slot order."""
    placed = shard_places(shuffled(rows, key, text, seed), shards, {"record": F.col("record")})
    placed.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(documents: DataFrame, shards: int = 16, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: size, crc of the text, law, shard and slot."""
    written = shuffled(documents, seed=seed, bucket_bytes=bucket_bytes)
    text = F.col("record.text")
    placed = shard_places(
        written,
        shards,
        {
            "doc_id": F.col("record.doc_id"),
            "size": size_of("record.text"),
            "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long"),
        },
    )
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
