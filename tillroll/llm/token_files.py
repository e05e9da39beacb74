"""Token files: ids of many documents in one array, document boundaries in Elias-Fano code.

A file block holds whole documents in ascending id order: their ids back to back as unsigned 16-bit
numbers, and the n + 1 boundaries in it as an Elias-Fano sequence. Each boundary is cut into low bits,
stored as they are, and a high part, stored in unary in a bit vector; ``select`` finds the i-th set bit
from samples of one in SAMPLE. That is about 2 + log2(ids / documents) bits a document, and no table
of 64-bit offsets exists. Blocks are rows of a Parquet data set, so that writing is atomic, survives
lost executors and works on every store that Spark can write. A block's offset in the whole is the
sum of the blocks before it, known after writing from (partition, block, ids) alone.

Null or empty texts have just the end id. Equal doc_ids are ordered by text, null ids come first; each
input row gives one output row. An empty table gives an empty data set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm.encode import batches, encoder
from tillroll.llm.shared import new_place, with_offsets

END_ID = 0
BLOCK_IDS = 2 << 20  # a block is closed at the first document that reaches this
SAMPLE = 256

_BLOCK = "part int, block int, n_ids long, doc_ids binary, no_id binary, ids binary, n int, low_bits int, low binary, high binary, samples binary"


class EliasFano:
    """A sequence of n non-decreasing numbers; ``select`` reads any of them."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, largest = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, int(np.log2((largest + 1) / n))) if n else 0
        low = (values[:, None] >> np.arange(low_bits)) & 1
        ones = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        pack = lambda x: np.packbits(x.astype(np.uint8).ravel(), bitorder="little").tobytes()
        return cls(n, low_bits, pack(low), pack(bits), ones[::SAMPLE].astype("<u4").tobytes())

    def select(self, places: np.ndarray) -> np.ndarray:
        """The numbers at the given places; reads only between the samples around them."""
        places = np.asarray(places, np.int64)
        if not len(places):
            return np.zeros(0, np.int64)
        if places.min() < 0 or places.max() >= self.n:
            raise IndexError("place outside the sequence")
        samples = np.frombuffer(self.samples, "<u4")
        first, last = int(places.min()) // SAMPLE, int(places.max()) // SAMPLE + 1
        begin = int(samples[first])
        end = int(samples[last]) + 1 if last < len(samples) else len(self.high) * 8
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8)[begin // 8 : (end + 7) // 8], bitorder="little")
        ones = np.flatnonzero(bits[begin % 8 :]) + begin
        high = ones[places - first * SAMPLE] - places
        at = places[:, None] * self.low_bits + np.arange(self.low_bits)
        stored = np.frombuffer(self.low, np.uint8)
        low = (stored[at >> 3] >> (at & 7)) & 1 if self.low_bits else np.zeros((len(places), 0), np.int64)
        return (high << self.low_bits) + (low.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


def _close(part: int, block: int, docs: list, ids: list[bytes]) -> pa.RecordBatch:
    ends = np.cumsum([0] + [len(x) // 2 for x in ids])
    code = EliasFano.of(ends)
    row = [
        part, block, int(ends[-1]), np.array([d or 0 for d in docs], "<i8").tobytes(), np.array([d is None for d in docs], np.uint8).tobytes(),
        b"".join(ids), code.n, code.low_bits, code.low, code.high, code.samples,
    ]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.strip().split(" ")[0] for c in _BLOCK.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)


def _blocks(tokenizer: str, block_ids: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, block = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], "<u2").tobytes()
        docs, ids, held = [], [], 0
        for batch in rows:
            numbers = batch["doc_id"].to_pylist()
            for at, some in batches(batch["text"]):
                for i, found in enumerate(encode(some)):
                    docs.append(numbers[at + i])
                    ids.append(found + end)
                    held += len(ids[-1]) // 2
                    if held >= block_ids:
                        yield _close(part, block, docs, ids)
                        docs, ids, held, block = [], [], 0, block + 1
        if docs:
            yield _close(part, block, docs, ids)

    return run


def write(documents: DataFrame, path: str, tokenizer: str, block_ids: int = BLOCK_IDS) -> None:
    """Encode all texts and write their ids in ascending doc_id order."""
    ordered = documents.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_blocks(tokenizer, block_ids), _BLOCK).write.option("compression", "zstd").parquet(path)


def read_blocks(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """The blocks, and for each (part, block) the ids of all blocks before it."""
    blocks = spark.read.schema(_BLOCK).parquet(path)
    parts = with_offsets(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")), "part", "n", "part_base").select("part", "part_base")
    inside = blocks.select("part", "block", "n_ids")
    before = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    bases = inside.withColumn("inner", F.coalesce(before, F.lit(0))).join(parts, "part")
    bases = bases.select("part", "block", (F.col("part_base") + F.col("inner")).cast("long").alias("base"))
    return blocks, bases


def _documents(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for r in batch.to_pylist():
            code = EliasFano(r["n"], r["low_bits"], r["low"], r["high"], r["samples"])
            ends = code.select(np.arange(code.n))
            ids = np.frombuffer(r["ids"], "<u2").astype("<u4")
            null = np.frombuffer(r["no_id"], np.uint8).astype(bool)
            crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            n = code.n - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["part"]] * n, pa.int32()),
                    pa.array([r["block"]] * n, pa.int32()),
                    pa.array(np.frombuffer(r["doc_ids"], "<i8"), pa.int64(), mask=null),
                    pa.array(ends[:-1], pa.int64()),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                ["part", "block", "doc_id", "inner_start", "n_tokens", "ids_crc32"],
            )


def read_digest(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    blocks, bases = read_blocks(spark, path)
    read = blocks.select("part", "block", "doc_ids", "no_id", "ids", "n", "low_bits", "low", "high", "samples")
    docs = read.mapInArrow(_documents, "part int, block int, doc_id long, inner_start long, n_tokens long, ids_crc32 long")
    joined = docs.join(bases, ["part", "block"])
    return joined.select("doc_id", (F.col("base") + F.col("inner_start")).alias("start"), "n_tokens", "ids_crc32")


def document_ids(spark, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this doc_id, read from the blocks that hold it."""

    def pick(rows):
        for batch in rows:
            for r in batch.to_pylist():
                places = np.flatnonzero((np.frombuffer(r["doc_ids"], "<i8") == doc_id) & (np.frombuffer(r["no_id"], np.uint8) == 0))
                code = EliasFano(r["n"], r["low_bits"], r["low"], r["high"], r["samples"])
                for p in places:
                    a, b = code.select([p, p + 1])
                    found = np.frombuffer(r["ids"], "<u2")[a:b].astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([found.tolist()], pa.list_(pa.int32()))], ["ids"])

    return [r[0] for r in spark.read.schema(_BLOCK).parquet(path).mapInArrow(pick, "ids array<int>").collect()]


def digest(documents: DataFrame, tokenizer: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the token files to the shared folder and read the digest back from them."""
    path = new_place(documents.sparkSession, "token-files")
    write(documents, path, tokenizer, block_ids)
    return read_digest(documents.sparkSession, path)
