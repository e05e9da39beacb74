"""Encode and decode text columns with the pair occurrence index (see ``bpe``)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.bpe import coder
from tillroll.llm.encode import batches

# One index serves this many characters of text, so that its arrays stay small.
INDEX_CHARS = 8 << 20


def encode_rows(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids array<int>); null and empty texts have no ids."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            docs = batch["doc_id"]
            for at, some in batches(batch["text"], INDEX_CHARS):
                ids = pa.array(coder(tokenizer).encode(some), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([docs[at : at + len(some)], ids], ["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_rows(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give null."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = [None if ids is None else coder(tokenizer).decode(ids) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def digest(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per row; null texts count as empty."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            docs = batch["doc_id"]
            for at, some in batches(batch["text"], INDEX_CHARS):
                counts, ids, decoded = [], [], []
                for found in coder(tokenizer).pieces(some):
                    counts.append(sum([len(p[0]) for p in found]))
                    # a piece of combining marks alone may have no ids
                    ids.append(hashlib.sha256(" ".join([p[1] for p in found if p[1]]).encode()).hexdigest())
                    decoded.append(hashlib.sha256(" ".join([p[2] for p in found if p[1]]).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [docs[at : at + len(some)], pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
