"""Exact top-k by inner product: tiles of queries and shards, lists per tile, merged as a tree.

Vectors are packed into shards and queries into blocks of bounded size; every (block, shard) pair is
one tile with a key of its own, so no task holds more than a tile. A tile multiplies its matrices in
numpy and keeps each query's best k. Lists of FAN_IN neighbouring shards are merged at a time. Tiles
meet in a merge join: the planner does not see that a block is repeated for each shard, and would
send all repeats through the driver.

Vectors that are null, or hold null or non-finite components, take no part, nor do rows without an
id. A vector is compared only with vectors of its own length. Candidates are all rows whose id is not
the query's; a repeated row is a candidate each time, a repeated query gets a list each time. Ties go
to the smaller id. Scores beyond 2**63 raise an error. No queries or no vectors: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# A shard or block has about so many rows and bytes at most; it is cut down to FEW_ROWS rows for more cores.
SHARD_ROWS = BLOCK_ROWS = 1 << 14
SIDE_BYTES, FEW_ROWS = 1 << 23, 1 << 11
# Queries that one step scores; neighbouring rows of which the best score is looked at first.
TILE_ROWS, STRETCH = 256, 64
FAN_IN = 16

_TILE = "block int, dim int, shard int, no int, query_id long, found array<struct<worse: long, vec_id: long>>"


def scaled(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x taken as double."""
    return F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(embedding: Column) -> Column:
    """No null, NaN or infinite component."""
    infinite = F.lit(float("inf"))
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return embedding.isNotNull() & F.coalesce(fine, F.lit(False))


def _packed(vectors: DataFrame, into: str, parts: int, name: str) -> DataFrame:
    return (
        vectors.groupBy(F.col("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(into))
        .agg(F.array_sort(F.collect_list(F.struct("vec_id", "values"))).alias(name))
    )


def _matrix(lists, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and values of one packed row."""
    rows = lists.values
    ids = rows.field("vec_id").to_numpy(zero_copy_only=False)
    return ids, rows.field("values").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query, places of its best k rows (ids ascending) and their scores, best first."""
    n, dim = rows.shape
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(dim, 1)
    if top >= 2.0**63:
        raise OverflowError("an inner product may exceed 64 bits")
    parts = -(-n // STRETCH)
    exact = (top + 1) * (parts * STRETCH) < 2.0**52
    kind = np.int64 if not exact else np.float32 if top < 2.0**24 else np.float64  # sums of whole numbers below 2**24 are exact
    right = np.zeros((dim, parts * STRETCH if exact else n), kind)
    right[:, :n] = rows.T
    first, last = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    for at in range(0, len(queries), TILE_ROWS):
        part = queries[at : at + TILE_ROWS].astype(kind)
        scores = part @ right
        own = [(i, first[at + i], last[at + i]) for i in np.flatnonzero(last[at : at + TILE_ROWS] > first[at : at + TILE_ROWS])]
        if exact:
            scores[:, n:] = -np.inf
            for i, a, b in own:
                scores[i, a:b] = -np.inf
            yield from _selected(scores, k)
            continue
        for i in range(len(part)):
            order = np.argsort(-scores[i], kind="stable")
            if last[at + i] > first[at + i]:
                order = order[(order < first[at + i]) | (order >= last[at + i])]
            yield order[:k], scores[i, order[:k]]


def _selected(scores: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The best k places of each row and their scores; the smaller place wins ties, those at -inf take no part.

    They lie in the k stretches with the best scores (the earlier of equal ones), as each stretch that is
    ahead of another holds a place that is ahead of all places of the other.
    """
    m, n = scores.shape
    parts = n // STRETCH

    def leading(value: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
        """Columns of the best k; score and place in one number, so that all are distinct."""
        key = value.astype(np.float64) * size - place
        most = min(k, key.shape[1])
        return np.argpartition(-key, most - 1, axis=1)[:, :most] if 0 < most < key.shape[1] else np.broadcast_to(np.arange(most), (m, most))

    ahead = leading(scores.reshape(m, parts, STRETCH).max(axis=2), np.arange(parts), parts)
    places = (ahead[:, :, None] * STRETCH + np.arange(STRETCH)).reshape(m, -1)
    values = np.take_along_axis(scores, places, 1)
    take = leading(values, places, n)
    places, values = np.take_along_axis(places, take, 1), np.take_along_axis(values, take, 1)
    order = np.lexsort((places, -values), axis=1)
    places, values = np.take_along_axis(places, order, 1), np.take_along_axis(values, order, 1)
    for i, there in enumerate(values > -np.inf):
        yield places[i, there], values[i, there].astype(np.int64)


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim = batch["dim"][r].as_py()
                query_ids, queries = _matrix(batch["queries"][r], dim)
                ids, rows = _matrix(batch["rows"][r], dim)
                places, scores = zip(*best(queries, query_ids, rows, ids, k))
                ends = np.cumsum([0, *(len(p) for p in places)])
                hits = pa.StructArray.from_arrays([pa.array(-np.concatenate(scores)), pa.array(ids[np.concatenate(places)])], ["worse", "vec_id"])
                n = len(query_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch["block"][r].as_py()] * n, pa.int32()),
                        pa.array([dim] * n, pa.int32()),
                        pa.array([batch["shard"][r].as_py()] * n, pa.int32()),
                        pa.array(np.arange(n), pa.int32()),
                        pa.array(query_ids, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hits),
                    ],
                    ["block", "dim", "shard", "no", "query_id", "found"],
                )

    return run


def side_count(rows: int, numbers: int, most_rows: int, fewest: int) -> int:
    """How many shards or blocks so many vectors with so many components in all are dealt into; fewest only as far as they are not tiny."""
    return max(1, math.ceil(rows / most_rows), math.ceil(8 * numbers / SIDE_BYTES), min(fewest, rows // FEW_ROWS))


def search(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``vectors`` (vec_id long, values array<long>)."""
    vectors = vectors.filter(F.col("vec_id").isNotNull()).withColumn("dim", F.size("values"))
    long = F.col("dim").cast("long")
    n, wide, queries, query_wide = vectors.agg(F.count("*"), F.sum(long), F.count_if(is_query), F.sum(F.when(is_query, long))).first()
    blocks = side_count(queries, query_wide or 0, block_rows, 1)
    shards = side_count(n, wide or 0, shard_rows, math.ceil(4 * vectors.sparkSession.sparkContext.defaultParallelism / blocks))
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = _packed(vectors, "shard", shards, "rows").withColumn("block", numbers(blocks))
    right = _packed(vectors.filter(is_query), "block", blocks, "queries").withColumn("shard", numbers(shards))
    found = left.hint("merge").join(right.hint("merge"), ["dim", "block", "shard"]).select("block", "dim", "shard", "queries", "rows").mapInArrow(_tiles(k), _TILE)
    while True:  # the tree has log(shards) levels
        found = (
            found.groupBy("block", "dim", "no", "query_id", F.floor(F.col("shard") / FAN_IN).alias("shard"))
            .agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
        )
        shards = math.ceil(shards / FAN_IN)
        if shards <= 1:
            break
    return found.select("query_id", F.posexplode("found").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.worse")).alias("score")
    )


def digest(embeddings: DataFrame, k: int = 5) -> DataFrame:
    """The k best rows for each query row: ids divisible by 50 against all other rows."""
    vectors = embeddings.filter(usable(F.col("embedding"))).select(F.col("vec_id").cast("long"), scaled(F.col("embedding")).alias("values"))
    return search(vectors, F.col("vec_id") % 50 == 0, k)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
