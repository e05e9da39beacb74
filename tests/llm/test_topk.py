import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from tillroll.llm import topk

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("shard", T.StringType())])


def brute(rows, k=5):
    fine = [(i, [math.floor(256.0 * float(np.float32(x))) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, a in fine:
        if q % 50 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def vectors(n=400):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 4]) for i in range(n)]  # many ties
    rows += [(1000, None), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1100, [float("nan")] * 6), (1150, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(1200, [0.5, 0.25]), (1201, [0.5, 0.5]), (1250, []), (2000, [0.3] * 6)]
    rows += [(3000 + i, [0.7] * 6) for i in range(300)]  # one common vector
    return rows


@pytest.mark.parametrize("shard_rows,block_rows", [(8192, 4096), (20, 7), (1, 2)])
def test_equals_brute_force(spark, shard_rows, block_rows):
    rows = vectors(120 if shard_rows == 1 else 400)
    if shard_rows == 1:
        rows = [r for r in rows if r[0] is None or r[0] < 2500]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    usable = df.filter(topk.usable(F.col("embedding"))).select("vec_id", topk.scaled(F.col("embedding")).alias("values"))
    got = topk.search(usable, F.col("vec_id") % 50 == 0, 5, shard_rows, block_rows).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_query_and_empty(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert sorted(tuple(r) for r in topk.digest(df).collect()) == brute(rows)
    assert topk.digest(df.limit(0)).count() == 0
    one = spark.createDataFrame([(50, [1.0], "x")], SCHEMA)
    assert topk.digest(one).count() == 0  # nothing but itself


def test_large_components_stay_exact():
    rng = np.random.default_rng(1)
    q, rows = rng.integers(-(2**29), 2**29, (3, 4)), rng.integers(-(2**29), 2**29, (30, 4))
    for (places, scores), a in zip(topk.best(q, np.full(3, -1), rows, np.arange(30), 5), q):
        want = sorted((-sum(int(x) * int(y) for x, y in zip(a, b)), i) for i, b in enumerate(rows))[:5]
        assert [(-int(s), int(p)) for p, s in zip(places, scores)] == want
    with pytest.raises(OverflowError):
        list(topk.best(q * 2**40, np.full(3, -1), rows * 2**40, np.arange(30), 5))


def test_tiles_are_not_broadcast(spark):
    """A block is repeated for each shard after its size is estimated, so a broadcast would hold all repeats in the driver."""
    df = spark.createDataFrame([(*r, "x") for r in vectors()], SCHEMA)
    found = topk.digest(df)
    assert found.count() > 0
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_shards_are_bounded_in_rows_and_bytes():
    assert topk.side_count(720_000, 720_000 * 64, topk.SHARD_ROWS, 1) == 44
    assert topk.side_count(720_000, 720_000 * 1024, topk.SHARD_ROWS, 1) == 704
    assert topk.side_count(10_000, 10_000 * 64, topk.SHARD_ROWS, 24) == 4 and topk.side_count(0, 0, topk.SHARD_ROWS, 24) == 1


def test_ties_across_stretches_go_to_the_smaller_id():
    rng = np.random.default_rng(2)
    rows, q = rng.integers(-1, 2, (1000, 2)), rng.integers(-1, 2, (9, 2))
    for scale in (1, 2**13, 2**22):  # float32, float64, int64
        for (places, scores), a, own in zip(topk.best(q * scale, np.arange(9) * 40, rows * scale, np.arange(1000), 7), q, range(9)):
            want = sorted((-int(a @ b) * scale * scale, i) for i, b in enumerate(rows) if i != own * 40)[:7]
            assert [(-int(s), int(p)) for p, s in zip(places, scores)] == want
