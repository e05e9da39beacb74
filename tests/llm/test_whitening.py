import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from tillroll.llm import whitening
from tillroll.llm.queries import QUERIES

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("dim", T.StringType()), T.StructField("x", T.StringType())]
)


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "d", "x") for i, e in rows], SCHEMA).repartition(5)


def brute(rows, most=4):
    """{vec_id: [(n, deviation, |whitened| by component, explained)]} in plain Python and float64."""
    fine = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in e)) for i, e in rows if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    out = []
    for dim in {len(x) for _, x in fine} - {0}:
        own = [(i, x) for i, x in fine if len(x) == dim]
        fit = np.array(sorted({x for _, x in own}), dtype=object)
        n, sums = len(fit), fit.sum(axis=0)
        mean = np.array([s / n for s in sums])
        v = np.cov(fit.astype(float).T, bias=True).reshape(dim, dim)
        e, vectors = np.linalg.eigh(v)
        e, vectors = e[::-1], vectors[:, ::-1]
        for i, x in own:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            for k in range(min(most, dim)):
                flat = e[k] <= np.trace(v) * dim * 2.3e-16
                z = None if flat else abs(float((np.array(x, float) - mean) @ vectors[:, k]) / math.sqrt(e[k]))
                out.append((i, k + 1, n, deviation, z, e[k] / np.trace(v) if np.trace(v) else None))
    return out


def compare(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0] if r[0] is not None else -1, r[2], r[1], r[3])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:4] == w[:4]
        for a, b in zip(g[4:6], w[4:6]):
            assert (a is None) == (b is None)
            assert a is None or abs(abs(a) - b) < 1e-6 * max(1, b)


def rows_of(df):
    return [tuple(r) for r in df.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()]


def vectors(n=300, dim=9):
    rng = np.random.default_rng(4)
    scale = np.linspace(2, 0.3, dim)
    return [(i, [float(c) for c in np.float32(rng.normal(size=dim) * scale)]) for i in range(n)]


def test_equals_brute_force_with_awkward_rows(spark):
    rows = vectors()
    rows += [(5000 + i, rows[7][1]) for i in range(200)] + [rows[3]]  # one common vector, a row twice
    rows += [(6001, None), (6002, [1.0, None] + [0.0] * 7), (6003, [float("nan")] * 9), (6004, [float("inf")] * 9), (6005, [1e30] * 9), (None, rows[9][1])]
    rows += [(7000, []), (7001, [-0.0, 0.5]), (7002, [0.25, 0.5])]
    got = rows_of(whitening.digest(frame(spark, rows)))
    compare(got, brute([r for r in rows if r[0] != 6005]))
    errors = {r[2]: r[6] for r in got}
    assert set(errors) == {300, 2} and all(x < 1e-9 for x in errors.values())
    # a component has one sign for all rows
    own = sorted((r[0], r[4]) for r in got if r[1] == 1 and r[2] == 300 and (r[0] or 0) < 300 and r[0] is not None)
    fit = np.array([[math.floor(256 * c) for c in e] for _, e in vectors()])
    want = np.linalg.eigh(np.cov(fit.T, bias=True))[1][:, -1]
    line = (fit - fit.mean(axis=0)) @ want
    ours = np.array([dict(own)[i] for i in range(300)])
    assert abs(abs(np.corrcoef(line, ours)[0, 1]) - 1) < 1e-12


def test_no_variance_and_empty(spark):
    same = rows_of(whitening.digest(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])))
    assert sorted(same) == [(i, k, 1, 0, None, None, None) for i in (1, 2) for k in (1, 2)]
    assert whitening.digest(frame(spark, vectors(3)).limit(0)).count() == 0
    line = rows_of(whitening.digest(frame(spark, [(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 1.0]), (3, [2.0, 2.0, 2.0])])))
    assert [r[4] is None for r in sorted(line)] == [False, True, True] * 3
    assert all(r[6] < 1e-9 for r in line)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**40 + i * 2**20), float(i % 7) * 2.0**46]) for i in range(40)]
    got = whitening.whitened(frame(spark, rows)).collect()
    compare([(r["vec_id"], r["component"], r["n"], int(r["deviation"]), r["whitened"], r["explained"]) for r in got], brute(rows))
    assert whitening.digest(frame(spark, rows)).filter(F.col("deviation").isNull()).count() > 0  # beyond 64 bits


def basis(n, rng):
    q = np.linalg.qr(rng.normal(size=(n, n)))[0].astype(np.longdouble)
    return whitening._orthonormal(q)


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1, 0.5],
        [3 + 1e-9, 3, 3 - 1e-9, 1, 1e-3, 0],  # a cluster that float32 cannot part
        [2 + 3e-13, 2 + 2e-13, 2 + 1e-13, 2, 1, 1],
        [1, 1, 1, 1, 0, 0],
        [1, 1e-6, 1e-12, 0, 0, 0],
    ],
)
def test_refined_eigenvectors(values):
    q = basis(len(values), np.random.default_rng(5))
    want = np.array(values, np.longdouble)
    a = (q * want) @ q.T
    found, x = whitening.eigen(a)
    eps = float(np.finfo(np.longdouble).eps)
    assert np.abs(found - want).max() < 100 * eps * want[0]
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 100 * eps
    assert np.abs(a @ x - x * found).max() < 1000 * eps
    gaps = np.array([min(abs(v - u) for j, u in enumerate(want) if j != i) for i, v in enumerate(want)])
    for i, gap in enumerate(gaps):
        if gap > 0:
            assert 1 - abs((q[:, i] * x[:, i]).sum()) < max((1e3 * eps / gap) ** 2, 100 * eps)


def test_query_runs_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op13_whitening"](spark, folder)
    raw = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(rows_of(got), brute([tuple(r) for r in raw]))
