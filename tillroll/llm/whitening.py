"""Embedding whitening with eigenvectors refined from float32 to double precision.

Distinct vectors are counted and summed, then centred on their rounded mean and multiplied block by
block in the tasks. Entries are whole numbers, so the sums are exact whatever their order, and the
covariance is correct to the last place. Its eigenvectors start in float32 on the driver (a matrix of
the vectors' dimension) and are corrected by the matrix-multiplication iteration of Ogita and Aishima
in extended precision. Inside a cluster of eigenvalues that the iteration cannot part, a small problem
of the cluster's own, shifted by its mean, turns the basis before the iteration goes on.

Vectors that are null, or hold null or non-finite entries, or entries whose scaled floor exceeds 2**62 in
size, take no part. Vectors of different lengths are whitened each with their own length (one fit per
length). Repeated rows count once in the fit and are all returned. Components without variance (equal
vectors, fewer distinct vectors than dimensions) have whitened null; explained is null if nothing varies.
identity_error is over the components that have variance, null if there are none. deviation is exact as
decimal, null beyond 38 digits; the query's long is null beyond 2**63. Vectors of length 0 have no components. Rows with null
vec_id are whitened like others. No vectors: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.shared import kept

SCALE = 256
COMPONENTS = 4
BLOCK = 4096  # vectors multiplied at a time
ROUNDS = 16
LOW = (1 << 60) - 1  # sums travel in two parts, so that no size of entries overflows
APART = 64  # a pair is parted by the iteration if its gap is this much larger than what pulls it together

_DECIMAL = pa.decimal128(38, 0)
_SUM = "dim int, place int, high decimal(38,0), low decimal(38,0)"


# --- eigenvectors on the driver -------------------------------------------------------------------


def _normed(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=0))


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Columns that are nearly orthonormal, made so by multiplications only."""
    for _ in range(2):
        x = x @ (1.5 * np.eye(x.shape[1], dtype=x.dtype) - (x.T @ x) / 2)
    return x


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima correction: (new basis, eigenvalues, pairs that it cannot part, size of the change)."""
    n = len(a)
    r = np.eye(n, dtype=x.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diagonal(s) / (1 - np.diagonal(r))
    pull = s - np.diag(np.diagonal(s)) + values[None, :] * r
    gap = values[None, :] - values[:, None]
    most = np.maximum(np.abs(pull), np.abs(pull.T))
    near = np.abs(gap) <= APART * np.maximum(most, _fine(n))
    e = np.where(near, r / 2, pull / np.where(near, 1, gap))
    np.fill_diagonal(near, False)
    near &= most > _fine(n)
    return x + x @ e, values, near, float(np.abs(e).max(initial=0))


def _fine(n: int) -> float:
    return 16 * n * float(np.finfo(np.longdouble).eps)


def _clusters(near: np.ndarray) -> list[tuple[int, int]]:
    """Runs [a, b) of places that hold every near pair (places in falling order of eigenvalues)."""
    n = len(near)
    reach = np.where(near.any(axis=1), n - 1 - near[:, ::-1].argmax(axis=1), np.arange(n))
    runs, first, last = [], 0, 0
    for i in range(n):
        if i > last:
            runs.append((first, last + 1))
            first = i
        last = max(last, i, int(reach[i]))
    return [(a, b) for a, b in [*runs, (first, last + 1)] if b - a > 1]


def eigen(a: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix of extended precision."""
    exact = np.longdouble
    a = np.asarray(a, exact)
    a = (a + a.T) / 2
    n = len(a)
    size = np.abs(a).max(initial=0)
    if not n or size == 0:
        return np.zeros(n, exact), np.eye(n, dtype=exact)
    a = a / size
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start[:, ::-1].astype(exact)
    last = np.inf
    for _ in range(rounds):
        x, values, near, change = _step(a, x)
        order = np.argsort(-values, kind="stable")
        x, near = x[:, order], near[np.ix_(order, order)]
        groups = _clusters(near)
        for i, j in groups:  # sub-solve: the cluster's own matrix, shifted so that its gaps are large in it
            own = _orthonormal(x[:, i:j])
            inside = own.T @ (a @ own)
            inside = (inside + inside.T) / 2 - np.eye(j - i, dtype=exact) * np.diagonal(inside).mean()
            _, turn = np.linalg.eigh((inside / max(np.abs(inside).max(), np.finfo(exact).tiny)).astype(np.float64))
            x[:, i:j] = own @ turn[:, ::-1].astype(exact)
        # what is left where gaps are narrow is rounding over gap
        if not groups and (change < _fine(n) or last / 4 < change < 1e-8):
            break
        last = change
    x = _normed(_orthonormal(x))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


# --- sums in the tasks ----------------------------------------------------------------------------


def _floors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whole numbers of all entries, first entry of each row and the end, usable rows)."""
    sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    flat = column.flatten()
    empty = np.asarray(flat.is_null(), bool)
    entries = np.floor(SCALE * np.asarray(flat.fill_null(0), np.float64))
    bad = empty | ~(np.abs(entries) <= 2.0**62)
    count = np.concatenate([[0], np.cumsum(bad)])
    usable = ~np.asarray(column.is_null(), bool) & (count[ends[1:]] == count[ends[:-1]])
    return np.where(bad, 0, entries).astype(np.int64), ends, usable


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, x) of usable rows of (vec_id, embedding); x holds the whole numbers as bytes.

    The width of a number, 1, 2, 4 or 8 bytes, is the least that fits the vector and stands first, so
    equal vectors have equal bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends, usable = _floors(batch["embedding"])
            ids, dims, out = batch["vec_id"].filter(pa.array(usable)), [], []
            for r in np.flatnonzero(usable).tolist():
                own = flat[ends[r] : ends[r + 1]]
                top = int(np.abs(own).max(initial=0))
                width = 1 if top < 128 else 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
                dims.append(len(own))
                out.append(bytes([width]) + own.astype(f"<i{width}").tobytes())
            yield pa.RecordBatch.from_arrays([ids, pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dim", "x"])

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, dim int, x binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """(dimension, matrix of whole numbers, its rows) for vectors of one length each."""
    for batch in batches:
        dims = batch["dim"].to_numpy()
        for dim in np.unique(dims).tolist():
            rows = batch.filter(pa.array(dims == dim))
            for at in range(0, len(rows), BLOCK):
                part = rows.slice(at, BLOCK)
                raw = part["x"].to_pylist()
                x = np.empty((len(raw), dim), np.int64)
                for i, b in enumerate(raw):
                    x[i] = np.frombuffer(b, f"<i{b[0]}", offset=1)
                yield dim, x, part


def _decimals(values) -> pa.Array:
    """Null beyond 38 digits."""
    return pa.array([Decimal(int(v)) if abs(v) < 10**38 else None for v in values], _DECIMAL)


def _totals(rows: DataFrame, of_block, dims: set[int] | None = None) -> dict[int, list[int]]:
    """Exact sums of what ``of_block`` (dim, matrix) -> whole numbers gives, by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for dim, x, _ in _blocks(batches):
            found = of_block(dim, x)
            total[dim] = total[dim] + found if dim in total else found
        for dim, sums in total.items():
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, dim), pa.int32()), pa.array(np.arange(n), pa.int32()), _decimals(v >> 60 for v in sums), _decimals(v & LOW for v in sums)],
                ["dim", "place", "high", "low"],
            )

    sums = rows.mapInArrow(run, _SUM).groupBy("dim", "place").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    out: dict[int, dict[int, int]] = {}
    for r in sums.toLocalIterator():  # at most dim * (dim + 1) / 2 rows a dimension
        out.setdefault(r["dim"], {})[r["place"]] = (int(r["high"]) << 60) + int(r["low"])
    return {dim: [places[i] for i in range(len(places))] for dim, places in out.items()}


def _exact_sum(x: np.ndarray) -> np.ndarray:
    """Column sums as Python numbers where 64 bits might not hold them."""
    if int(np.abs(x).max(initial=0)) * max(len(x), 1) < 1 << 62:
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)


def _exact_products(y: np.ndarray) -> np.ndarray:
    """Upper triangle of y.T @ y, exact."""
    top = int(np.abs(y).max(initial=0))
    if top * top * max(len(y), 1) < 1 << 53:
        z = y.astype(np.float64)
        full = (z.T @ z).astype(np.int64)
    else:
        z = y.astype(object)
        full = z.T @ z
    return full[np.triu_indices(y.shape[1])].astype(object)


@dataclass
class Fit:
    """One whitening: of ``n`` distinct vectors with column sums ``sums``."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # a column per component
    values: np.ndarray  # eigenvalues
    explained: np.ndarray  # NaN if nothing varies
    error: float | None = None  # of the whitened covariance against the identity

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN for components without variance."""
        mean = np.array([s / self.n for s in self.sums])
        scale = np.where(self.values > 0, np.sqrt(np.where(self.values > 0, self.values, 1)), np.nan)
        return (x - mean) @ self.vectors / scale

    def deviations(self, x: np.ndarray) -> list[int]:
        top = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        exact = top * top * max(x.shape[1], 1) < 1 << 63
        kind = np.int64 if exact else object
        d = self.n * x.astype(kind) - np.array(self.sums, kind)
        return (d * d).sum(axis=1).tolist()


def solve(n: int, sums: list[int], centre: list[int], products: list[int], components: int) -> Fit:
    """The leading eigenvectors of the exact covariance; products are of vectors less ``centre``."""
    dim = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre)]
    v = np.zeros((dim, dim), np.longdouble)
    square = np.longdouble(n) * np.longdouble(n)
    for k, (i, j) in enumerate(zip(*np.triu_indices(dim))):
        v[i, j] = v[j, i] = _extended(n * products[k] - rest[i] * rest[j]) / square
    values, vectors = eigen(v)
    trace = np.trace(v)
    keep = min(components, dim)
    none = values[:keep] <= trace * dim * np.finfo(np.float64).eps  # below the rank: no variance
    return Fit(
        n,
        sums,
        vectors[:, :keep].astype(np.float64),
        np.where(none, 0, values[:keep]).astype(np.float64),
        (values[:keep] / trace).astype(np.float64) if trace > 0 else np.full(keep, np.nan),
    )


def _extended(number: int) -> np.longdouble:
    """A Python number in extended precision: high and low parts are converted apart."""
    high, low = divmod(abs(number), 1 << 53)
    high, middle = divmod(high, 1 << 53)
    found = (np.longdouble(high) * np.longdouble(2.0**53) + np.longdouble(middle)) * np.longdouble(2.0**53) + np.longdouble(low)
    return -found if number < 0 else found


def _whitened_moments(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Largest entry of |covariance - identity| of the whitened fit list, by dimension.

    Each block is centred on its own mean before it is multiplied; means and products are then merged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, tuple] = {}
        for dim, x, _ in _blocks(batches):
            z = fits[dim].whitened(x)
            z = z[:, ~np.isnan(z).any(axis=0)]
            mean = z.mean(axis=0)
            merged[dim] = _merged(merged.get(dim), (len(z), mean, (z - mean).T @ (z - mean)))
        for dim, (n, mean, products) in merged.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())), pa.array([products.ravel().tolist()], pa.list_(pa.float64()))],
                ["dim", "n", "mean", "products"],
            )

    parts: dict[int, tuple] = {}
    found = rows.mapInArrow(run, "dim int, n long, mean array<double>, products array<double>")
    for r in found.toLocalIterator():  # a small row per task and dimension
        k = len(r["mean"])
        parts[r["dim"]] = _merged(parts.get(r["dim"]), (r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(k, k)))
    return {dim: float(np.abs(products / n - np.eye(len(mean))).max()) for dim, (n, mean, products) in parts.items() if len(mean)}


def _merged(a: tuple | None, b: tuple) -> tuple:
    if a is None:
        return b
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """A fit for each length of (dim, x), the distinct vectors."""
    counts = _totals(distinct, lambda dim, x: np.concatenate([np.array([len(x)], object), _exact_sum(x)]))
    centres = {dim: [round(s / c[0]) for s in c[1:]] for dim, c in counts.items()}

    def products(dim: int, x: np.ndarray) -> np.ndarray:
        centre = centres[dim]
        small = max([int(np.abs(x).max(initial=0)), *map(abs, centre)]) < 1 << 61
        y = x - np.array(centre, np.int64) if small else x.astype(object) - np.array(centre, object)
        return _exact_products(y)

    found = _totals(distinct, products)
    fits = {dim: solve(c[0], c[1:], centres[dim], found[dim], components) for dim, c in counts.items() if dim}
    if fits:
        for dim, error in _whitened_moments(distinct.filter("dim > 0"), fits).items():
            fits[dim].error = error
    return fits


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row and component."""
    rows = kept(scaled(vectors), "scaled").filter("dim > 0")
    distinct = kept(rows.select("dim", "x").distinct(), "distinct")
    fits = fit(distinct, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, x, part in _blocks(batches):
            own = fits[dim]
            k, n = len(own.values), len(x)
            each = np.repeat(np.arange(n), k)
            z = own.whitened(x).ravel()
            explained = np.tile(own.explained, n)
            yield pa.RecordBatch.from_arrays(
                [
                    part["vec_id"].take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                    pa.array(np.full(n * k, own.n), pa.int64()),
                    _decimals(own.deviations(x)).take(pa.array(each)),
                    pa.array(z, pa.float64(), mask=np.isnan(z)),
                    pa.array(explained, pa.float64(), mask=np.isnan(explained)),
                    pa.array([own.error] * (n * k), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


def digest(embeddings: DataFrame) -> DataFrame:
    return whitened(embeddings).withColumn("deviation", F.col("deviation").try_cast("long"))
