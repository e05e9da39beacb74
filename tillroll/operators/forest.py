"""Random forests for two classes, grown level by level: one pass over the rows counts for all open nodes of all trees.

Rows are cut into bins once and written. In a pass a task finds each row's node in every tree and counts rows by
node, drawn feature, bin and class; counts are added up by tree, and only the chosen splits reach the driver. A row's
number of draws for a tree comes from a hash of its key, so nothing is kept for each pair of row and tree.

Rules are those of Spark's forest: Gini impurity on weighted classes, draws with replacement, the square root of
the features at each node, splits of at most ``bins`` bins found in a sample of 10,000 rows, leaves that vote with their shares, and
neighbouring leaves for the same class made one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tillroll.session import written

# Rows that a task counts at a time, and those of them that stay in a core's cache; rows of the sample for bins.
CHUNK_ROWS, CACHED_ROWS, SAMPLE_ROWS = 1 << 18, 1 << 14, 10_000

_ONES = math.exp(-1.0)
_UPTO = np.cumsum([_ONES / math.factorial(i) for i in range(16)])
#: Draws with replacement as Poisson numbers of mean one, by 16 bits of a hash.
DRAWS = np.searchsorted(_UPTO, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass
class Tree:
    """Nodes in the order they were made. A row goes to ``left``, or to the node behind it if its bin is above ``cut``.

    A leaf leads to itself, as no bin is above 255. ``count`` has the drawn rows of both classes.
    """

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    count: np.ndarray
    open: np.ndarray  # nodes that the next pass may split

    def place(self, x: np.ndarray, rows: np.ndarray, levels: int) -> np.ndarray:
        """The node of some rows after so many steps; x has a row for each feature."""
        flat, begin = x.reshape(-1), self.feature * np.int32(x.shape[1])
        node = np.zeros(len(rows), np.int32)
        for _ in range(levels):
            at = begin.take(node, mode="clip")
            at += rows
            above = flat.take(at, mode="clip") > self.cut.take(node, mode="clip")
            node = self.left.take(node, mode="clip")
            node += above
        return node


def draws(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often a tree draws each row; keys are hashes as unsigned longs."""
    x = (keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xD1B54A32D192ED03 + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return DRAWS[(x >> np.uint64(48)).astype(np.int64)]


def most_features(features: int) -> int:
    return max(1, math.ceil(math.sqrt(features)))


def drawn_features(seed: int, tree: int, level: int, nodes: int, features: int) -> np.ndarray:
    """The features that each open node may split by, ascending."""
    shuffled = np.random.default_rng([seed, tree, level]).random((nodes, features)).argsort(axis=1)
    return np.sort(shuffled[:, : most_features(features)], axis=1)


def cuts_of(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between neighbouring values: all of them, or those next to even shares of the weight."""
    distinct, place = np.unique(values[~np.isnan(values)], return_inverse=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) < bins:
        return middle
    upto = np.bincount(place, weights[~np.isnan(values)])[:-1].cumsum()
    total = weights[~np.isnan(values)].sum()
    return middle[np.unique([np.abs(upto - total * i / bins).argmin() for i in range(1, bins)])]


def _binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of the rows of x, a row for each feature; a value that equals a cut stays below it, NaN is above all."""
    return np.stack([np.searchsorted(c, v).astype(np.uint8) for c, v in zip(cuts, x.T)]) if len(cuts) else np.zeros((0, len(x)), np.uint8)


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _layout(sub: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """Where the bins of each node's features begin, and how many bins there are."""
    width = sizes[sub]
    ends = width.ravel().cumsum()
    return (ends - width.ravel()).reshape(sub.shape), int(ends[-1])


def _counted(trees: Sequence[Tree], sizes: np.ndarray, level: int, seed: int):
    """Counts of a chunk of rows for each tree with open nodes, in the narrowest numbers that hold them."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK_ROWS:
                yield held
                held, rows = [], 0
        if rows:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in chunks(batches):
            table = pa.Table.from_batches(held).combine_chunks()
            y = table["y"].to_numpy().astype(np.uint16)
            keys = table["key"].to_numpy().view(np.uint64)
            bins = table["bins"].combine_chunks().cast(pa.binary(len(sizes)))
            bins = np.frombuffer(bins.buffers()[1], np.uint8)[: len(y) * len(sizes)].reshape(len(y), len(sizes))
            parts = [slice(at, at + CACHED_ROWS) for at in range(0, len(y), CACHED_ROWS)]
            blocks = [np.ascontiguousarray(bins[p].T) for p in parts]
            marked = [(2 * x.astype(np.uint16) + y[p]).reshape(-1) for p, x in zip(parts, blocks)]  # bin and class in one number
            where = np.empty((len(y), most_features(len(sizes))), np.int64)
            often = np.empty(where.shape)
            for t, tree in enumerate(trees):
                if not len(tree.open):
                    continue
                sub = drawn_features(seed, t, level, len(tree.open), len(sizes))
                base, cells = _layout(sub, sizes)
                sub, base = sub.astype(np.int32), 2 * base
                slot = np.full(len(tree.left), -1, np.int32)
                slot[tree.open] = np.arange(len(tree.open))
                filled = 0
                for p, x, xy in zip(parts, blocks, marked):
                    w = draws(keys[p], seed, t)
                    rows = np.flatnonzero(w).astype(np.int32)
                    at = slot[tree.place(x, rows, level)]
                    if at.min(initial=0) < 0:
                        rows, at = rows[at >= 0], at[at >= 0]
                    found = sub.take(at, axis=0)
                    found *= np.int32(x.shape[1])
                    found += rows[:, None]
                    np.add(base.take(at, axis=0), xy.take(found), out=where[filled : filled + len(rows)])
                    often[filled : filled + len(rows)] = w[rows, None]
                    filled += len(rows)
                count = np.bincount(where[:filled].reshape(-1), often[:filled].reshape(-1), 2 * cells).astype(np.int64)
                kind = next(k for k in (np.uint8, np.uint16, np.uint32) if count.max(initial=0) <= np.iinfo(k).max)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t], pa.int32()), pa.array([np.dtype(kind).itemsize], pa.int32()), pa.array([count.astype(kind).tobytes()], pa.binary())],
                    ["tree", "width", "count"],
                )

    return run


def best_splits(count: np.ndarray, sub: np.ndarray, sizes: np.ndarray, weights: np.ndarray, fewest: int) -> tuple[np.ndarray, ...]:
    """(feature or -1, cut, counts to the left, counts to the right) of each open node from its counts by bin and class."""
    nodes, most = sub.shape
    starts, cells = _layout(sub, sizes)
    width = sizes[sub].ravel()
    owner = np.repeat(np.arange(nodes * most), width)
    dense = np.zeros((nodes * most, int(sizes.max()), 2), np.int64)
    dense[owner, np.arange(cells) - np.repeat(starts.ravel(), width)] = count.reshape(-1, 2)
    left = dense.cumsum(axis=1)
    every = left[:, -1:]
    right = every - left

    def spread(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight, and Gini impurity times weight."""
        weighed = part * weights
        total = weighed.sum(axis=-1)
        return total, total - (weighed**2).sum(axis=-1) / np.where(total > 0, total, 1.0)

    total, whole = spread(every)
    gain = (whole - spread(left)[1] - spread(right)[1]) / np.where(total > 0, total, 1.0)
    gain[(left.sum(axis=-1) < fewest) | (right.sum(axis=-1) < fewest)] = -np.inf
    gain = gain.reshape(nodes, -1)
    take = gain.argmax(axis=1)
    split = gain[np.arange(nodes), take] > 1e-15  # a gain of zero may come out as rounding
    place, cut = np.divmod(take, dense.shape[1])
    flat = np.arange(nodes) * most + place
    feature = np.where(split, sub[np.arange(nodes), place], -1)
    return feature, cut, left[flat, cut], right[flat, cut]


def _chosen(opened: Sequence[int], sizes: np.ndarray, weights: np.ndarray, level: int, seed: int, fewest: int):
    """Counts added up by tree, then the splits of its open nodes. All rows of a tree are in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for t, width, count in zip(*(batch[c].to_pylist() for c in ("tree", "width", "count"))):
                count = np.frombuffer(count, f"u{width}")
                if t in sums:
                    sums[t] += count
                else:
                    sums[t] = count.astype(np.int64)
        for t, count in sums.items():
            sub = drawn_features(seed, t, level, opened[t], len(sizes))
            feature, cut, left, right = best_splits(count, sub, sizes, weights, fewest)
            packed = [feature.astype(np.int32), cut.astype(np.uint8), left, right]
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in packed]], ["tree", "feature", "cut", "l", "r"])

    return run


@dataclass
class Forest:
    """A fitted forest: the cuts of each feature, the trees and the weights of both classes."""

    cuts: list[np.ndarray]
    trees: list[Tree]
    weights: np.ndarray
    depth: int

    def predict(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``label``, ``prediction`` and the class-1 probability as ``score`` of each row."""
        cuts, depth = self.cuts, self.depth
        trees = []
        for tree in self.trees:
            if tree.count[0].any():  # a tree that drew no row has no vote
                weighed = tree.count * self.weights
                trees.append((replace(tree, count=tree.count[:0]), weighed[:, 1] / weighed.sum(axis=1)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _binned(_vectors(batch, len(cuts)), cuts)
                rows = np.arange(x.shape[1])
                score = sum((share[tree.place(x, rows, depth)] for tree, share in trees), np.zeros(len(rows))) / max(len(trees), 1)
                yield pa.RecordBatch.from_arrays([batch["label"], pa.array((score > 0.5).astype(float)), pa.array(score)], ["label", "prediction", "score"])

        return df.select("label", vector_to_array(features).alias("x")).mapInArrow(run, "label double, prediction double, score double")


def supports(model: object, classes: Sequence[float]) -> bool:
    """Whether these are the rules of a Spark estimator, up to its number of trees, depth, smallest node, bins and seed."""
    if not isinstance(model, RandomForestClassifier) or not set(classes) <= {0.0, 1.0}:
        return False
    rules = {"impurity": "gini", "featureSubsetStrategy": "auto", "subsamplingRate": 1.0, "bootstrap": True, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0}
    rules |= {"labelCol": "label", "weightCol": "weight", "featuresCol": "features"}
    same = all(model.isDefined(k) and model.getOrDefault(k) == v for k, v in rules.items())
    return same and model.getNumTrees() > 1 and model.getMaxBins() <= 256 and not model.isDefined("thresholds")


def fit_forest(df: DataFrame, model: RandomForestClassifier, key: str, features: str = "features") -> Forest:
    """A forest with a Spark estimator's settings on rows with ``label``, ``weight`` and a vector; the driver holds the trees."""
    size, depth, fewest, bins, seed = model.getNumTrees(), model.getMaxDepth(), model.getMinInstancesPerNode(), model.getMaxBins(), model.getSeed() % (1 << 32)
    classes = {int(r["label"]): r for r in df.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("w")).collect()}
    rows = sum(r["n"] for r in classes.values())
    weights = np.array([float(classes[c]["w"]) if c in classes else 1.0 for c in (0, 1)])
    hashed = df.select(vector_to_array(features).alias("x"), F.col("label").cast("byte").alias("y"), F.xxhash64(F.lit(seed), key).alias("key"))
    share = max(SAMPLE_ROWS, bins * bins) / rows
    sample = hashed if share >= 1 else hashed.filter(F.pmod("key", F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = sample.select("x", "y").collect()
    x, by = np.array([r["x"] for r in sample]), weights[[r["y"] for r in sample]]
    cuts = [cuts_of(v, by, bins) for v in x.T]
    sizes = np.array([len(c) + 1 for c in cuts])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = np.ascontiguousarray(_binned(_vectors(batch, len(cuts)), cuts).T)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in packed], pa.binary()), batch["y"], batch["key"]], ["bins", "y", "key"])

    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(min(cores, math.ceil(rows / 1000)), math.ceil(rows / CHUNK_ROWS))  # counts leave a task once for each chunk
    binned = written(hashed.repartition(parts, "key").mapInArrow(cut, "bins binary, y byte, key long"))
    start = lambda: Tree(np.zeros(1, np.uint16), np.full(1, 255, np.uint8), np.zeros(1, np.int32), np.zeros((1, 2), np.int64), np.zeros(1, np.int64))
    trees = [start() for _ in range(size)]
    for level in range(depth):
        opened = [len(t.open) for t in trees]
        if not any(opened):
            break
        paths = [replace(t, count=t.count[:0]) for t in trees]
        counts = binned.mapInArrow(_counted(paths, sizes, level, seed), "tree int, width int, count binary")
        counts = counts.repartition(min(size, 2 * cores), "tree")
        found = counts.mapInArrow(_chosen(opened, sizes, weights, level, seed, fewest), "tree int, feature binary, cut binary, l binary, r binary")
        for r in found.collect():  # a few bytes for each open node
            left, right = (np.frombuffer(r[c], np.int64).reshape(-1, 2) for c in "lr")
            _split(trees[r["tree"]], np.frombuffer(r["feature"], np.int32), np.frombuffer(r["cut"], np.uint8), left, right, level + 1 < depth, fewest)
    for tree in trees:
        _prune(tree, weights)
    return Forest(cuts, trees, weights, depth)


def _split(tree: Tree, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray, deeper: bool, fewest: int) -> None:
    """Put the children of this pass behind the nodes; those that are pure, too small or at the last level are leaves."""
    if len(tree.left) == 1:
        tree.count[0] = left[0] + right[0]
    split = feature >= 0
    parents, behind = tree.open[split], len(tree.left)
    tree.feature[parents], tree.cut[parents] = feature[split], cut[split]
    tree.left[parents] = behind + 2 * np.arange(len(parents))
    count = np.stack([left[split], right[split]], axis=1).reshape(-1, 2)
    numbers = behind + np.arange(len(count))
    tree.feature = np.concatenate([tree.feature, np.zeros(len(count), np.uint16)])
    tree.cut = np.concatenate([tree.cut, np.full(len(count), 255, np.uint8)])
    tree.left = np.concatenate([tree.left, numbers.astype(np.int32)])
    tree.count = np.concatenate([tree.count, count])
    more = deeper & (count.min(axis=1) > 0) & (count.sum(axis=1) >= 2 * fewest)
    tree.open = numbers[more] if deeper else numbers[:0]


def _prune(tree: Tree, weights: np.ndarray) -> None:
    """Make a leaf of each node whose children are leaves for the same class, from the last ones upwards."""
    weighed = tree.count * weights
    voted, number = weighed[:, 1] > weighed[:, 0], np.arange(len(tree.left))
    while True:
        leaf = tree.left == number
        inner = number[~leaf]
        first = tree.left[inner]
        alike = inner[leaf[first] & leaf[first + 1] & (voted[first] == voted[first + 1])]
        if not len(alike):
            return
        tree.feature[alike], tree.cut[alike], tree.left[alike] = 0, 255, alike
