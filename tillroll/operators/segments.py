"""Customer segments: K-Means sweep and labels, projection, cluster profiles and quality."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.functions.columns import safe_divide
from tillroll.functions.ranks import column_quantiles
from tillroll.schema import K_RANGE, RFM_COLUMNS, SEED, require

# Columns of the profile table in order.
PROFILE_COLUMNS = [
    "cluster",
    "customer_count",
    "pct_of_customers",
    "mean_recency",
    "median_recency",
    "mean_frequency",
    "median_frequency",
    "mean_monetary",
    "median_monetary",
    "total_monetary",
    "pct_of_total_revenue",
]


START_ROWS = 4096  # points that starting centres are drawn from

# Plain distances between all points: rows of a block and how many neighbouring blocks a task takes as one, the fewest
# rows that a block is cut down to for more cores, partitions at most, and the tile of distances that one step computes.
BLOCK_ROWS, SPAN, FEW_ROWS, MOST_TASKS = 1 << 15, 4, 256, 4096
TILE_ROWS, TILE_COLUMNS = 128, 512
# Squared distances below this share of a tile's squared reach are taken from differences, not from a product.
NEAR = 1e-6


def check_vectors(df: DataFrame, features: str) -> None:
    if features not in df.columns or not isinstance(df.schema[features].dataType, VectorUDT):
        raise ValueError(f"{features} must be a vector column")


@dataclass
class Centres:
    """A fitted segmentation: its centres, a row each, and the summed squared distance to the nearest one."""

    centres: np.ndarray
    cost: float

    @property
    def k(self) -> int:
        return len(self.centres)

    def label(self, df: DataFrame, features: str = "features") -> DataFrame:
        """The rows with the place of the nearest centre as ``Cluster``; the first wins ties."""
        x = vector_to_array(features)
        away = F.array(*[_squares(x[i] - F.lit(float(v)) for i, v in enumerate(c)) for c in self.centres])
        return df.withColumn("_away", away).withColumn("Cluster", (F.array_position("_away", F.array_min("_away")) - 1).cast("int")).drop("_away")


def starting_centres(points: DataFrame, seeds: Sequence[tuple[int, int]], rows: int = START_ROWS) -> list[np.ndarray]:
    """For each (k, seed) k starting centres: distance-weighted draws among ``rows`` distinct points,
    chosen by hash, improved on those points alone."""
    some = points.distinct().orderBy(F.xxhash64("x"), "x").limit(rows).collect()  # bounded by ``rows``
    x = np.array([r["x"] for r in some])
    out = []
    for k, seed in seeds:
        if len(x) < k:
            raise ValueError(f"{k} segments need at least as many distinct points, found {len(x)}")
        rng = np.random.default_rng(seed)
        chosen = [int(rng.integers(len(x)))]
        near = ((x - x[chosen[0]]) ** 2).sum(axis=1)
        while len(chosen) < k:
            chosen.append(int(rng.choice(len(x), p=near / near.sum())))
            near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        centres = x[chosen]
        for _ in range(100):  # settled among the drawn points, so that few passes over all points are left
            near = np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1).argmin(axis=1)
            moved = np.stack([x[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(k)])
            if np.allclose(moved, centres, atol=1e-6):
                break
            centres = moved
        out.append(centres)
    return out


def _nearest(x: np.ndarray, centres: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each model (rows ``cuts[i]`` to ``cuts[i + 1]`` of ``centres``) the nearest centre of each point, the first
    among equals, and the squared distance to it. Points are columns of ``x``; buffers are reused, so nothing is copied."""
    away, gap = np.empty(x.shape[1]), np.empty(x.shape[1])
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        best, place = np.full(x.shape[1], np.inf), np.zeros(x.shape[1], np.intp)
        for j in range(a, b):
            away.fill(0.0)
            for row, c in zip(x, centres[j]):
                np.subtract(row, c, out=gap)
                np.multiply(gap, gap, out=gap)
                away += gap
            place[away < best] = j - a
            np.minimum(best, away, out=best)
        yield i, place, best


def _assigned(points: DataFrame, models: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For each model: points and coordinate sums of every centre, and the cost. One scan answers all models.

    A task adds its points up by (model, centre), so only one row for each of them leaves it.
    """
    numbers = list(models)
    cuts = np.cumsum([0, *(len(models[m]) for m in numbers)])
    flat = np.concatenate([models[m] for m in numbers])
    width = flat.shape[1]

    def run(batches):
        count, total, cost = np.zeros(len(flat)), np.zeros(flat.shape), np.zeros(len(flat))
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for at in range(0, len(x), 4096):
                part = np.ascontiguousarray(x[at : at + 4096].T)
                for i, nearest, away in _nearest(part, flat, cuts):
                    a, b = cuts[i], cuts[i + 1]
                    count[a:b] += np.bincount(nearest, minlength=b - a)
                    cost[a:b] += np.bincount(nearest, away, b - a)
                    for j in range(width):
                        total[a:b, j] += np.bincount(nearest, part[j], b - a)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat)), pa.int32()), pa.array(count), pa.array(cost), pa.array(total.tolist(), pa.list_(pa.float64()))],
            ["place", "n", "cost", "sums"],
        )

    sums = [F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)]
    found = points.select("x").mapInArrow(run, "place int, n double, cost double, sums array<double>").groupBy("place").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *sums)
    n, cost, total = np.zeros(len(flat)), np.zeros(len(flat)), np.zeros(flat.shape)
    for r in found.collect():  # one row for each centre of each model
        n[r["place"]], cost[r["place"]] = r["n"], r["cost"]
        total[r["place"]] = [r[f"s{j}"] for j in range(width)]
    return {m: (n[a:b], total[a:b], float(cost[a:b].sum())) for m, a, b in zip(numbers, cuts, cuts[1:])}


def lloyd(points: DataFrame, starts: Sequence[np.ndarray], rounds: int = 300, tolerance: float = 1e-4) -> list[Centres]:
    """K-Means from each set of starting centres, all in the same passes over ``points`` (x array<double>).

    A model whose centres moved no further than ``tolerance`` leaves the passes. A centre without points stays.
    """
    centres = dict(enumerate(np.array(c, float) for c in starts))
    active = set(centres)
    for _ in range(rounds):
        if not active:
            break
        for m, (n, total, _) in _assigned(points, {m: centres[m] for m in sorted(active)}).items():
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[m])
            if ((moved - centres[m]) ** 2).sum(axis=1).max() <= tolerance**2:
                active.discard(m)
            centres[m] = moved
    final = _assigned(points, centres)
    return [Centres(centres[m], final[m][2]) for m in centres]


def _restarts(df: DataFrame, k_values: Sequence[int], features: str, seed: int, n_init: int) -> dict[int, Centres]:
    """The cheapest of ``n_init`` fits for each k."""
    check_vectors(df, features)
    for k in k_values:
        if not isinstance(k, int) or k < 2:
            raise ValueError(f"k must be an integer of at least 2, got {k!r}")
    points = df.select(vector_to_array(features).alias("x")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seeds = [(k, seed + restart) for k in k_values for restart in range(n_init)]
        models = lloyd(points, starting_centres(points, seeds))
    finally:
        points.unpersist()
    return {k: min((m for m in models if m.k == k), key=lambda m: m.cost) for k in k_values}


def fit_kmeans(df: DataFrame, k: int, features: str = "features", seed: int = SEED, n_init: int = 10) -> Centres:
    """The cheapest of ``n_init`` K-Means fits with consecutive seeds."""
    return _restarts(df, [k], features, seed, n_init)[k]


def kmeans_labels(df: DataFrame, k: int, features: str = "features", seed: int = SEED, n_init: int = 10) -> DataFrame:
    """The rows with their ``Cluster``; labels stay beside the keys."""
    return fit_kmeans(df, k, features, seed, n_init).label(df, features)


def kmeans_sweep(
    df: DataFrame, features: str = "features", k_values: Iterable[int] = K_RANGE, seed: int = SEED, n_init: int = 10, metric: str = "squaredEuclidean"
) -> DataFrame:
    """Cost and silhouette for each k; all fits of all k share their passes."""
    models = _restarts(df, list(k_values), features, seed, n_init)
    width = len(next(iter(models.values())).centres[0])
    names = [f"x{i}" for i in range(width)]
    points = df.select(features, *[vector_to_array(features)[i].alias(n) for i, n in enumerate(names)])
    rows = None
    for k, model in models.items():
        quality = silhouette(model.label(points, features), names, "Cluster", metric)
        row = quality.select(F.lit(k).cast("int").alias("k"), F.lit(model.cost).alias("inertia"), F.col("silhouette").alias("silhouette_score"))
        rows = row if rows is None else rows.unionAll(row)
    return rows


def best_k(sweep: DataFrame) -> int:
    """The k with the highest silhouette; the smallest k wins ties."""
    top = sweep.agg(F.min(F.struct((-F.col("silhouette_score")).alias("s"), F.col("k").alias("k"))).alias("top"))
    return top.first().top.k


def principal_axes(df: DataFrame, features: str = "features") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, axes as rows, variances) by falling variance, from one pass over the rows.

    The pass returns one row of means and covariances, a square of the vector's length. An axis points to
    where its largest entry (the first of equal ones) is positive.
    """
    check_vectors(df, features)
    sample = df.select(features).first()
    if sample is None:
        raise ValueError("no rows to find components in")
    width = sample[0].size
    x = df.select(vector_to_array(features).alias("x")).select(*[F.col("x")[i].alias(f"x{i}") for i in range(width)])
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    row = x.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(width)], *[F.covar_samp(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    spread = np.zeros((width, width))
    for i, j in pairs:
        spread[i, j] = spread[j, i] = row[f"c{i}_{j}"] or 0.0
    variances, columns = np.linalg.eigh(spread)
    axes = columns.T[::-1]
    axes = axes * np.array([1.0 if a[np.abs(a).argmax()] > 0 else -1.0 for a in axes])[:, None]
    return np.array([row[f"m{i}"] for i in range(width)]), axes, np.maximum(variances[::-1], 0.0)


def pca_projection(df: DataFrame, n: int = 2, features: str = "features") -> tuple[DataFrame, list[float]]:
    """Add ``PC1..PCn``, centred; also returns the share of variance of each component."""
    mean, axes, variances = principal_axes(df, features)
    if not 1 <= n <= len(axes):
        raise ValueError(f"{n} components of {len(axes)} features")
    x = vector_to_array(features)

    def along(axis: np.ndarray) -> Column:
        return reduce(lambda a, b: a + b, [(x[i] - F.lit(float(m))) * F.lit(float(v)) for i, (m, v) in enumerate(zip(mean, axis))])

    total = float(variances.sum())
    shares = [float(v) / total if total else 0.0 for v in variances[:n]]
    return df.withColumns({f"PC{i + 1}": along(axes[i]) for i in range(n)}), shares


def explained_variance(spark, ratios: Sequence[float]) -> DataFrame:
    """Component, share and running share; at most as many rows as features."""
    rows, upto = [], 0.0
    for i, r in enumerate(ratios, 1):
        upto += float(r)
        rows.append((f"PC{i}", float(r), upto))
    return spark.createDataFrame(rows, "component string, explained_variance_ratio double, cumulative double")


def component_centroids(projected: DataFrame, cluster: str = "Cluster", n: int = 2) -> DataFrame:
    return projected.groupBy(cluster).agg(*[F.avg(f"PC{i + 1}").alias(f"PC{i + 1}") for i in range(n)])


def cluster_profiles(table: DataFrame, cluster: str = "Cluster") -> DataFrame:
    """Size, mean and median R/F/M, total and shares of each cluster, in cluster order."""
    require(table, [*RFM_COLUMNS, cluster])
    size = F.count_distinct("CustomerID") if "CustomerID" in table.columns else F.count(F.lit(1))
    labelled = table.filter(F.col(cluster).isNotNull()).withColumn("cluster", F.col(cluster))
    sums = labelled.groupBy("cluster").agg(
        size.alias("customer_count"),
        F.count(F.lit(1)).alias("_rows"),
        *[F.avg(c).alias(f"mean_{c.lower()}") for c in RFM_COLUMNS],
        F.sum("Monetary").alias("total_monetary"),
    )
    medians = column_quantiles(labelled, RFM_COLUMNS, {"median": 0.5}, ["cluster"])
    medians = medians.groupBy("cluster").pivot("column", RFM_COLUMNS).agg(F.first("median"))
    medians = medians.select("cluster", *[F.col(c).alias(f"median_{c.lower()}") for c in RFM_COLUMNS])
    # From here on there is one row for each cluster.
    every = Window.partitionBy(F.lit(0))
    out = sums.join(medians, "cluster").withColumns(
        {
            "pct_of_customers": F.col("customer_count") / F.sum("_rows").over(every) * 100,
            "pct_of_total_revenue": safe_divide(F.col("total_monetary"), F.sum("total_monetary").over(every)) * 100,
        }
    )
    return out.select(*PROFILE_COLUMNS).orderBy("cluster")


def rank_clusters(profiles: DataFrame, by_total: bool = True) -> DataFrame:
    """Profiles by falling total (or mean) amount."""
    by = "total_monetary" if by_total else "mean_monetary"
    require(profiles, [by])
    return profiles.orderBy(F.desc(by), "cluster")


def cluster_zscores(profiles: DataFrame, table: DataFrame) -> DataFrame:
    """Distance of each cluster mean from the overall mean in population deviations."""
    fit = []
    for c in RFM_COLUMNS:
        fit += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    overall = table.agg(F.struct(*fit)).scalar()

    def z(c: str) -> Column:
        gap = F.col(f"mean_{c.lower()}") - F.col(f"_all.{c}_mean")
        return safe_divide(gap, F.col(f"_all.{c}_std")).alias(f"{c}_z")

    return profiles.withColumn("_all", overall).select("cluster", *[z(c) for c in RFM_COLUMNS])


def cluster_minmax(profiles: DataFrame) -> DataFrame:
    """Cluster means on the range 0..1; a range of zero counts as one. One row for each cluster."""
    every = Window.partitionBy(F.lit(0))
    out = []
    for c in RFM_COLUMNS:
        x = F.col(f"mean_{c.lower()}")
        low, high = F.min(x).over(every), F.max(x).over(every)
        width = F.when(high == low, F.lit(1.0)).otherwise(high - low)
        out.append(((x - low) / width).alias(f"{c}_scaled"))
    return profiles.select("cluster", *out)


def _squares(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, (c * c for c in columns))


def _cluster_list(stats: DataFrame) -> Column:
    """A table with one row for each cluster as one scalar array of structs."""
    return stats.agg(F.collect_list(F.struct(*stats.columns))).scalar()


def silhouette(df: DataFrame, columns: Sequence[str], cluster: str, metric: str = "squaredEuclidean") -> DataFrame:
    """Mean silhouette as one row; null with fewer than two clusters.

    ``squaredEuclidean`` needs one pass: a cluster's count, coordinate sums and sum of squares give
    every point's mean distance to it. ``euclidean`` has no such form and compares all points.
    """
    if metric == "euclidean":
        return _euclidean_silhouette(df, columns, cluster)
    if metric != "squaredEuclidean":
        raise ValueError(f"unknown metric {metric!r}")
    x = [F.col(c).cast("double") for c in columns]
    stats = df.groupBy(F.col(cluster).alias("c")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_squares(x)).alias("q"),
        F.array(*[F.sum(v) for v in x]).alias("s"),
    )
    clusters = F.col("_clusters")
    own_size = _squares(x)

    def total(entry: Column) -> Column:
        dot = reduce(lambda a, b: a + b, (v * entry.getField("s")[i] for i, v in enumerate(x)))
        return entry.getField("n") * own_size + entry.getField("q") - 2 * dot

    mine = F.col(cluster)
    inside = F.filter(clusters, lambda e: e.getField("c") == mine)[0]
    outside = F.transform(F.filter(clusters, lambda e: e.getField("c") != mine), lambda e: total(e) / e.getField("n"))
    scored = df.withColumn("_clusters", _cluster_list(stats)).select(
        inside.getField("n").alias("size"), total(inside).alias("within"), F.array_min(outside).alias("b")
    )
    a = F.col("within") / (F.col("size") - 1)
    return _mean_silhouette(scored, F.when(F.col("size") > 1, a), F.col("b"), F.lit(1))


def _mean_silhouette(df: DataFrame, a: Column, b: Column, weight: Column) -> DataFrame:
    """Weighted mean of (b - a) / max(a, b); members of one-point clusters count as zero."""
    s = F.when(a.isNull(), F.lit(0.0)).otherwise(F.coalesce(safe_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    value = F.sum(F.when(b.isNotNull(), s * weight)) / F.sum(weight)
    return df.agg(value.alias("silhouette"))


def block_count(points: int, cores: int, rows_per_block: int) -> int:
    """How many blocks so many points are cut into: few, as a point is sent once for each, but enough pairs for the cores."""
    return max(1, math.ceil(points / rows_per_block), min(math.ceil(math.sqrt(8 * cores)), points // FEW_ROWS))


def distance_sums(x: np.ndarray, x_ends: Sequence[int], wx: np.ndarray, y: np.ndarray, y_ends: Sequence[int], wy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sums of distances: from each x to the ys by their cluster, and from each y to the xs by theirs.

    A column is a point; each side is ordered by cluster, ends are where clusters begin and the last one stops.
    Every distance is taken once, in tiles that stay in a core's cache. A tile of squares is one product of matrices,
    |x|^2 - 2xy + |y|^2; where that cancels (near points, see NEAR) or is not finite, differences are squared instead.
    """
    to_y, to_x = np.zeros((x.shape[1], len(y_ends) - 1)), np.zeros((y.shape[1], len(x_ends) - 1))
    buffer = np.empty(TILE_ROWS * TILE_COLUMNS)
    if y.size and np.isfinite(x).all() and np.isfinite(y).all():
        middle = y.mean(axis=1, keepdims=True)
        x, y = x - middle, y - middle
    with np.errstate(over="ignore", invalid="ignore"):
        reach_x, reach_y = (x * x).sum(axis=0), (y * y).sum(axis=0)
        usable = np.isfinite(4 * (reach_x.sum() + reach_y.sum()))
    left, right = np.stack([*x, reach_x, np.ones(len(reach_x))], axis=1), np.stack([*(-2 * y), np.ones(len(reach_y)), reach_y])

    def tiles(ends: Sequence[int], most: int, reach: np.ndarray) -> list[tuple[int, slice, float]]:
        cuts = [(c, slice(at, min(at + most, b))) for c, (a, b) in enumerate(zip(ends[:-1], ends[1:])) for at in range(a, b, most)]
        return [(c, s, float(reach[s].max())) for c, s in cuts]

    across = tiles(y_ends, TILE_COLUMNS, reach_y)
    for i, rows, far_x in tiles(x_ends, TILE_ROWS, reach_x):
        n = rows.stop - rows.start
        for j, cols, far_y in across:
            m = cols.stop - cols.start
            away = buffer[: n * m].reshape(n, m)
            if usable:
                np.matmul(left[rows], right[:, cols], out=away)
                near = NEAR * (far_x + far_y)
                if away.min() < near:
                    a, b = np.nonzero(away < near)
                    away[a, b] = sum((p[rows][a] - q[cols][b]) ** 2 for p, q in zip(x, y))
            else:
                away[:] = sum((p[rows, None] - q[cols]) ** 2 for p, q in zip(x, y))
            np.sqrt(away, out=away)
            to_y[rows, j] += away @ wy[cols]
            to_x[cols, i] += wx[rows] @ away
    return to_y, to_x


def _euclidean_silhouette(
    df: DataFrame, columns: Sequence[str], cluster: str, rows_per_block: int = BLOCK_ROWS
) -> DataFrame:
    """Exact mean silhouette with plain distances, for tables of up to some million points.

    Equal points are merged and weighted. The rest is cut into blocks of neighbouring clusters, SPAN of which are taken
    as one; each pair of them is one group that sums the distances of its points per cluster, for both sides at once, so only
    sums leave a task, never pairs. A task holds such a pair. The work grows with the square of the distinct points.
    """
    import pandas as pd

    names = [f"x{i}" for i in range(len(columns))]
    points = (
        df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)], F.col(cluster).alias("c"))
        .groupBy(*names, "c")
        .agg(F.count(F.lit(1)).alias("w"))
    )
    cores = df.sparkSession.sparkContext.defaultParallelism
    blocks = block_count(points.count(), cores, SPAN * rows_per_block)
    # One row for each cluster: its rows, its distinct points and those of the clusters before it.
    sizes = points.filter("c IS NOT NULL").groupBy("c").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy("c")) - F.col("size")
    spots = sizes.select("c", "size", before.alias("before"), F.sum("size").over(Window.partitionBy(F.lit(0))).alias("all"))
    inside = F.pmod(F.xxhash64(*names), F.lit(1 << 32)) / (1 << 32)
    mine = F.floor((F.col("before") + inside * F.col("size")) * blocks / F.col("all")).cast("int")
    placed = points.join(F.broadcast(spots), "c").select(*names, "c", "w", F.least(mine, F.lit(blocks - 1)).alias("mine"))
    # Each pair of blocks once: a point goes to the pairs that its own block is part of.
    sent = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = sent.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other")).drop("other")
    sent = sent.repartition(min(blocks * (blocks + 1) // 2, MOST_TASKS), "low", "high")

    def side(rows: pd.DataFrame) -> tuple[pd.DataFrame, list, tuple]:
        codes, labels = pd.factorize(rows["c"])
        order = np.argsort(codes, kind="stable")
        ends = np.searchsorted(codes[order], np.arange(len(labels) + 1)).tolist()
        rows = rows.iloc[order][[*names, "c", "w"]]
        return rows, list(labels), (np.ascontiguousarray(rows[names].to_numpy().T), ends, rows["w"].to_numpy(np.float64))

    def pair_sums(pair: pd.DataFrame) -> pd.DataFrame:
        low, high = (pair["mine"] == pair[c] for c in ("low", "high"))
        one, ones, x = side(pair[low])
        two, twos, y = side(pair[high])
        to_two, to_one = distance_sums(*x, *y)
        out = [one.assign(target=label, dist=to_two[:, j]) for j, label in enumerate(twos)]
        if not low.equals(high):
            out += [two.assign(target=label, dist=to_one[:, i]) for i, label in enumerate(ones)]
        return pd.concat(out) if out else one.assign(target=one["c"], dist=0.0)

    kind = dict(points.dtypes)["c"]
    schema = ", ".join([*[f"{n} double" for n in names], f"c {kind}", "w bigint", f"target {kind}", "dist double"])
    sums = sent.groupBy("low", "high").applyInPandas(pair_sums, schema)
    sums = sums.groupBy(*names, "c", "w", "target").agg(F.sum("dist").alias("dist"))
    own = F.col("c") == F.col("target")
    means = sums.join(F.broadcast(sizes.select(F.col("c").alias("target"), "n")), "target").groupBy(*names, "c", "w").agg(
        F.max(F.when(own & (F.col("n") > 1), F.col("dist") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("dist") / F.col("n"))).alias("b"),
    )
    # Rows without a cluster have no distances; they count in the mean as before.
    nowhere = points.filter("c IS NULL").select("w", F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    return _mean_silhouette(means.select("w", "a", "b").unionAll(nowhere), F.col("a"), F.col("b"), F.col("w"))


def calinski_harabasz(df: DataFrame, columns: Sequence[str], cluster: str) -> DataFrame:
    """Between-cluster over within-cluster dispersion, each per degree of freedom, as one row."""
    x = [F.col(c).cast("double") for c in columns]
    stats = df.groupBy(F.col(cluster).alias("c")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)],
        reduce(lambda a, b: a + b, (F.var_pop(v) for v in x)).alias("spread"),
    )
    centre = df.agg(F.struct(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)])).scalar()
    gap = _squares(F.col(f"m{i}") - F.col(f"centre.m{i}") for i in range(len(x)))
    sums = stats.withColumn("centre", centre).agg(
        F.sum(F.col("n") * gap).alias("between"),
        F.sum(F.col("n") * F.col("spread")).alias("within"),
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
    )
    ratio = safe_divide(F.col("between") * (F.col("n") - F.col("k")), F.col("within") * (F.col("k") - 1))
    return sums.select(ratio.alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, columns: Sequence[str], cluster: str) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centroid distance, as one row."""
    x = [F.col(c).cast("double") for c in columns]
    centroids = df.groupBy(F.col(cluster).alias("c")).agg(F.array(*[F.avg(v) for v in x]).alias("m"))
    mine = F.filter("_centroids", lambda e: e.getField("c") == F.col(cluster))[0].getField("m")
    away = F.sqrt(_squares(v - F.col("m")[i] for i, v in enumerate(x)))
    placed = df.withColumn("_centroids", _cluster_list(centroids)).withColumn("m", mine)
    spreads = placed.groupBy(F.col(cluster).alias("c")).agg(F.avg(away).alias("s"), F.first("m").alias("m"))
    # One row for each cluster: the list of all clusters fits beside each of them.
    every = F.collect_list(F.struct("c", "s", "m")).over(Window.partitionBy(F.lit(0)))
    both = spreads.withColumn("others", every)

    def likeness(e: Column) -> Column:
        distance = F.sqrt(_squares(e.getField("m")[i] - F.col("m")[i] for i in range(len(x))))
        return safe_divide(F.col("s") + e.getField("s"), distance)

    rivals = F.transform(F.filter("others", lambda e: e.getField("c") != F.col("c")), likeness)
    return both.select(F.array_max(rivals).alias("worst")).agg(F.avg("worst").alias("davies_bouldin"))


def clustering_metrics(
    df: DataFrame, columns: Sequence[str], cluster: str, metric: str = "squaredEuclidean"
) -> dict[str, float]:
    """The three quality figures; needs at least two clusters."""
    require(df, [*columns, cluster])
    if df.select(cluster).distinct().limit(2).count() < 2:
        raise ValueError("quality needs at least two clusters")
    return {
        "silhouette_score": silhouette(df, columns, cluster, metric).first()[0],
        "calinski_harabasz_score": calinski_harabasz(df, columns, cluster).first()[0],
        "davies_bouldin_score": davies_bouldin(df, columns, cluster).first()[0],
    }
