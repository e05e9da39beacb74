"""Order statistics and running totals that never pull a whole column into one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer, and a window
without a partition key runs in one task. The helpers below give the same exact numbers with
work spread over partitions. All of them only build a plan: no job runs before the result is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.functions.columns import hash_key

OUTER = 255  # cut points over all values of a group
INNER = 255  # cut points inside a stretch between two of them
EDGES = 1023  # cut points of running totals


def below(cuts: str, key: str, points: int) -> str:
    """SQL: how many entries of the sorted array ``cuts`` (at most ``points`` = 2**k - 1) are below ``key``."""
    widths = ", ".join(str(1 << k) for k in reversed(range(points.bit_length())))
    return f"aggregate(array({widths}), 0, (lo, step) -> IF(lo + step <= size({cuts}) AND {cuts}[lo + step - 1] < {key}, lo + step, lo))"


def find_rank(parts: str, rank: str, before: str) -> str:
    """SQL: (before, place) of the entry of ``parts`` (ordered, with ``rows``) that holds a zero-based rank."""
    start = f"named_struct('before', bigint({before}), 'place', 0, 'found', false)"
    inside = f"(a.found OR {rank} < a.before + z.rows)"
    step = f"named_struct('before', IF({inside}, a.before, a.before + z.rows), 'place', IF({inside}, a.place, a.place + 1), 'found', {inside})"
    return f"aggregate({parts}, {start}, (a, z) -> {step})"


def attach(df: DataFrame, state: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each row with its group's row of ``state`` (bounded groups, one small row each) as a struct ``s``."""
    if not by:
        return df.withColumn("s", state.select(F.struct("*")).scalar())
    right = state.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.struct(*[c for c in state.columns if c not in by]).alias("s"))
    on = F.lit(True)
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return df.join(F.broadcast(right), on).drop(*[f"_by_{b}" for b in by])


def with_place(df: DataFrame, cuts: str, key: str, points: int, name: str) -> DataFrame:
    """Add how many entries of the sorted array ``cuts`` are below ``key``, as ``below`` does.

    Each step of the search is a projection of its own, so that it runs in generated code; ``below`` is a
    lambda, which is interpreted for every row.
    """
    out = df.withColumn(name, F.lit(0))
    for step in reversed([1 << k for k in range(points.bit_length())]):
        out = out.withColumn(name, F.expr(f"`{name}` + IF(get({cuts}, `{name}` + {step - 1}) < {key}, {step}, 0)"))
    return out


def values_at(long: DataFrame, by: Sequence[str], ranks: dict[str, str], value: str = "value") -> DataFrame:
    """The values at zero-based ranks of each group; ``ranks`` are SQL expressions of the group's size ``n``.

    Selection by narrowing. Cut points (a sketch) part a group into stretches; their exact row counts tell
    which stretch holds a rank, and cut points inside that one part it again. The distinct values of the
    stretch that is left, about one row in OUTER * INNER, are then counted and the rank is read off. Sketches
    only choose where to cut: whichever stretch a rank falls into is the one that is kept, so the answer
    does not depend on how good a cut is. Only counts of stretches are shuffled, never the values of a column.

    ``long`` is read five times: hand in a written table, or one that ends in a shuffle.
    ``by`` must be a bounded set of groups (measure name, month, cluster). Columns out: ``by``, ``n``, one per rank.
    """
    by = list(by)
    rows = long.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("x"))
    wanted = ", ".join(f"struct({i} AS t, bigint({r}) AS r)" for i, r in enumerate(ranks.values()))

    def cuts(df: DataFrame, keys: list[str], points: int, *more: Column) -> DataFrame:
        grid = F.expr(f"array({', '.join(f'{(i + 1) / (points + 1)}D' for i in range(points))})")
        return df.groupBy(*keys).agg(F.percentile_approx("x", grid, 8 * points).alias("cuts"), *more)

    def held(counts: DataFrame, keys: list[str], part: str) -> DataFrame:
        """The part (of ``part``, ``rows``, ``n``, ``before``) that holds each rank of its group of ``keys``, and the rows before it."""
        every = F.expr(f"array_sort(collect_list(struct({part} AS part, rows)))")
        parts = counts.groupBy(*keys).agg(F.first("n").alias("n"), F.first("before").alias("before"), F.sum("rows").alias("size"), every.alias("parts"))
        inside = parts.withColumn("w", F.expr(f"explode(filter(array({wanted}), w -> w.r >= before AND w.r < before + size))"))
        at = inside.withColumn("at", F.expr(find_rank("parts", "w.r", "before")))
        return at.select(*keys, "n", F.col("w.t").alias("t"), F.col("at.before").alias("before"), F.expr("parts[at.place].part").alias(part))

    def places(found: DataFrame, keys: list[str]) -> DataFrame:
        return found.groupBy(*keys).agg(F.first("n").alias("n"), F.first("before").alias("before"))

    in_z, in_y = [*by, "z"], [*by, "z", "y"]
    n, before = F.first("s.n").alias("n"), F.first("s.before").alias("before")
    placed = with_place(attach(rows, cuts(rows, by, OUTER), by), "s.cuts", "x", OUTER, "z").select(*in_z, "x")
    counts = placed.groupBy(*in_z).agg(F.count(F.lit(1)).alias("rows"))
    sizes = counts.groupBy(*by).agg(F.sum("rows").alias("n"), F.collect_list(F.struct("z", "rows")).alias("all"))
    outer = sizes.select(*by, "n", F.lit(0).cast("long").alias("before"), F.expr("inline(all)"))
    # From here on only rows of the stretches that hold a rank are kept, at most one stretch for each rank.
    inner = cuts(attach(placed, places(held(outer, by, "z"), in_z), in_z), in_z, INNER, n, before)
    near = with_place(attach(placed, inner, in_z), "s.cuts", "x", INNER, "y")
    found = held(near.groupBy(*in_y).agg(F.count(F.lit(1)).alias("rows"), n, before), in_z, "y")
    last = attach(near.select(*in_y, "x"), places(found, in_y), in_y)
    listed = held(last.groupBy(*in_y, "x").agg(F.count(F.lit(1)).alias("rows"), n, before), in_y, "x")
    return listed.groupBy(*by).agg(F.first("n").alias("n"), *[F.max(F.when(F.col("t") == i, F.col("x"))).alias(name) for i, name in enumerate(ranks)])


def melt(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), positive: bool = False) -> DataFrame:
    """Non-null numbers of several columns as rows ``by..., column, value`` (one expand, no join)."""
    doubles = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot(list(by), list(columns), "column", "value")
    keep = F.col("value") > 0 if positive else F.col("value").isNotNull()
    return long.filter(keep & ~F.isnan("value"))


def quantiles(long: DataFrame, probs: dict[str, float], by: Sequence[str] = (), value: str = "value", approx: bool = False) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` for each group, one column per probability.

    ``approx=True`` answers from a sketch alone: one pass, rank error 1e-5.
    """
    if approx:
        sketch = [F.percentile_approx(value, p, 100_000).alias(name) for name, p in probs.items()]
        return long.groupBy(*by).agg(*sketch)
    position = {name: f"(double({p!r}) * (n - 1))" for name, p in probs.items()}
    ranks = {}
    for name, at in position.items():
        ranks[f"{name}~low"], ranks[f"{name}~high"] = f"floor({at})", f"ceil({at})"
    ends = values_at(long, by, ranks, value)
    out = [F.expr(f"`{name}~low` + (`{name}~high` - `{name}~low`) * ({at} - floor({at}))").alias(name) for name, at in position.items()]
    return ends.select(*by, *out)


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: dict[str, float], by: Sequence[str] = (), positive: bool = False
) -> DataFrame:
    """Quantiles of several columns in the same passes; one row per group and column."""
    return quantiles(melt(df, columns, by, positive), probs, [*by, "column"])


def running_totals(df: DataFrame, order: Sequence[Column], sums: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Add inclusive running sums over a table sorted by ascending ``order`` keys (nulls first), of any size.

    Cut points are the keys of the EDGES rows with the smallest hashes, so they follow from the rows alone
    and are the same wherever they are computed. They part the order into stretches of about equal
    length; sums of the stretches (at most one row per cut and group) give the offsets, and a window
    inside each stretch finishes the sum. Rows must be distinct in ``order`` within a group: aggregate ties first.
    """
    by = list(by)
    names = [f"_k{i}" for i in range(len(order))]
    keyed = df.select("*", *[k.alias(n) for k, n in zip(order, names)], *[e.alias(f"_w_{n}") for n, e in sums.items()])
    key = F.struct(*by, *names)
    sample = keyed.select(key.alias("k")).orderBy(F.xxhash64("k"), "k").limit(EDGES)
    cuts = sample.agg(F.array_sort(F.collect_list("k")).alias("cuts")).scalar()
    placed = keyed.withColumn("_cuts", cuts).withColumn("_key", key).withColumn("_stretch", F.expr(below("_cuts", "_key", EDGES))).drop("_cuts", "_key")

    totals = placed.groupBy(*by, "_stretch").agg(*[F.sum(f"_w_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.col("_stretch").alias("_s"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
    )
    on = F.col("_stretch") == F.col("_s")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    inside = Window.partitionBy("_stretch", *by).orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select("*", *[F.sum(f"_w_{n}").over(inside).alias(f"_r_{n}") for n in sums])
    joined = local.join(F.broadcast(offsets), on)  # at most EDGES + 1 rows more than groups
    return joined.select(*df.columns, *[(F.col(f"_o_{n}") + F.col(f"_r_{n}")).alias(n) for n in sums])


def hash_ranks(df: DataFrame, key: Sequence[str], by: Sequence[str] = (), seed: int = 42, name: str = "rank") -> DataFrame:
    """Add each row's zero-based rank in a repeatable shuffled order within its group.

    The leading hex digits of the hash cut a group into even buckets; a small histogram gives each
    bucket's offset, and the exact order is settled inside a bucket. ``by`` must be a bounded set
    of classes: the histogram (at most 65,536 rows for each) is broadcast.
    """
    by = list(by)
    hashed = df.withColumn("_hash", hash_key(seed, *key)).withColumn("_bucket", F.substring("_hash", 1, 4))
    counts = hashed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
    )
    on = F.col("_bucket") == F.col("_b")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    within = Window.partitionBy(*by, "_bucket").orderBy("_hash", *key)
    placed = hashed.withColumn("_place", F.row_number().over(within) - 1).join(F.broadcast(offsets), on)
    return placed.select(*df.columns, (F.col("_offset") + F.col("_place")).alias(name))


COPY_STEP = 4096


def numbered_copies(df: DataFrame, name: str = "_copy") -> DataFrame:
    """The same rows with equal ones numbered from 0; a frequent row is unfolded in two steps, so that
    no array holds all its copies."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    steps_ = counted.withColumn("_step", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPY_STEP))))
    last = F.least(F.col("_copies"), (F.col("_step") + 1) * COPY_STEP) - 1
    return steps_.withColumn(name, F.explode(F.sequence(F.col("_step") * COPY_STEP, last))).drop("_copies", "_step")


def hash_sample(df: DataFrame, n: int, key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), repeatable and uniform, without ordering the whole table.

    Rows that share the key are told apart by their other columns, and equal rows by a number, so every row
    has a hash of its own. A histogram of the leading hash digits tells up to which bucket the first
    ``n`` rows reach; only those rows are then ordered and cut.
    """
    key = list(key or [])
    parts = [*key, *[c for c in df.columns if c not in key], "_copy"]
    hashed = numbered_copies(df).withColumn("_hash", hash_key(seed, *parts)).withColumn("_bucket", F.substring("_hash", 1, 4))
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    reached = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(upto), F.lit(0)))
    last = reached.filter(F.col("_before") < n).agg(F.max("_bucket")).scalar()
    return hashed.filter(F.col("_bucket") <= last).orderBy("_hash", *parts).limit(n).select(*df.columns)
