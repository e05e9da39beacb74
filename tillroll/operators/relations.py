"""Correlations and pair studies."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from tillroll.functions.columns import number, records
from tillroll.functions.ranks import column_quantiles, hash_sample, melt, running_totals
from tillroll.schema import MEASURES, present

SAMPLE_ROWS = 50_000


def correlation_matrix(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Pearson correlation of every pair as ``col1, col2, correlation``, all pairs in one pass."""
    names = present(df, columns)
    pairs = list(combinations(names, 2))
    both = {p: F.corr(number(df, p[0]).cast("double"), number(df, p[1]).cast("double")) for p in pairs}
    selves = {c: F.corr(number(df, c).cast("double"), number(df, c).cast("double")) for c in names}
    one = df.agg(
        *[value.alias(f"{a}~{b}") for (a, b), value in both.items()],
        *[value.alias(f"{c}~{c}") for c, value in selves.items()],
    )
    rows = []
    for a in names:
        for b in names:
            source = f"{a}~{b}" if (a, b) in both or a == b else f"{b}~{a}"
            rows.append({"col1": F.lit(a), "col2": F.lit(b), "correlation": F.col(f"`{source}`")})
    return records(one, rows)


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank of each distinct value of each column; equal values share the mean of their places."""
    counts = melt(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    placed = running_totals(counts, [F.col("value")], {"upto": F.col("c")}, by=["column"])
    return placed.select("column", "value", (F.col("upto") - (F.col("c") - 1) / 2).alias("rank"))


def spearman(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Rank correlation of every pair of columns, over rows where all of them have a value.

    Ranks are computed once per distinct value and joined to the distinct rows, so repeated values
    cost one row each, no rank needs a single sorted stream, and one pass answers all pairs.
    """
    names = present(df, columns)
    values = df.select(*[number(df, c).cast("double").alias(c) for c in names]).dropna()
    middle = (values.agg(F.count(F.lit(1))).scalar() + 1) / 2
    ranks = average_ranks(values, names).withColumn("rank", F.col("rank") - middle)
    ranked = values.groupBy(*names).agg(F.count(F.lit(1)).alias("w"))
    for c in names:
        mine = ranks.filter(F.col("column") == c)
        ranked = ranked.join(mine.select(F.col("value").alias(c), F.col("rank").alias(f"rank_{c}")), c)

    def total(a: str, b: str) -> str:
        return f"sum(w * `rank_{a}` * `rank_{b}`)"

    pairs = list(combinations(names, 2))
    sums = [F.expr(f"{total(a, b)} / sqrt({total(a, a)} * {total(b, b)})").alias(f"{a}~{b}") for a, b in pairs]
    rows = [{"col1": F.lit(a), "col2": F.lit(b), "correlation": F.col(f"`{a}~{b}`")} for a, b in pairs]
    return records(ranked.agg(*sums), rows)


def positive_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    a, b = number(df, x), number(df, y)
    return df.select(a.alias(x), b.alias(y)).filter((a > 0) & (b > 0))


def pair_study(df: DataFrame, x: str, y: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Size, Pearson, Spearman, scatter sample size and 1 % / 99 % bounds of a positive pair."""
    pairs = positive_pairs(df, x, y)
    basics = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("pearson")
    )
    edges = column_quantiles(pairs, [x, y], {"p01": 0.01, "p99": 0.99})
    bounds = edges.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("p01", "p99"))))).scalar()
    return basics.withColumn("b", bounds).select(
        F.lit(x).alias("x"),
        F.lit(y).alias("y"),
        "n",
        "pearson",
        spearman(pairs, [x, y]).select("correlation").scalar().alias("spearman"),
        F.least(F.col("n"), F.lit(sample_rows)).alias("sample_rows"),
        *[
            F.col("b").getItem(c).getField(edge).alias(f"{axis}_{edge}")
            for axis, c in (("x", x), ("y", y))
            for edge in ("p01", "p99")
        ],
    )


def scatter_sample(df: DataFrame, x: str, y: str, n: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    """``n`` positive pairs drawn uniformly, repeated pairs as often as they are drawn."""
    return hash_sample(positive_pairs(df, x, y), n, [x, y], seed)


def clip_p99(df: DataFrame, x: str, y: str) -> DataFrame:
    """Positive pairs with both values at most their 99th percentile."""
    pairs = positive_pairs(df, x, y)
    edges = column_quantiles(pairs, [x, y], {"p99": 0.99})
    top = edges.agg(F.map_from_entries(F.collect_list(F.struct("column", "p99")))).scalar()
    inside = (F.col(x) <= F.col("_top").getItem(x)) & (F.col(y) <= F.col("_top").getItem(y))
    return pairs.withColumn("_top", top).filter(inside).drop("_top")


def regression_line(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    return pairs.agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept")
    )
