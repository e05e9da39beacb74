"""The scalable rank helpers against brute force, on skewed values too."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.functions import ranks


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = []
    for i in range(4000):
        value = 5.0 if i % 3 == 0 else rng.choice([rng.expovariate(0.01), float(rng.randint(0, 9)), -rng.random()])
        rows.append((i, "hot" if i % 3 else "b", value))
    return spark.createDataFrame(rows, "id long, g string, v double").cache()


def test_quantiles_match_linear_interpolation(skewed):
    probs = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.9, "f": 0.999, "g": 1.0}
    got = ranks.column_quantiles(skewed, ["v"], probs).first()
    values = np.array([r.v for r in skewed.collect()])
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_stay_exact_with_few_cuts(skewed, monkeypatch):
    monkeypatch.setattr(ranks, "OUTER", 3)
    monkeypatch.setattr(ranks, "INNER", 1)
    values = np.array([r.v for r in skewed.collect()])
    probs = {f"p{i}": p for i, p in enumerate([0, 0.03, 0.5, 0.97, 0.999, 1])}
    got = ranks.column_quantiles(skewed, ["v"], probs).first()
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(values, p))


def test_quantiles_of_many_distinct_values_and_one_hot_value(spark):
    n = 100_000
    spread = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("v"), F.lit(7.0).alias("hot"))
    got = {r.column: r for r in ranks.column_quantiles(spread, ["v", "hot"], {"m": 0.5, "p": 0.999}).collect()}
    assert got["v"].m == (n - 1) / 2 and got["v"].p == pytest.approx(0.999 * (n - 1))
    assert (got["hot"].m, got["hot"].p) == (7.0, 7.0)
    one = ranks.quantiles(ranks.melt(spread, ["v"]), {"m": 0.25})
    assert one.first().m == pytest.approx(0.25 * (n - 1))
    assert "Window" not in one._jdf.queryExecution().executedPlan().toString()


def test_quantiles_of_nothing(spark, skewed):
    none = skewed.filter("id < 0")
    assert ranks.column_quantiles(none, ["v"], {"m": 0.5}).count() == 0
    assert ranks.quantiles(ranks.melt(none, ["v"]), {"m": 0.5}).first().m is None


def test_building_a_plan_starts_no_job(spark, skewed):
    spark.sparkContext.setJobGroup("plans", "plans")
    ranks.column_quantiles(skewed, ["v"], {"m": 0.5}, ["g"])
    ranks.running_totals(skewed, [F.col("v"), F.col("id")], {"t": F.col("v")}, by=["g"])
    ranks.hash_sample(skewed, 10, ["id"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plans")
    spark.sparkContext.setJobGroup("tests", "tests")


def test_grouped_and_approximate_quantiles(skewed):
    got = {r.g: r.m for r in ranks.column_quantiles(skewed, ["v"], {"m": 0.5}, ["g"]).collect()}
    rows = skewed.collect()
    for g in ("hot", "b"):
        assert got[g] == pytest.approx(np.median([r.v for r in rows if r.g == g]))
    near = ranks.quantiles(ranks.melt(skewed, ["v"]), {"m": 0.5}, ["column"], approx=True).first().m
    assert near == pytest.approx(np.median([r.v for r in rows]), abs=1.0)


def test_quantile_of_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0)], "g string, v double")
    got = {r.g: (r.q, r.m) for r in ranks.column_quantiles(df, ["v"], {"q": 0.25, "m": 0.5}, ["g"]).collect()}
    assert got == {"a": (1.0, 1.0), "b": (1.25, 1.5)}


def test_running_totals(spark, skewed):
    out = ranks.running_totals(skewed, [-F.col("v"), F.col("id")], {"total": F.col("v"), "place": F.lit(1)}, by=["g"])
    rows = out.collect()
    for g in ("hot", "b"):
        mine = sorted((r for r in rows if r.g == g), key=lambda r: (-r.v, r.id))
        assert [r.place for r in mine] == list(range(1, len(mine) + 1))
        assert mine[-1].total == pytest.approx(sum(r.v for r in mine))
        assert mine[10].total == pytest.approx(sum(r.v for r in mine[:11]))


def test_results_do_not_depend_on_the_partitioning(spark, skewed):
    def run():
        return sorted((r.id, r.place) for r in ranks.running_totals(skewed, [F.col("v"), F.col("id")], {"place": F.lit(1)}).collect())

    many = run()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert run() == many
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_running_totals_with_nulls_and_skew(spark):
    rows = [(None, i) for i in range(3)] + [("a", i) for i in range(5000)] + [("b", None), ("b", 2)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    out = ranks.running_totals(df, [F.col("v")], {"place": F.lit(1)}, by=["g"]).collect()
    for g in (None, "a", "b"):
        mine = sorted((r for r in out if r.g == g), key=lambda r: (r.v is not None, r.v or 0))
        assert [r.place for r in mine] == list(range(1, len(mine) + 1))


def digest(*parts):
    return hashlib.md5("-".join(map(str, [*parts, 42])).encode()).hexdigest()


def test_hash_ranks_and_sample(skewed):
    rows = ranks.hash_ranks(skewed, ["id"], ["g"]).collect()
    for g in ("hot", "b"):
        mine = sorted((r for r in rows if r.g == g), key=lambda r: r["rank"])
        assert [r.id for r in mine] == sorted((r.id for r in mine), key=lambda i: (digest(i), i))
        assert [r["rank"] for r in mine] == list(range(len(mine)))
    sample = [r.id for r in ranks.hash_sample(skewed.select("id"), 100, ["id"]).collect()]
    assert sample == sorted((r.id for r in rows), key=lambda i: digest(i, 0))[:100]
    assert ranks.hash_sample(skewed, 10_000, ["id"]).count() == 4000


def test_sample_is_uniform_over_repeated_keys(spark):
    rows = [("k", i // 3) for i in range(30)] + [("other", i) for i in range(30)]
    df = spark.createDataFrame(rows, "key string, v int")
    taken, seeds = np.zeros(2), 12
    for seed in range(seeds):
        got = ranks.hash_sample(df, 10, ["key"], seed).collect()
        assert len(got) == 10
        both = sum(r.key == "k" for r in got)
        taken += [both, 10 - both]
        assert max(sum(r.key == "k" and r.v == v for r in got) for v in range(10)) <= 3
    assert abs(taken[0] / (10 * seeds) - 0.5) < 4 * np.sqrt(0.25 / (10 * seeds))
    spark_rows = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(10_000))).alias("i")).select(F.lit("x").alias("key"))
    assert ranks.hash_sample(spark_rows, 9_999, ["key"]).count() == 9_999


def test_values_are_not_shuffled_whole(spark):
    """Only counts of stretches move: every shuffle goes by the stretch, none by the bare values, and ranks stay exact with many ties."""
    import contextlib
    import io

    df = spark.range(5000).select((F.col("id") % 1000).cast("double").alias("value"))
    df = df.union(spark.range(3000).select(F.lit(7.0).alias("value")))
    found = ranks.values_at(df, [], {"a": "0", "b": "n div 2", "c": "n - 1"})
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        found.explain()
    assert set(re.findall(r"hashpartitioning\((\w+)#", told.getvalue())) == {"z"}
    ordered = sorted([float(i % 1000) for i in range(5000)] + [7.0] * 3000)
    assert tuple(found.select("n", "a", "b", "c").first()) == (8000, ordered[0], ordered[4000], ordered[-1])
