"""Bounded samples of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.shared import crc_of_id


def held_out(mod: int, rest: int) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(crc_of_id() % mod == rest, F.lit(False))


def share(bound: int, rows: int) -> float:
    return min(1.0, bound / max(rows, 1))


def by_hash(seed: int, part: float) -> Column:
    """Keep this share of the ids, by a seeded hash."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30)) < int(part * (1 << 30))


def chosen(labels: DataFrame, label: str, mod: int, rest: int, bounds: dict[int, int], seed: int = 7) -> tuple[DataFrame, Column]:
    """(doc_id, label) of documents outside the held-out part whose label rows agree, and which of them are in the sample."""
    own = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label")).filter(~held_out(mod, rest))
    own = own.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_max")).filter("label = _max").drop("_max")
    counts = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}  # a row per class
    wanted = F.lit(False)
    for value, bound in bounds.items():
        wanted = wanted | ((F.col("label") == value) & by_hash(seed + value, share(bound, counts.get(value, 0))))
    return own, wanted


def labelled(docs: DataFrame, labels: DataFrame, label: str, mod: int, rest: int, bounds: dict[int, int], unlabelled: int = 0, seed: int = 7) -> DataFrame:
    """(text, label) of about ``bounds[v]`` rows with each label v, and rows with label -1 for unlabelled text.

    Only rows outside the held-out part, chosen by hash. A document whose label rows disagree or are
    null is no labelled row. Expected sizes are the bounds, so the sample that reaches the driver has
    a bound of its own, and the ids that are broadcast have it too.
    """
    own, wanted = chosen(labels, label, mod, rest, bounds, seed)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(~held_out(mod, rest))
    found = rows.join(F.broadcast(own.filter(wanted)), "doc_id", "left")
    if not unlabelled:
        return found.filter("label is not null").select("text", "label")
    part = share(unlabelled, docs.count())
    # a labelled row may be drawn as unlabelled text as well
    drawn = F.array_compact(F.array(F.col("label"), F.when(by_hash(seed + 99, part), F.lit(-1))))
    return found.select("text", F.explode(drawn).alias("label"))
