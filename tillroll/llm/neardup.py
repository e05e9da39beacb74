"""Near copies by circulant MinHash, banding and exact Jaccard verification.

Two permutations give a whole signature: the first scatters shingle hashes over POSITIONS places, the
second is a table of values, and coordinate k is the least value at (place + k) over a document's
shingles, so one look at COORDINATES neighbouring table cells serves all coordinates. Each band
hashes ROWS_A_BAND coordinates drawn from all of them; documents that share a band are candidates.

Links are confirmed on whole shingle sets (as sorted 64-bit hashes). Documents with equal sets form one
class, found by grouping on a fingerprint of the set, so copies never meet in a bucket; the row with
the smallest id represents it. Representatives are then compared in three waves, with components of
the links so far between them: each with one hub, the smallest id of the buckets it shares most often;
each that is outside the largest component of a bucket with one member of it; and last all pairs of
different components in a cluster (representatives joined by buckets) that exact prefix and
positional filters let through. Pairs inside one component need no look, as they change nothing.

Classes are numbered when their table is written, so a node stands for one set and not for an id: rows that
share an id but not a set are documents of their own, with a component each. A component's id is the
smallest doc_id in it.

No text or blank text: an empty set, linked with nothing. Fewer words than a shingle has: the whole
sequence is the one shingle. Rows without id are linked with nothing and have no component; rows that
share an id and a text are one document. Very long texts are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm import words as w
from tillroll.llm.shared import kept, text_parts

WIDTH = 5
PERCENT = 80
POSITIONS_BITS = 20
COORDINATES = 256
BANDS, ROWS_A_BAND = 64, 7
SEED = 12

PRINT = ["n_shingles", "print_1", "print_2"]  # a set's fingerprint
MARK = ["mark_1", "mark_2"]  # a text's hashes; they tell the texts of one id apart
_FEATURES = "doc_id long, mark_1 long, mark_2 long, n_shingles long, print_1 long, print_2 long, keys array<long>"


class Circulant:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        values = rng.permutation(1 << POSITIONS_BITS).astype(np.int32)
        ring = np.concatenate([values, values[: COORDINATES - 1]])
        self.windows = np.lib.stride_tricks.sliding_window_view(ring, COORDINATES)
        self.scatter = np.uint64(rng.integers(1, 1 << 62))
        self.bands = np.stack([rng.choice(COORDINATES, ROWS_A_BAND, replace=False) for _ in range(BANDS)])

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = w.mixed(shingles ^ self.scatter) >> np.uint64(64 - POSITIONS_BITS)
        out = np.full(COORDINATES, np.iinfo(np.int32).max, np.int32)
        for at in range(0, len(places), 512):
            np.minimum(out, self.windows[places[at : at + 512]].min(axis=0), out=out)
        return out

    def keys(self, signature: np.ndarray) -> np.ndarray:
        h = np.arange(1, BANDS + 1, dtype=np.uint64) * w.STEP
        for j in range(ROWS_A_BAND):
            h = w.mixed(h ^ (signature[self.bands[:, j]].astype(np.uint64) + np.uint64(int(w.MIX_2) * (j + 1) % (1 << 64))))
        return h.view(np.int64)


_circulant: list[Circulant] = []


def circulant() -> Circulant:
    if not _circulant:
        _circulant.append(Circulant())
    return _circulant[0]


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, data, offsets in text_parts(column):
        _, _, first, hashes = w.words(data, offsets, lower=True)
        n = len(hashes)
        joined = np.zeros(n, np.uint64)
        for k in range(width):  # where fewer than width words follow, the value is not used
            joined[: n - k] = joined[: n - k] * w.BASE + w.mixed(hashes[k:])
        joined = w.mixed(joined)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= width:
                yield np.unique(joined[a : b - width + 1])
            elif b > a:
                h = np.uint64(b - a)
                for x in hashes[a:b]:
                    h = w.mixed(np.array([h ^ x]) * w.STEP)[0]
                yield np.array([h], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    if not len(shingles):
        return 0, 0
    return int(w.mixed(shingles ^ w.MIX_1).sum().view(np.int64)), int(w.mixed(shingles ^ w.MIX_2).sum().view(np.int64))


def marks(text: str) -> list[Column]:
    return [F.xxhash64(F.lit(i), F.col(text).cast("string")).alias(name) for i, name in enumerate(MARK)]


def features(documents: DataFrame, width: int) -> DataFrame:
    """Text hashes, set size, fingerprint and band keys of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table = circulant(), {}
        for batch in batches:
            sizes, one, two, keys = [], [], [], []
            for s in shingle_sets(batch["text"], width):
                sizes.append(len(s))
                print_ = fingerprint(s)
                one.append(print_[0])
                two.append(print_[1])
                if len(s) and (print_, len(s)) not in table:  # copies in a batch are signed once
                    table[print_, len(s)] = own.keys(own.signature(s))
                keys.append(table[print_, len(s)] if len(s) else np.zeros(0, np.int64))
            table.clear()
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64), pa.int64())
            ends = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["mark_1"], batch["mark_2"], pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.ListArray.from_arrays(ends, flat)],
                ["doc_id", *MARK, *PRINT, "keys"],
            )

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *marks("text")).mapInArrow(run, _FEATURES)


def set_table(wanted: DataFrame, width: int) -> DataFrame:
    """(rep, shingles), the sorted hashes as bytes, for the rows (rep, text, fingerprint) whose text has that fingerprint.

    Another text under the representative's id has another fingerprint and is passed over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, same = [], []
            for s, *want in zip(shingle_sets(batch["text"], width), *[batch[c].to_pylist() for c in PRINT]):
                sets.append(s.tobytes())
                same.append([len(s), *fingerprint(s)] == want)
            out = pa.RecordBatch.from_arrays([batch["rep"], pa.array(sets, pa.binary())], ["rep", "shingles"])
            yield out.filter(pa.array(same, pa.bool_()))

    return wanted.select("rep", "text", *PRINT).mapInArrow(run, "rep long, shingles binary")


def linked(a: bytes, b: bytes, percent: int) -> bool:
    """Whether 100 |A & B| >= percent |A | B|."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < percent * len(y):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch["x"].to_pylist(), batch["y"].to_pylist()
            good = pa.array([linked(p, q, percent) for p, q in zip(x, y)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    one = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a")
    both = one.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link.

    Nodes are ordered by a hash. In each round every node steps to the least node among itself and its
    neighbours and on to that node's least; links then join the nodes that were stepped to, and those within
    one node fall away. So a round reads what is left of the links, not all of them again, and on a path about
    half of the nodes go in each. What was stepped is followed at the end, the last round first.
    """
    spot = lambda c: F.struct(F.xxhash64(c).alias("by"), F.col(c).alias("node"))
    edges = kept(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    alone = links.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("to"))
    steps = []
    while not edges.isEmpty():
        both = edges.select("a", spot("b").alias("near")).unionAll(edges.select(F.col("b").alias("a"), spot("a").alias("near")))
        least = kept(both.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near")).select("node", F.least(spot("node"), "near").alias("to")).select("node", "to.node").toDF("node", "to"), "least")
        further = least.select(F.col("node").alias("to"), F.col("to").alias("further"))
        steps.append(kept(least.join(further, "to").select("node", F.col("further").alias("to")), "steps"))
        one = edges.join(steps[-1].select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        two = one.join(steps[-1].select(F.col("node").alias("b"), F.col("to").alias("y")), "b").filter("x <> y")
        edges = kept(two.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not steps:
        return alone.distinct().toDF("node", "component")
    tops = steps.pop()
    while steps:
        later = tops.select(F.col("node").alias("to"), F.col("to").alias("top"))
        tops = kept(steps.pop().join(later, "to", "left").select("node", F.coalesce("top", "to").alias("to")), "tops")
    tops = tops.unionAll(alone.join(tops.select("node"), "node", "left_anti").distinct())
    names = tops.groupBy("to").agg(F.min("node").alias("component"))
    return kept(tops.join(names, "to").select("node", "component"), "labels")


def hub_pairs(crowded: DataFrame, hubs: DataFrame) -> DataFrame:
    """Each representative with the hub of most of its buckets."""
    shared = crowded.join(hubs, "key").filter("rep <> hub").groupBy("rep", "hub").agg(F.count("*").alias("times"))
    best = shared.groupBy("rep").agg(F.max(F.struct("times", (-F.col("hub")).alias("less"))).alias("best"))
    return best.select(F.col("rep").alias("a"), (-F.col("best.less")).alias("b"))


def delegate_pairs(crowded: DataFrame, found: DataFrame) -> DataFrame:
    """Each representative outside its bucket's largest component with one member of that component."""
    named = crowded.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    groups = named.groupBy("key", "component").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("key", "rep").alias("by"), "rep")).alias("one"))
    main = groups.groupBy("key").agg(F.max(F.struct("n", "component", "one")).alias("main"), F.count("*").alias("groups")).filter("groups > 1")
    pairs = named.join(main.select("key", "main.component", "main.one.rep").toDF("key", "main", "other"), "key").filter("component <> main")
    return pairs.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def open_pairs(clusters: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of one cluster in different components that a link could join, by exact filters.

    Shingles are ordered by how few members of the cluster have them. Similar sets share one of the
    first shingles of each (prefix filter), and from the first shared one on must have enough left
    (positional filter). A document with too many shingles of its own thus meets no other.
    """
    named = clusters.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = named.groupBy("cluster").agg(F.min("component").alias("c_1"), F.max("component").alias("c_2"), F.count("*").alias("members"))
    # the only pair of a cluster of two has been looked at
    rows = kept(named.join(mixed.filter("c_1 <> c_2 and members > 2").select("cluster"), "cluster"), "mixed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pa.array([np.frombuffer(s, np.int64) for s in batch["shingles"].to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["cluster"], batch["rep"], lists], ["cluster", "rep", "shingles"])

    listed = rows.select("cluster", "rep").join(sets.dropDuplicates(["rep"]), "rep")
    single = listed.select("cluster", "rep", "shingles").mapInArrow(run, "cluster long, rep long, shingles array<long>")
    single = single.select("cluster", "rep", F.explode("shingles").alias("shingle"))
    common = single.groupBy("cluster", "shingle").agg(F.count("*").alias("df"))
    ordered = single.join(common, ["cluster", "shingle"]).groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("all"))
    n = F.size("all")
    length = n - F.ceil(n * F.lit(percent) / 100) + 1
    first = ordered.select("rep", n.alias("n"), F.posexplode(F.slice("all", 1, length)).alias("at", "one")).filter("one.df > 1")
    first = kept(first.select("rep", "n", (F.col("n") - F.col("at")).alias("left"), F.col("one.shingle").alias("shingle")).join(rows, "rep"), "prefixes")

    main = rows.groupBy("cluster", "component").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    first = first.join(main, "cluster")
    one = first.filter("component <> main").select("cluster", "shingle", F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("left").alias("left_a"), F.col("component").alias("c_a"))
    other = first.select("cluster", "shingle", F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("left").alias("left_b"), F.col("component").alias("c_b"), "main")
    once = (F.col("c_b") == F.col("main")) | (F.col("a") < F.col("b"))
    fits = (F.col("c_a") != F.col("c_b")) & once
    fits &= 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    fits &= (100 + percent) * F.least("left_a", "left_b") >= percent * (F.col("n_a") + F.col("n_b"))
    pairs = one.join(other, ["cluster", "shingle"]).filter(fits)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def membership(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, marks, n_shingles, first) for every row: ``first`` is the (doc_id, marks) that its component is named by."""
    own = kept(features(documents, width), "features")
    full = own.filter("n_shingles > 0 and doc_id is not null")
    by = ["doc_id", *MARK]
    found = full.groupBy(*PRINT).agg(F.min(F.struct(*by, "keys")).alias("one"))
    # numbers are fixed by writing the table; no later step derives them again
    classes = kept(found.select(F.monotonically_increasing_id().alias("rep"), *PRINT, F.struct(*[f"one.{c}" for c in by]).alias("own"), "one.keys"), "classes")
    bands = classes.select("rep", F.explode("keys").alias("key"))
    hubs = kept(bands.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).filter("size > 1").drop("size"), "hubs")
    crowded = kept(bands.join(hubs.select("key"), "key"), "crowded")
    wanted = classes.join(crowded.select("rep").distinct(), "rep", "left_semi").select("rep", *PRINT, F.col("own.doc_id").alias("doc_id"))
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = kept(set_table(texts.join(wanted, "doc_id"), width), "sets")

    stars = kept(crowded.join(hubs, "key").filter("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct(), "stars")
    clusters = components(stars).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    links = kept(confirmed(hub_pairs(crowded, hubs), sets, percent), "links")
    links = kept(links.union(confirmed(delegate_pairs(crowded, components(links)), sets, percent)), "links")
    links = links.union(kept(confirmed(open_pairs(clusters, components(links), sets, percent), sets, percent), "links"))
    joined = components(links)

    named = classes.select(*PRINT, "rep", "own").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    names = named.filter("component is not null").groupBy("component").agg(F.min("own").alias("least"))
    named = named.join(names, "component", "left").select(*PRINT, F.coalesce("least", "own").alias("first"))
    in_class = full.select(*by, *PRINT).join(named, PRINT).select(*by, "n_shingles", "first")
    alone = own.filter("n_shingles = 0 or doc_id is null").select(*by, "n_shingles", F.struct(*by).alias("first"))
    return in_class.unionAll(alone)


def grouped(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row."""
    found = membership(documents, width, percent).select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def deduplicated(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near copies, and all rows without id; columns as they came.

    Rows are dropped by id and text, so another text under a dropped row's id stays.
    """
    own = F.struct("doc_id", *MARK)
    gone = membership(documents, width, percent).filter(F.col("doc_id").isNotNull() & (own != F.col("first")))
    gone = gone.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", *MARK)]).distinct()
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("record"))
    rows = rows.select("record", F.col("record.doc_id").cast("long").alias("_id"), *[m.alias(f"_m{i}") for i, m in enumerate(marks("record.text"))])
    same = (F.col("_id") == F.col("_doc_id")) & (F.col("_m0") == F.col("_mark_1")) & (F.col("_m1") == F.col("_mark_2"))
    stay = rows.join(gone, same, "left_anti")
    # rows that repeat an id and a text are copies as well
    once = stay.filter("_id is not null").dropDuplicates(["_id", "_m0", "_m1"]).select("record.*")
    return once.unionAll(stay.filter("_id is null").select("record.*"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS n
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY 1, 2
), link AS (SELECT a, b FROM shared WHERE 100 * n >= 80 * (na + nb - n)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
least_id AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM s JOIN least_id l ON s.doc_id = l.doc_id
"""
