import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from llm_samples import docs_of, items_of, sentence, words
from pyspark.sql import functions as F

from tillroll.llm import importance


def brute(docs, target, percent=10, low=1, high=1, buckets=10000, least=20, seed=2024):
    def features(text):
        own = words(text)
        return len(own), [zlib.crc32(" ".join(own[a : a + n]).encode()) % buckets for n in range(low, high + 1) for a in range(len(own) - n + 1)]

    found = [(i, *features(t)) for i, t in docs]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, _, f in found:
        np.add.at(s, f, 1)
    for _, text in target:
        np.add.at(t, features(text)[1], 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    out = []
    for i, n, f in found:
        weight = sum(gain[b] for b in f)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    can = sorted((r for r in out if r[5] >= least and r[3] is not None), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(can[: percent * len(can) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def corpus(n=150):
    rng = random.Random(8)
    docs = [(i, sentence(rng, rng.randint(1, 60)) + rng.choice(["", ".", "\n", " Ünï-cödé"])) for i in range(n)]
    same = sentence(rng, 30)
    docs += [(1000 + i, same) for i in range(60)] + [(5, docs[5][1]), (6, None), (7, ""), (8, " ... "), (None, sentence(rng, 40))]
    docs += [(2000, sentence(rng, 9000)), (2001, "x" * 5000 + " y")]
    return docs, [(i, sentence(rng, 25)) for i in range(20)] + [(50, None), (51, "")]


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (2, 4)])
def test_equals_brute_force(spark, low, high):
    docs, target = corpus()
    got = importance.resampled(docs_of(spark, docs), items_of(spark, target), low=low, high=high)
    assert result(got) == brute(docs, target, low=low, high=high)


def test_digest_and_empty_sides(spark, odd_documents, no_documents):
    docs, target = corpus()
    assert result(importance.digest(docs_of(spark, docs), items_of(spark, target))) == brute(docs, target)
    some = items_of(spark, target)
    assert importance.digest(no_documents, some).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert result(importance.digest(odd_documents, some.limit(0))) == brute(rows, [])


def test_repeated_rows_take_a_rank_each(spark):
    text = sentence(random.Random(1), 30)
    got = importance.resampled(docs_of(spark, [(1, text)] * 40), items_of(spark, [(1, text)]), percent=50)
    assert sorted(r["rank"] for r in got.filter("rank is not null").collect()) == list(range(1, 21))


def test_segments_and_composition():
    rng = random.Random(3)
    text = sentence(rng, 700) + "  --  " + "z" * 3000 + " end"
    for most in (64, 1000, 1 << 20):
        [found, none, last] = list(importance.payloads([text, None, "one"], most))
        assert (found & 0xFFFFFFFF).tolist() == [zlib.crc32(w.encode()) for w in words(text)]
        assert (found >> 32).tolist() == [len(w.encode()) for w in words(text)]
        assert len(none) == 0 and len(last) == 1
    own = words(text)
    assert importance.features(found, 3, 3).tolist() == [zlib.crc32(" ".join(own[a : a + 3]).encode()) for a in range(len(own) - 2)]


def test_ranks_are_gapless_over_many_partitions(spark):
    docs, target = corpus(400)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = importance.resampled(docs_of(spark, docs).repartition(7), items_of(spark, target), percent=60)
        ranked = got.filter(F.col("rank").isNotNull()).orderBy("rank").select("rank", "score").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))
    assert all(a["score"] >= b["score"] for a, b in zip(ranked, ranked[1:]))
