import random
import re
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import neardup
from tests.llm.conftest import sentence


def brute(rows, width, percent=80):
    """Components over all pairs, on real shingles."""
    sets = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        ws = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)} if len(ws) >= width else {tuple(ws)} if ws else set())
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (a, x) in enumerate(zip(rows, sets)):
        for j in range(i):
            y = sets[j]
            if a[0] is not None and rows[j][0] is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                up[top(i)] = top(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i)]
        component = None if doc_id is None else min(ids)
        out.append((doc_id, len(sets[i]), component, doc_id is not None and doc_id == component))
    return Counter(out)


def chains(n=400):
    """Groups of copies whose members differ step by step, so that ends of a chain are no link."""
    rng = random.Random(9)
    texts = []
    for group in range(12):
        words = sentence(rng, rng.choice([6, 12, 30, 80, 200])).split()
        for _ in range(rng.choice([1, 2, 5, 25])):
            texts.append(" ".join(words))
            for _ in range(max(1, len(words) // 40)):
                words[rng.randrange(len(words))] = sentence(rng, 1)
    hub = sentence(rng, 60).split()
    for _ in range(60):  # pairs well below and near the threshold
        words = list(hub)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(60)] = sentence(rng, 1)
        texts.append(" ".join(words))
    texts += ["one", "One", "two words", "TWO words", "", None, " \n"]
    rng.shuffle(texts)
    return [(i * 7 + 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, width):
    rows = chains()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in neardup.grouped(df, width).collect())
    assert got == brute(rows, width)


def test_awkward_rows(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = Counter(tuple(r) for r in neardup.grouped(odd_documents, 2).collect())
    assert got == brute(rows, 2)
    assert neardup.grouped(no_documents, 2).count() == 0
    stay = neardup.deduplicated(odd_documents)
    assert stay.columns == odd_documents.columns
    want = {r[0] for r in brute(rows, 5) if r[3]} | {None}
    assert sorted(map(str, [r.doc_id for r in stay.collect()])) == sorted(map(str, want))
    assert neardup.deduplicated(no_documents).count() == 0


def test_one_id_on_two_texts_loses_neither(spark):
    rng = random.Random(4)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    near = b.rsplit(" ", 1)[0]
    rows = [(1, a), (5, a), (5, b), (9, c), (7, near), (5, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in neardup.grouped(df, 5).collect()) == brute(rows, 5)
    stay = Counter(tuple(r) for r in neardup.deduplicated(df).collect())
    assert stay == Counter([(1, a), (5, b), (9, c)])


def test_components_of_a_long_path(spark):
    nodes = list(range(100, 160))
    random.Random(1).shuffle(nodes)
    links = list(zip(nodes, nodes[1:])) + [(7, 9), (9, 8)]
    got = dict(map(tuple, neardup.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {n: 100 for n in nodes} | {7: 7, 8: 7, 9: 7}


def test_components_read_fewer_links_each_round(spark, monkeypatch):
    """Every round used to join all links with the labels again."""
    rng = random.Random(8)
    nodes = rng.sample(range(10**6), 2000)
    links = [(nodes[i], nodes[i + 1]) for i in range(1200)] + [(nodes[rng.randrange(1201, 1210)], n) for n in nodes[1210:]]
    sizes, kept = [], neardup.kept

    def counted(df, label):
        out = kept(df, label)
        sizes.extend([out.count()] * (label == "edges"))
        return out

    monkeypatch.setattr(neardup, "kept", counted)
    got = dict(map(tuple, neardup.components(spark.createDataFrame(links, "a long, b long")).collect()))
    up = {n: n for link in links for n in link}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    assert got == {n: top(n) for n in up}
    assert sizes[0] == len({frozenset(x) for x in links}) and sizes[-1] == 0 and sum(sizes[1:]) < sizes[0]


def test_components_of_no_links_and_of_a_node_with_itself(spark):
    assert neardup.components(spark.createDataFrame([], "a long, b long")).count() == 0
    links = spark.createDataFrame([(4, 4), (7, 7), (7, 5), (5, 7)], "a long, b long")
    assert dict(map(tuple, neardup.components(links).collect())) == {4: 4, 7: 5, 5: 5}


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(2)
    own = neardup.Circulant()
    errors = []
    for _ in range(60):
        both = rng.integers(0, 1 << 62, 400).astype(np.uint64)
        n = int(rng.integers(20, 380))
        x, y = both[:n], both[rng.integers(0, n) :]
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        errors.append((own.signature(x) == own.signature(y)).mean() - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04


def test_signature_is_a_shifted_permutation():
    own = neardup.Circulant()
    ring = own.windows[:, 0]
    assert (np.sort(ring) == np.arange(1 << neardup.POSITIONS_BITS)).all()
    assert (own.windows[5] == np.roll(ring, -5)[: neardup.COORDINATES]).all()
    assert (own.windows[-1] == np.roll(ring, 1)[: neardup.COORDINATES]).all()


def test_one_large_group(spark):
    rng = random.Random(3)
    words = sentence(rng, 120).split()
    rows = [(i, " ".join(words[:k] + ["x%d" % i] + words[k + 1 :])) for i in range(600) for k in [rng.randrange(120)]]
    rows += [(1000 + i, " ".join(words)) for i in range(300)]
    got = neardup.grouped(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1
