import hashlib
import random

import numpy as np
from llm_samples import docs_of, items_of, odd_texts, sentence, words

from tillroll.llm import winnowing


def brute(docs, items, window=10):
    """Rows of the query, by looking at every place of every text."""
    held = {}
    for item, text in items:
        own = words(text)
        for at in range(max(1, len(own) - window + 1) if own else 0):
            held.setdefault(tuple(own[at : at + window]), set()).add(item)
    sizes = {len(h) for h in held}
    out = []
    for doc, text in docs:
        own = words(text)
        hit, found = set(), set()
        for size in sizes:
            for at in range(len(own) - size + 1):
                if tuple(own[at : at + size]) in held:
                    hit.update(range(at, at + size))
                    found |= held[tuple(own[at : at + size])]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(own), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    items = [(i, sentence(rng, rng.choice([9, 10, 11, 14, 40]))) for i in range(30)]
    items += [(100, items[3][1]), (100, sentence(rng, 12)), (101, items[5][1].upper()), (None, sentence(rng, 15)), (102, None), (103, ""), (104, "-- !")]
    items += [(200 + i, items[8][1]) for i in range(60)]  # many copies of one item
    items += [(105, "alpha beta"), (106, "solo"), (107, "Ünï cödé ñ")]
    docs = list(enumerate(odd_texts()))
    for i in range(60):
        _, text = rng.choice(items)
        own = (text or "").split(" ")
        a = rng.randint(0, len(own) // 2)
        part = own[a : a + rng.randint(5, 30)]
        docs.append((100 + i, sentence(rng, rng.randint(0, 20)) + ", " + "  ".join(part).title() + "\n" + sentence(rng, rng.randint(0, 20))))
    docs += [(500 + i, f"n{i} " + items[8][1]) for i in range(50)]  # one passage in many documents
    docs += [(None, items[2][1]), (7, items[2][1]), (7, items[2][1]), (8, "alpha, beta solo gamma"), (9, "ünï CöDé ñ"), (10, " ".join(t or "" for _, t in items) * 3)]
    assert result(winnowing.digest(docs_of(spark, docs), items_of(spark, items))) == brute(docs, items)


def test_empty_sides(spark, no_documents, odd_documents):
    some = items_of(spark, [(1, "one two three")])
    assert winnowing.digest(no_documents, some).count() == 0
    none = winnowing.digest(odd_documents, some.limit(0))
    assert none.count() == odd_documents.count() and none.filter("contaminated or n_items > 0").count() == 0


def test_spans_join_windows_that_overlap_or_touch(spark):
    rng = random.Random(9)
    text = sentence(rng, 25)
    own = text.split(" ")
    docs = docs_of(spark, [(1, "start " + text + " middle " + " ".join(own[:10]) + " " + " ".join(own[5:15]))])
    hits = winnowing.find(docs, items_of(spark, [(1, text)]))
    assert sorted((r["start"], r["n_words"]) for r in hits.spans().collect()) == [(1, 25), (27, 20)]
    assert [r["item_ids"] for r in hits.item_lists().collect()] == [["1"]]


def test_every_shared_window_shares_a_fingerprint():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 2**63, 500).astype(np.uint64)
    alone = rng.integers(0, 2**63, 40).astype(np.uint64)
    alone[15:25] = hashes[200:210]
    _, prints = winnowing.fingerprints(hashes, np.array([0, 500]), 10, 5)
    at, own = winnowing.fingerprints(alone, np.array([0, 40]), 10, 5)
    assert own[at.tolist().index(15)] == prints[200]
    assert len(np.unique(prints)) < 0.5 * len(prints)  # neighbours share them
