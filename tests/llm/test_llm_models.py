"""Quality, toxicity and line rules: held-out accuracy, exact counts, awkward rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import line_rules, quality, toxicity
from tillroll.llm.shared import text_parts
from tests.llm.conftest import sentence

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def auc(y, s):
    order = np.argsort(np.argsort(s, kind="stable"), kind="stable") + 1
    n1 = y.sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    got = quality.digest(docs, labels)
    assert got.count() == docs.count()
    both = got.join(labels, "doc_id").toPandas()
    held = both[both.held_out]
    assert auc(held.quality.to_numpy(), held.score.to_numpy()) > 0.93
    assert (both.predicted == (both.score >= 0.3)).all() and both.score.between(0, 1).all()
    assert held.predicted[held.quality == 1].mean() > 0.95


def test_held_out_labels_change_nothing(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality.held_out(5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    turned = turned.withColumn("toxic", F.when(quality.held_out(3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for digest in (quality.digest, toxicity.digest):
        one = {r.doc_id: r.score for r in digest(docs, labels).collect()}
        assert one == {r.doc_id: r.score for r in digest(docs.drop("lang", "source"), turned).collect()}


def test_prior_is_near_the_truth():
    rng = np.random.default_rng(1)
    for prior in (0.4, 0.8):
        good = lambda n: np.column_stack([rng.normal(1.5, 1, (n, 4)), np.ones(n)])
        bad = lambda n: np.column_stack([rng.normal(-1.5, 1, (n, 4)), np.ones(n)])
        n_u = 4000
        x = np.concatenate([good(2000), good(int(prior * n_u)), bad(n_u - int(prior * n_u))]).astype(np.float32)
        order = rng.permutation(len(x))
        positive = (np.arange(len(x)) < 2000)[order]
        assert abs(quality.estimate_prior(x[order], positive) - prior) < 0.08


def test_risk_slope_is_the_slope_of_the_risk():
    rng = np.random.default_rng(2)
    positive = np.arange(30) < 10
    for shift in (3.0, -3.0):  # the second makes the negative part fall below zero
        f = rng.normal(0, 1, 30) + np.where(positive, 2, shift)
        slope = quality.risk_slope(positive, 0.5)(f)

        def risk(f):
            minus = np.logaddexp(0, f)
            below = minus[~positive].mean() - 0.5 * minus[positive].mean()
            return 0.5 * np.logaddexp(0, -f[positive]).mean() + below if below >= 0 else -below

        for i in (0, 5, 15, 25):
            step = np.zeros(30)
            step[i] = 1e-5
            assert abs((risk(f + step) - risk(f - step)) / 2e-5 - slope[i]) < 1e-6


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    bad = ["zorg", "blurf", "snakwort"]
    rows, labels = [], []
    for i in range(1500):
        words = ["the"] + sentence(rng, rng.randint(20, 80)).split()
        toxic = int(i % 4 == 0)
        if toxic:
            words.insert(rng.randint(0, len(words)), (rng.choice(bad) + rng.choice(["", "ing", "ed", "x!!"])).title())
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    both = toxicity.digest(docs, labels).join(labels, "doc_id").toPandas()
    held = both[both.held_out]
    assert held.predicted[held.toxic == 1].mean() > 0.9
    assert held.predicted[held.toxic == 0].mean() < 0.03


def test_toxicity_thresholds_use_all_labelled_rows():
    """At the true shares of the labels, from rows outside the sample; with few rows also from cross-fitted ones."""
    rng = np.random.default_rng(8)
    toxic, other = rng.normal(1.5, 1, 4000), rng.normal(-1.5, 1, 36_000)
    at = np.linspace(-3, 4, 1401)
    hits, wrong = (toxic[:, None] >= at).sum(axis=0), (other[:, None] >= at).sum(axis=0)
    want = at[(2 * hits / (hits + wrong + 4000)).argmax()]
    rows = np.zeros((toxicity.OTHER + 1, 2, 2 * toxicity.MOST * toxicity.CELLS + 1))
    np.add.at(rows, (0, 1, toxicity.cell(toxic[:2000])), 1)  # the sample has the other 2,000
    np.add.at(rows, (0, 0, toxicity.cell(other[:33_000])), 1)
    np.add.at(rows, (1, 0, toxicity.cell(other[:5])), 1)
    found = toxicity.marks(rows, np.array([3000, 2000]), ([], None, None), None)
    assert abs(found[0] - want) < 0.25 and (abs(found[1:] - want) < 0.25).all()

    words = rng.integers(0, 400, (600, 12, 4)).astype(np.int32)
    labels = (np.arange(600) % 3 == 0).astype(int)
    words[labels == 1, 3] = 7
    model = toxicity.Convolutions()
    model.fit(list(words), labels)
    few = toxicity.marks(np.zeros_like(rows), np.array([400, 200]), (list(words), labels, np.zeros(600, int)), model)
    logit = toxicity.cross_fitted(list(words), labels, model)
    assert ((logit >= few[0]) == labels).mean() > 0.95 and len(set(few)) == 1


def test_toxicity_histogram_has_each_labelled_row_once(tables, monkeypatch):
    docs, labels = tables
    monkeypatch.setattr(toxicity, "SAMPLE", {0: 20, 1: 5})
    found = docs.select("doc_id", F.lit(0).alias("language"), (F.col("doc_id") % 7 - 3.0).alias("logit"))
    outside, inside = toxicity.histogram(found, labels)
    ids = labels.filter(~toxicity.held_out(toxicity.MOD, toxicity.REST)).filter("toxic is not null").join(docs, "doc_id")
    counts = {r["toxic"]: r["count"] for r in ids.groupBy("toxic").count().collect()}
    assert (outside.sum(axis=(0, 2)) + inside).tolist() == [counts.get(0, 0), counts.get(1, 0)]
    assert 0 < inside[0] < 60 and inside[1] < 20


def test_convolution_slopes():
    """The step of a batch goes down the loss."""
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 50, (n, 4)).astype(np.int32) for n in (0, 1, 2, 5, 40, 60)]
    y = np.array([0, 1, 0, 1, 0, 1])
    model = toxicity.Convolutions()

    def loss():
        first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        f = model.logits(np.concatenate(docs), first)
        return float(np.logaddexp(0, np.where(y == 1, -f, f)).mean())

    before = loss()
    for _ in range(30):
        model.learn(docs, y, np.ones(6), 0.05)
    assert loss() < before * 0.6
    one = np.concatenate([model.logits(d, np.array([0, len(d)])) for d in docs])
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    assert np.allclose(one, model.logits(np.concatenate(docs), first), atol=1e-5)


def brute_counts(text):
    text = text or ""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    ws = word.findall(text)
    windows = Counter(tuple(ws[j : j + 8]) for j in range(len(ws) - 7))
    cover = {k for j in range(len(ws) - 7) if windows[tuple(ws[j : j + 8])] > 1 for k in range(j, j + 8)}
    lines = [x for x in text.split("\n") if word.search(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


def test_base_counts_equal_brute_force(tables, odd_documents, no_documents):
    docs, labels = tables
    rng = random.Random(8)
    texts = ["\n", "a\n", "\na", "a\na\n\na", " a\na", "x y z " * 40, "é\né\n é", "a|b <c>\n\n\n"]
    texts += ["".join(rng.choice(["a ", "b ", "\n", "é", "# ", " "]) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    spark = docs.sparkSession
    made = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for rows in (docs, odd_documents, made):
        got = line_rules.digest(rows, labels)
        columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        want = [(r.doc_id, *(c := brute_counts(r.text)), c[0] < 20 or 100 * c[4] > 30 * c[0]) for r in rows.select("doc_id", "text").collect()]
        assert Counter(tuple(r) for r in got.select(columns).collect()) == Counter(want)
        assert got.filter("base_failed and kept").count() == 0
    assert line_rules.digest(no_documents, labels).count() == 0


def test_line_rules_keep_clean_documents(tables):
    docs, labels = tables
    both = line_rules.digest(docs, labels).join(labels, "doc_id").toPandas()
    fine = both[~both.base_failed]
    assert fine.kept[fine.quality == 1].mean() > 0.98
    assert fine.kept[fine.quality == 0].mean() < 0.1


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(5)
    stats = rng.random((40, len(line_rules.STATS))).astype(np.float32)
    sizes = [1, 7, 3, 9, 2, 8, 10]
    rows = np.repeat(np.arange(7) * 2, sizes)
    field = line_rules.LineField(stats, rows, rng.integers(0, 2, 40), steps=3)
    field.values["step"] = rng.normal(0, 2, (2, 2))
    emit = field._emissions(field.levels(stats))
    got = field.decode(stats, rows)
    at = 0
    for n in sizes:
        paths = [[(p >> k) & 1 for k in range(n)] for p in range(2**n)]
        value = lambda path: (
            field.values["start"][path[0]] + sum(emit[at + k, s] for k, s in enumerate(path)) + sum(field.values["step"][a, b] for a, b in zip(path, path[1:]))
        )
        assert got[at : at + n].tolist() == max(paths, key=value)
        at += n


def test_field_marginals_equal_all_paths():
    rng = np.random.default_rng(6)
    emit, sizes = rng.normal(0, 1, (9, 2)), [4, 1, 4]
    rows, labels = np.repeat(np.arange(3), sizes), rng.integers(0, 2, 9)
    field = line_rules.LineField(np.zeros((0, 20), np.float32), rows[:0], labels[:0])
    field.values["step"], field.values["start"] = rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)
    one, _, _ = field._marginals(emit, line_rules.Chains(rows), labels, np.ones(9))
    at = 0
    for n in sizes:
        total, hits = 0.0, np.zeros(n)
        for p in range(2**n):
            path = [(p >> k) & 1 for k in range(n)]
            value = np.exp(field.values["start"][path[0]] + sum(emit[at + k, s] for k, s in enumerate(path)) + sum(field.values["step"][a, b] for a, b in zip(path, path[1:])))
            total += value
            hits += value * np.array(path)
        assert np.allclose(one[at : at + n], hits / total)
        at += n


def test_awkward_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, 1), (34, None, None), (None, 1, 1), (37, 1, 0)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for digest in (quality.digest, toxicity.digest):
        for own in (labels, none):
            got = digest(odd_documents, own)
            assert got.count() == odd_documents.count()
            assert got.filter("score is null or predicted is null or held_out is null").count() == 0
            assert digest(no_documents, own).count() == 0
    for module, model in ((quality, quality.fit(odd_documents, labels)), (line_rules, line_rules.fit(odd_documents, labels))):
        assert module.accepted(odd_documents, model).columns == odd_documents.columns
        assert module.accepted(no_documents, model).count() == 0


def test_text_parts_cover_all(spark):
    import pyarrow as pa

    column = pa.array(["aé", None, "", "x" * 50, "yz"])[1:]
    for most in (1, 3, 100):
        seen = [bytes(data[a:b]).decode() for _, data, offsets in text_parts(column, most) for a, b in zip(offsets[:-1], offsets[1:])]
        assert seen == ["", "", "x" * 50, "yz"]
