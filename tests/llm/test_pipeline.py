from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_neardup import brute
from tests.llm.test_tokens import brute_ids
from tillroll.llm import line_rules, quality
from tillroll.llm.queries import ORACLE_SQL, QUERIES


def test_stages_decide_and_keep_columns(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    read = docs
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, read, folder)
        if i < 3:
            assert out.columns == docs.columns
        out.write.parquet(path := str(tmp_path / name))
        read = spark.read.parquet(path)
        seen.append(read)
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    good = {r.doc_id for r in quality.digest(docs, labels).filter("predicted = 1").collect()}
    assert ids[0] == good
    fine = {r.doc_id for r in line_rules.digest(docs, labels).filter("kept").collect()}
    assert ids[1] == good & fine
    rows = [(r.doc_id, r.text) for r in seen[1].collect()]
    assert ids[2] == {r[0] for r in brute(rows, 5) if r[3]}
    tokens = {d: len(x) for d, _, x in brute_ids("words", seen[2].collect())}
    packed = seen[3].toPandas()
    assert packed.groupby("doc_id")["length"].sum().to_dict() == tokens
    whole = corpus_pipeline.run(spark, folder)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, whole.select(columns).collect())) == Counter(map(tuple, seen[3].select(columns).collect()))


def test_a_text_goes_to_python_once(spark, monkeypatch):
    """The records held the text, and it was sent beside them once more."""
    folder, sent = "/root/testdata/sf0.001", []
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    own = type(docs).mapInArrow
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    models = [(quality, quality.fit(docs, labels)), (line_rules, line_rules.fit(docs, labels))]
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **k: [sent.append(self.columns), own(self, *a, **k)][1])
    raw = docs.withColumn("text", F.col("text").cast("binary"))
    for operator, model in models:
        want = [(r.doc_id, r.text) for r in operator.accepted(docs, model).collect()]
        assert sent.pop() == ["record"]
        got = [(r.doc_id, None if r.text is None else r.text.decode()) for r in operator.accepted(raw, model).collect()]
        assert sent.pop() == ["record", "text"]
        assert want and Counter(got) == Counter(want)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    from tools.check import check, connect

    folder = "/root/testdata/sf0.001"
    assert check(spark, connect(folder), folder, name, QUERIES[name], ORACLE_SQL[name]) == ""
