import zlib
from collections import Counter

from pyspark.sql import functions as F

from tillroll.llm import sharding


def test_rows_law_and_slots(odd_documents):
    for bucket_bytes in (200, 1 << 20):
        got = sharding.digest(odd_documents, 16, bucket_bytes=bucket_bytes).collect()
        want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in odd_documents.collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
        shards = Counter(r.shard for r in got)
        assert max(shards.values()) - min(shards.get(s, 0) for s in range(16)) <= 1
        for s, n in shards.items():
            assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
        assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_same_seed_same_order_other_seed_other(odd_documents):
    places = lambda df, **k: sorted((str(r.doc_id), r.text_crc32, r.shard, r.slot) for r in sharding.digest(df, bucket_bytes=900, **k).collect())
    one = places(odd_documents)
    assert one == places(odd_documents.repartition(7))
    assert one != places(odd_documents, seed=5)


def test_uniform(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("text of equal size").alias("text"))
    got = sharding.digest(rows, 2, bucket_bytes=4000).toPandas().sort_values("doc_id")
    place = got["slot"] * 2 + got["shard"]
    assert sorted(place) == list(range(4000))
    assert abs(place.corr(got["doc_id"])) < 0.06
    assert abs((place.iloc[:2000] < 2000).mean() - 0.5) < 0.05


def test_no_python_and_no_rows(spark, no_documents, odd_documents):
    assert sharding.digest(no_documents).count() == 0
    plan = sharding.digest(odd_documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_written_shards_hold_whole_rows(spark, odd_documents, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(odd_documents, path, 4)
    back = spark.read.parquet(path)
    assert back.count() == odd_documents.count()
    assert set(back.select("record.*").columns) == set(odd_documents.columns)
    assert {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
