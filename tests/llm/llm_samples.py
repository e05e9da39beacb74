"""Texts and layouts that the tests of this folder share."""

import random
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for columns of their own
        T.StructField("bucket", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("sequence_id", T.StringType()),
        T.StructField("component_id", T.MapType(T.StringType(), T.StringType())),
    ]
)

SYLLABLES = "the and ing er on at tion es ou ha th re ed nd in".split()


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def odd_texts() -> list:
    rng = random.Random(11)
    texts = [None, "", " ", "\n\n", "a", "Σ ΑΣ", "x<|endoftext|>y", "é́ ñ 日本 😀", "one two", "a\x00b \x1c c"]
    texts += [sentence(rng, n) for n in (3, 25, 60, 90, 140, 300)]
    texts += [sentence(rng, 12_000)]
    same = sentence(rng, 80)
    texts += [same, same, same + " more", same.upper()]
    return texts


ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("words", T.StringType()), T.StructField("class", T.StringType())])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "w", "c") for i, t in rows], ITEMS).repartition(3)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *[None] * 8) for i, t in rows], DOCUMENTS).repartition(4)
