"""Token files, BPE and packing against the tokenizers library on whole texts."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import bpe_rows, encode, packing, token_files
from tillroll.llm.bpe import coder
from tillroll.llm.encode import encoder
from tillroll.llm.shared import tokenizer_path
from tests.llm.conftest import odd_texts


def library(name: str) -> Tokenizer:
    found = Tokenizer.from_file(tokenizer_path(name))
    found.no_truncation()
    found.no_padding()
    return found


def strange(n: int) -> list[str]:
    rng = random.Random(5)
    letters = ["a", "B", "é", "'", "s", " ", "\n", "1", "Σ", "́", " ", "<|endoftext|>", "%", "　", "ß", "\x1f", "aa", "İ"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", ["bytes", "words"])
def test_pieces_give_the_ids_of_whole_texts(name):
    texts = [t or "" for t in odd_texts()] + strange(200)
    want = [x.ids for x in library(name).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder(tokenizer_path(name))(texts)] == want


def signed(n: int) -> list[str]:
    """Words with signs behind, before and between them, letters of other scripts and marks among them."""
    rng = random.Random(12)
    words = ["stem", "Stem", "été", "don't", "x'", "İi", "İ", "ß", "É", "µ", "ÿ", "Ŀ", "ŉ", "ǅ", "ʰ", "Σας", "語", "4", "²", "ª", "e\u0301", "ɐ", "a-b", "(", "é(", ""]
    signs = ["", ".", ",", "...", "?!", "###", "%%%", "<|", "|>", ".'s", "'s", ").", "=", "<\u0338", ",x", "&", "$5"]
    gaps = [" ", " ", "  ", "\n", " \n ", "\u3000"]
    return ["".join(rng.choice(words) + rng.choice(signs) + rng.choice(gaps) for _ in range(rng.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("name", ["bytes", "words"])
def test_signs_at_the_end_of_words(name):
    texts = signed(600)
    want = [x.ids for x in library(name).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in encode.Encoder(tokenizer_path(name))(texts)] == want


@pytest.mark.parametrize("name", ["bytes", "words"])
def test_the_library_sees_a_word_once_and_a_full_memory_is_not_lost(name, monkeypatch):
    """Each word was asked for with every run of signs behind it, and all of them again after a full memory."""
    monkeypatch.setattr(encode, "MEMORY", 20)
    own, asked, ask = encode.Encoder(tokenizer_path(name)), [], encode.Encoder._library
    monkeypatch.setattr(encode.Encoder, "_library", lambda self, texts: [asked.extend(texts), ask(self, texts)][1])
    words = ["wird%s" % a + b for a in "abcdefgh" for b in "xyz"]
    texts = [" ".join(w + sign for w in words) for sign in ("", ",", ".", "!?")]
    want = [x.ids for x in library(name).encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u2").tolist() for text in texts for x in own([text])]
    assert got == want
    assert sum(text.count("wirdcy") for text in asked) == 1


def test_a_batch_is_cut_a_run_of_texts_at_a_time(monkeypatch):
    """All texts of a batch and the pieces of 4 million characters were Python strings at once: 60 MB here."""
    stub = type("Task", (), {"get": staticmethod(lambda: type("Own", (), {"partitionId": lambda self: 0})())})
    monkeypatch.setattr(packing, "TaskContext", stub)
    text = "some words are here " * 100
    column = pa.array([text, None, ""] + [text] * 6000 + [None])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(column)), pa.int64()), column], ["doc_id", "text"])
    run = packing._pack_part(tokenizer_path("words"), 2048)
    encoder(tokenizer_path("words"))
    tracemalloc.start()
    try:
        got = pa.Table.from_batches(run(iter([batch]))).to_pylist()
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(got) == len(column) and {r["doc_id"] for r in got if r["length"] == 1} == {1, 2, 6003}
    assert most < 30_000_000


def test_runs_of_texts_keep_all_rows_in_order():
    texts = ["", None, "é" * 3, "abc", None, "x" * 50, "", "y"]
    for column in (pa.array(texts), pa.array(["cut off", *texts])[1:], pa.array(texts, pa.large_string())):
        for most in (1, 4, 6, 1000):
            runs = list(encode.batches(column, most))
            assert [t for _, run in runs for t in run] == texts
            assert [at for at, _ in runs] == [sum(len(r) for _, r in runs[:i]) for i in range(len(runs))]
    assert list(encode.batches(pa.array([], pa.string()))) == []
    assert [run for _, run in encode.batches(pa.array([None, None], pa.string()))] == [[None, None]]


def test_pair_index_equals_library():
    texts = [t or "" for t in odd_texts()] + strange(300) + ["a" * n for n in range(1, 40)] + ["ab" * 3000]
    lib, own = library("words"), coder(tokenizer_path("words"))
    for text, ids in zip(texts, own.encode(texts)):
        want = lib.encode(text, add_special_tokens=False).ids
        assert ids == want, text[:80]
        assert own.decode(ids) == lib.decode(want, skip_special_tokens=False)


def test_bpe_rows(odd_documents, no_documents):
    path = tokenizer_path("words")
    lib = library("words")
    rows = odd_documents.select("doc_id", "text").collect()
    want = []
    for r in rows:
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe_rows.digest(odd_documents, path).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert bpe_rows.digest(no_documents, path).count() == 0
    back = bpe_rows.decode_rows(bpe_rows.encode_rows(odd_documents, path), path)
    assert back.count() == len(rows)


def brute_ids(name, rows):
    lib = library(name)
    return [(r.doc_id, r.text, [*lib.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in rows]


def test_token_files(spark, odd_documents, no_documents, tmp_path):
    docs = brute_ids("bytes", odd_documents.select("doc_id", "text").collect())
    docs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc_id, _, ids in docs:
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    for block in (1, 500, 1 << 20):  # one document a block, some, all
        got = token_files.digest(odd_documents, tokenizer_path("bytes"), block).collect()
        assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want
    assert token_files.digest(no_documents, tokenizer_path("bytes")).count() == 0
    path = str(tmp_path / "files")
    token_files.write(odd_documents, path, tokenizer_path("bytes"))
    assert token_files.document_ids(spark, path, 31) == [ids for i, _, ids in docs if i == 31]


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((1, 0), (1, 99), (5, 3), (1000, 10), (1000, 10**6), (3000, 10**9)):
        values = np.sort(rng.integers(0, top + 1, n))
        code = token_files.EliasFano.of(values)
        assert (code.select(np.arange(n)) == values).all()
        some = rng.integers(0, n, 20)
        assert (code.select(some) == values[some]).all()
        assert code.select([int(some[0])])[0] == values[some[0]]
        bits = 8 * (len(code.low) + len(code.high))
        assert bits <= n * (3 + max(0, np.log2((top + 1) / n))) + 16
    with pytest.raises(IndexError):
        code.select([n])


@pytest.mark.parametrize("length", [7, 64, 2048])
def test_packing(odd_documents, no_documents, length):
    rows = odd_documents.select("doc_id", "text").collect()
    got = packing.pack(odd_documents, tokenizer_path("words"), length).toPandas()
    want = []
    for doc_id, _, ids in brute_ids("words", rows):
        for piece, start in enumerate(range(0, len(ids), length)):
            own = np.array(ids[start : start + length], "<u4")
            want.append((doc_id, piece, start, len(own), zlib.crc32(own.tobytes())))
    found = [tuple(None if v != v else int(v) for v in r) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object).itertuples(index=False)]
    key = lambda r: tuple(map(str, r))
    assert sorted(found, key=key) == sorted(want, key=key)
    for _, one in got.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert one["offset"].tolist() == [0, *one["length"].cumsum().tolist()[:-1]]
        assert one["length"].sum() <= length
    least = -(-int(got["length"].sum()) // length)
    assert got["sequence_id"].nunique() <= least * 1.1 + 2
    assert packing.pack(no_documents, tokenizer_path("words"), length).count() == 0


def test_sum_of_squares_takes_the_best_place():
    rng = random.Random(2)
    packer = packing.SumOfSquares(20)
    gaps: dict[int, int] = {}  # sequence -> room
    for _ in range(400):
        size = rng.choice([3, 4, 5, 7, 9, 12, 20])
        cost = lambda rooms: sum(sum(r == g for r in rooms) ** 2 for g in range(1, 20))
        options = {n: cost([r - size if m == n else r for m, r in gaps.items()]) for n, room in gaps.items() if room >= size}
        least = min([*options.values(), cost([*gaps.values(), 20 - size])])
        number, offset = packer.place(size)
        assert offset == 20 - gaps.get(number, 20)
        gaps[number] = gaps.get(number, 20) - size
        assert cost(gaps.values()) == least


def test_one_text_of_many_rows(spark):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("same words again").alias("text"))
    got = packing.pack(rows, tokenizer_path("words"), 16).toPandas()
    assert got.groupby("sequence_id")["length"].sum().min() >= 12


def test_pieces_stay_whole_through_rounds(odd_documents, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 3)
    got = packing.pack(odd_documents.repartition(12), tokenizer_path("words"), 512).toPandas()
    for _, one in got.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert one["offset"].tolist() == [0, *one["length"].cumsum().tolist()[:-1]]
        assert one["length"].sum() <= 512


def test_units_meet_whatever_their_partition(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 40)
    rng = random.Random(5)
    sizes = {((i // 10) << 32 | i % 10, -1): 1100 if i < 640 else 900 for i in range(1280)}
    sizes |= {((500 + i) << 32, 7): rng.randint(1, 2047) for i in range(60)}
    rows = [(*unit, filled) for unit, filled in sizes.items()]
    moved = packing.merged(spark.createDataFrame(rows, "sequence_id long, at long, filled long"), 2048)
    assert moved.count() == len(sizes)
    whole: dict[int, list] = {}
    for r in moved.collect():
        whole.setdefault(r["into"], []).append((r["shift"], sizes[r["sequence_id"], r["at"]]))
    for parts in whole.values():
        parts.sort()
        ends = [0, *(shift + filled for shift, filled in parts)]
        assert [shift for shift, _ in parts] == ends[:-1] and ends[-1] <= 2048
    assert sum(map(len, whole.values())) == len(sizes)
    assert len(whole) <= 700


def test_recipe_is_as_good_as_best_fit_and_small():
    rng = random.Random(6)
    sizes = [rng.randint(1, 2048) for _ in range(3000)]
    counts: dict[int, int] = {}
    for n in sizes:
        counts[n] = counts.get(n, 0) + 1
    plan = packing.recipe(counts, 2048)
    taken = {size: sorted(first + t for b in plan for s, first, _ in b.members if s == size for t in range(b.count)) for size in counts}
    assert all(taken[size] == list(range(n)) for size, n in counts.items())
    gaps: list[int] = []
    for n in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((2048 if fit is None else fit) - n)
    assert sum(b.count for b in plan) <= len(gaps)
    most = packing.recipe({s: 10**12 for s in range(1, 2048)}, 2048)  # the plan's size does not follow the counts
    assert len(most) < 5000 and sum(len(b.members) for b in most) < 50_000


def test_long_documents_and_one_short(spark, monkeypatch):
    """No task gets all sequences that stay open: they are numbered in groups."""
    monkeypatch.setattr(packing, "GROUP_ROWS", 8)
    rng = random.Random(1)
    units = [(i, -1, rng.randint(1100, 1400)) for i in range(300)] + [(999, -1, 1)]
    moved = packing.merged(spark.createDataFrame(units, "sequence_id long, at long, filled long"), 2048)
    assert len({r["into"] for r in moved.collect()}) == 300
