"""Packing: ids against the tokenizers library, every id once, little padding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sessionloom.llm import packing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = [
    "", " ", "  ", "a", "a b", "a  b", " a", "a ", "a \n b", "a\n\nb  c\td", "it's we'll 12 34.5 !! ?x", "é ß ü  x  y",
    "a\x1cb \x1c c", "日本 語", "x<|endoftext|>y z", "\r\n \r\n", "😀 😀  😀", "​ a", "a 　b", "A" * 3000,
]


def test_ids_equal_the_tokenizers_library(spark, reference):
    enc = packing.encoder(packing.public_files())
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    for t in texts:
        assert enc.ids(t).tolist() == reference.encode(t, add_special_tokens=False).ids, t[:80]


def test_new_words_of_a_text_are_encoded_in_one_call(reference, monkeypatch):
    rng = random.Random(8)
    marks = ["a", "B", "é", "日", "7", ",", "'s", "\n", "\t", "\x1c", "\u00a0", "\u3000", "\x85", "😀"]
    words = ["".join(rng.choices("abcdefgh,.'1", k=rng.randint(1, 9))) for _ in range(600)] + ["x" * 100]
    enc = packing.Encoder(*packing.public_files())
    calls, encode = [], enc.encode
    monkeypatch.setattr(enc, "encode", lambda text: calls.append(text) or encode(text))
    line = " ".join(words)
    for text in (line, line, line[::-1] + "\n", "\n" + line):
        calls.clear()
        assert enc.ids(text).tolist() == reference.encode(text, add_special_tokens=False).ids
        assert len(calls) <= 3
    assert "x" * 100 not in enc.known
    monkeypatch.setattr(packing, "CHUNKS", 50)  # what is remembered goes in between
    for _ in range(2000):
        text = "".join(rng.choices([*marks, " ", " ", " ", " a"], k=rng.randint(1, 14)))
        assert enc.ids(text).tolist() == reference.encode(text, add_special_tokens=False).ids, text


def check(rows, texts, reference, capacity=packing.CAPACITY):
    ids = {i: [*reference.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts}
    covered, sequences = {}, {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert covered.keys() == ids.keys()
    for i, parts in covered.items():
        assert [s for s, _ in sorted(parts)] == list(np.cumsum([0] + [n for _, n in sorted(parts)])[:-1])
        assert sum(n for _, n in parts) == len(ids[i])
    for parts in sequences.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return sum(n for p in sequences.values() for _, n in p) / (capacity * len(sequences))


def test_small_corpus_is_packed_tightly(spark, reference):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    filled = check(packing.pack(packing.pieces(docs)).collect(), [(r.doc_id, r.text) for r in docs.collect()], reference)
    assert filled > 0.95


def test_nulls_ties_and_clashing_names(spark, reference):
    texts = [(1, None), (2, ""), (3, "a b"), (4, "a b"), (5, "word " * 9000), (6, TEXTS[14])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("length", F.lit("x")).withColumn("class", F.lit(1))
    check(packing.pack(packing.pieces(docs)).collect(), texts, reference)
    nobody = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")
    assert packing.pack(packing.pieces(nobody)).count() == 2
    assert packing.pack(packing.pieces(docs.limit(0))).count() == 0


def test_program_is_near_the_bound():
    rng = np.random.default_rng(3)
    histogram = {c: int(n) for c, n in enumerate(rng.integers(0, 400, 256), 1)}
    plan = packing.plan_patterns(histogram, 256)
    got = {}
    for times, pattern in plan:
        assert sum(c * n for c, n in pattern.items()) <= 256
        for c, n in pattern.items():
            got[c] = got.get(c, 0) + n * times
    assert got == {c: n for c, n in histogram.items() if n}
    used = sum(t for t, _ in plan)
    big = sum(n for c, n in histogram.items() if c > 128)  # no two of them fit together
    assert used <= 1.02 * max(sum(c * n for c, n in histogram.items()) / 256, big) + 20


def test_knapsack_against_all_patterns():
    sizes, prices = np.array([7, 5, 3, 2]), np.array([0.71, 0.5, 0.31, 0.19])
    best = max(
        a * 0.71 + b * 0.5 + c * 0.31 + d * 0.19
        for a in range(3) for b in range(4) for c in range(6) for d in range(9) if 7 * a + 5 * b + 3 * c + 2 * d <= 16
    )
    worth, counts = packing.best_pattern(prices, sizes, 16)
    assert abs(worth - best) < 1e-9 and counts @ sizes <= 16 and abs(counts @ prices - worth) < 1e-9
