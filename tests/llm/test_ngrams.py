"""The n-gram model against a plain dictionary version."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.llm import ngrams

SF_DIR = "/root/testdata/sf0.001"


def tokens_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\n"]


def plain(rows, order):
    """{id: (n_tokens, n_known, train_tokens, base, score)}; rows are (id, text, held out)."""
    docs = [(i, tokens_of(t), h) for i, t, h in rows]
    grams = [Counter() for _ in range(order + 1)]
    for _, w, h in docs:
        if not h:
            for n in range(1, order + 1):
                padded = ["<s>", *w] if n > 1 else w
                grams[n].update(tuple(padded[k : k + n]) for k in range(len(padded) - n + 1))
    total, different = sum(grams[1].values()), len(grams[1])
    starts = grams[1][("\n",)]
    out = {}
    for i, w, _ in docs:
        padded = ["<s>", *w]
        base = score = known = 0
        for k, x in enumerate(w):
            p = (grams[1][(x,)] + 1) / (total + different + 1)
            known += grams[1][(x,)] > 0
            base += math.log10(p)
            for n in range(2, order + 1):
                if k + 2 < n:
                    continue
                context = tuple(padded[k + 2 - n : k + 1])
                t = starts if context == ("<s>",) else grams[n - 1][context]
                if t < (1 if n == 2 else ngrams.LEAST_CONTEXT):
                    continue
                c = grams[n][(*context, x)]
                f = 10 ** (round(min(max(math.log10(c / t) / -9 * 255, 0), 255)) / 255 * -9) if c else 0
                p = (t * f + ngrams.PRIOR * p) / (t + ngrams.PRIOR)
            score += math.log10(p)
        out[i] = (len(w), known, total, base, score)
    return out


def same(df, rows, order):
    want = plain(rows, order)
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()}
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert got[i][:3] == w[:3], (i, got[i], w)
        assert got[i][3:] == pytest.approx(w[3:], rel=1e-9), (i, got[i], w)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_equals_dictionaries(spark, order, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in docs.collect()]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    same(ngrams.score(docs, held, order), rows, order)


def test_nulls_repeats_empty_texts_and_clashing_names(spark):
    texts = ["a b a b a b", "A B c", "", None, " \t\n", "x\x00y \x00 é É", "z " * 3000, "never seen words"]
    rows = [(i, t, i == 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean").withColumn("block", F.lit("x"))
    same(ngrams.score(docs, F.col("held")), rows, 3)
    out = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    assert ngrams.score(out, F.lit(None).cast("boolean")).count() == 3
    assert ngrams.score(out, F.lit(True)).agg(F.max("train_tokens")).first()[0] == 0
    assert ngrams.score(out.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("top", [3, 300, 70_000, 1 << 40])
def test_elias_fano(top):
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 500):
        v = np.sort(rng.integers(0, top, n))
        parts, bits, size = ngrams.EliasFano.encode(v)
        ef = ngrams.EliasFano(dict(zip(parts, ngrams.mapped(list(parts.values())), strict=True)), bits, size)
        assert ef.get(np.arange(n)).tolist() == v.tolist()
        x = np.concatenate((v, v + 1, np.maximum(v - 1, 0), rng.integers(0, 2 * top, 200)))
        assert ef.successor(x).tolist() == np.searchsorted(v, x).tolist()


def test_level_finds_exactly_what_it_holds():
    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(0, 60, (900, 2)), axis=0)
    context, word = pairs[:, 0] - 1, pairs[:, 1] << 32
    count = rng.integers(1, 5, len(pairs))
    level = ngrams.Level(context, word, count, np.full(len(pairs), 100))
    ask = rng.integers(0, 70, (4000, 2))
    place, n, code = level.find(ask[:, 0] - 1, ask[:, 1] << 32)
    known = {(a, b): (i, c) for i, (a, b, c) in enumerate(zip(*pairs.T.tolist(), count.tolist(), strict=True))}
    for (a, b), i, c, q in zip(ask.tolist(), place.tolist(), n.tolist(), code.tolist(), strict=True):
        assert (i, c) == known.get((a, b), (-1, 0))
        assert q == (ngrams.code_of(np.array([c / 100]))[0] if c else 0)


def test_bytes_round_trip():
    for a in ([], [0], [255, 256, 1 << 50], list(range(1000))):
        assert ngrams.unpacked(ngrams.packed(np.array(a, np.int64))).tolist() == a


@pytest.mark.parametrize("top", [1, 50, 1 << 30, 1 << 62])
def test_order_and_different_equal_numpy(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 1000):
        plain = rng.integers(0, top, n)
        names = plain % (1 << 21) | rng.integers(0, 1 << 13, n) << 32  # a shard and a place in it
        for x in (plain, names, np.sort(plain)[::-1], plain.astype(np.int32) % 7 if top < 1 << 31 else plain):
            assert ngrams.order_of(x).tolist() == np.argsort(x, kind="stable").tolist()
            want = np.unique(x, return_index=True, return_inverse=True)
            assert all(a.tolist() == b.tolist() for a, b in zip(ngrams.different(x), want, strict=True))


def test_selecting_many_equals_selecting_few():
    v = np.sort(np.random.default_rng(1).integers(0, 1 << 20, 3000))
    parts, bits, n = ngrams.EliasFano.encode(v)
    ef = ngrams.EliasFano(dict(zip(parts, ngrams.mapped(list(parts.values())), strict=True)), bits, n)
    assert ef.get(np.arange(n)).tolist() == v.tolist()
    assert [int(ef.get(np.array([i]))[0]) for i in range(n)] == v.tolist()
