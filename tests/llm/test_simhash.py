"""Fingerprints, links and components against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sessionloom.llm import simhash
from sessionloom.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{node: smallest reachable} over all pairs."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def linked(prints):
    fp = np.array(sorted(prints), dtype=np.uint64)
    keep = np.array([k & (1 << 64) - 1 for k, _ in simhash._variants()], dtype=np.uint64)
    put = np.array([s & (1 << 64) - 1 for _, s in simhash._variants()], dtype=np.uint64)
    point = ((fp[:, None] & keep) ^ put).ravel()
    owner = np.repeat(fp, len(keep))
    order = np.argsort(point, kind="stable")
    u, v = simhash.links_of(point[order], owner[order])
    root = {int(p): int(p) for p in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        assert bin(a ^ b).count("1") <= 3
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {p: find(p) for p in root}


@pytest.mark.parametrize("seed,spread,n", [(0, 64, 150), (1, 12, 300), (2, 20, 400), (3, 64, 2)])
def test_links_connect_the_same_fingerprints_as_all_pairs(seed, spread, n):
    rng = np.random.default_rng(seed)
    base = [int(x) for x in rng.integers(0, 1 << 63, 5)]
    bits = rng.permutation(64)[:spread]
    prints = set()
    for _ in range(n):
        x = base[rng.integers(5)]
        for b in rng.choice(bits, rng.integers(0, 7)):
            x ^= 1 << int(b)
        prints.add(x)
    assert linked(prints) == plain_components(sorted(prints))


def test_dense_ball_makes_long_runs_and_stays_exact():
    prints = {1 << i | 1 << j for i in range(24) for j in range(24)} | {0}
    assert linked(prints) == plain_components(sorted(prints))


def test_near_groups_equal_brute_force(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "A"), (4, "a"), (5, "a b"), (6, "a B c"), (7, "x " * 5000)]
    rng = np.random.default_rng(5)
    base = list(rng.choice(words, 200))
    for i in range(40):
        w = list(base)
        for k in rng.integers(0, 200, i % 4):
            w[k] = "changed"
        rows.append((10 + i, " ".join(w)))
    rows += [(60, " ".join(base)), (60, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1)).withColumn("point", F.lit(2))
    got = {(r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id) for r in simhash.near_groups(docs).collect()}
    prints = {i: plain_fingerprint(t) for i, t in rows}
    root = plain_components(sorted(set(prints.values())))
    want = set()
    for i, p in prints.items():
        want.add((i, p, min(j for j, q in prints.items() if root[q] == root[p])))
    assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(docs).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = dict(components(spark.createDataFrame(pairs, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
