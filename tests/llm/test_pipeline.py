"""Near copies and the pipeline against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sessionloom.llm import nearcopies

SF_DIR = "/root/testdata/sf0.001"


def grams(text, n=5):
    w = [x.lower() for x in (text or "").split()]
    return {" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def similar(a, b):
    return (not a and not b) or len(a & b) >= 0.8 * len(a | b) > 0


def plain_groups(rows):
    sets = {i: grams(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if similar(sets[i], sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids if any(find(j) == find(i) for j in ids if j != i)}


def test_crowd_around_one_original(spark, monkeypatch):
    """Copies like the original, but not like each other: leaders alone would lose links."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = [(1000, " ".join(base))]
    for i in range(60):
        w = list(base)
        for k in rng.sample(range(300), 5):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    rows += [(2000 + i, " ".join(rng.choices(base, k=80))) for i in range(20)] + [(3000, None), (3001, ""), (None, "w1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit(1))
    got = dict(nearcopies.near_copies(docs).collect())
    want = plain_groups([r for r in rows if r[0] is not None])
    assert got == want
    out = nearcopies.drop_near(docs)
    assert out.columns == docs.columns
    assert out.count() == len(rows) - sum(i != r for i, r in want.items())
    assert nearcopies.near_copies(docs.limit(0)).count() == 0


def test_finds_nearly_all_near_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_groups(rows)
    got = dict(nearcopies.near_copies(docs).collect())
    assert len(want) > 50
    assert sum(got.get(i) == r for i, r in want.items()) >= 0.95 * len(want)
    assert all(i in want for i in got)


def test_crowd_of_several_groups_does_not_cost_all_pairs(spark, monkeypatch):
    """Three groups that share a long passage meet on the same points, but are no copies of each other."""
    rng = random.Random(4)
    rows = []
    for g in range(3):
        base = [f"w{i}" for i in range(300)] + [f"g{g}_{i}" for i in range(45)]
        for _ in range(60):
            w = list(base)
            w[rng.randrange(300)] = f"x{len(rows)}"
            rows.append((len(rows), " ".join(w)))
    tried = []
    verified = nearcopies._verified

    def counted(pairs, *rest):
        tried.append(pairs.where("u <> v").distinct().where(F.floor(F.col("u") / 60) != F.floor(F.col("v") / 60)).count())
        return verified(pairs, *rest)

    monkeypatch.setattr(nearcopies, "_verified", counted)
    got = dict(nearcopies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == {i: i // 60 * 60 for i, _ in rows}
    assert sum(tried) < 10_800 * 0.7  # of all pairs of different groups


def test_crowd_around_a_passage_is_some_rows_a_document(spark, monkeypatch):
    """Documents that share a passage meet on very many points; what goes on is their leaders, not the points."""
    rng = random.Random(6)
    rows = []
    for i in range(300):
        w = [f"w{k}" for k in range(300)] + [f"t{i}_{k}" for k in range(50)]
        rows.append((i, " ".join(w)))
        if i % 10 == 0:
            w[rng.randrange(300, 350)] = "x"
            rows.append((1000 + i, " ".join(w)))
    left = []
    opened = nearcopies._open

    def counted(*args):
        out = opened(*args)
        left.append(out.count())
        return out

    monkeypatch.setattr(nearcopies, "_open", counted)
    got = dict(nearcopies.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect())
    assert got == plain_groups(rows)
    assert len(got) == 60
    assert 0 < sum(left) < 25 * len(rows)


def test_crowd_of_copies_and_outliers_does_not_cost_all_pairs(spark, monkeypatch):
    """Copies of one text in one group, and others of it that differ too much from nearly all of them."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 401):
        w = list(base)
        for k in range(1 if i <= 300 else 4):
            w[rng.randrange(k * 37, k * 37 + 30)] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    tried = []
    verified = nearcopies._verified

    def counted(pairs, *rest):
        tried.append(pairs.where("u <> v").distinct().count())
        return verified(pairs, *rest)

    monkeypatch.setattr(nearcopies, "_verified", counted)
    got = dict(nearcopies.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(9)).collect())
    assert got == plain_groups(rows)
    assert len(got) > 300
    assert sum(tried) < 8 * len(rows)


def test_parities_lose_no_pair(spark):
    """A pair that has the similarity never differs in more parities than its sets allow."""
    rng = random.Random(9)
    for n in (1, 2, 5, 30, 200, 2000):
        for _ in range(40):
            both = [rng.randrange(1 << 31) for _ in range(n)]
            a, b = ({*both, *[rng.randrange(1 << 31) for _ in range(rng.randint(0, n // 8 + 1))]} for _ in range(2))
            if len(a & b) >= 0.8 * len(a | b):
                x, y = (nearcopies.parities(np.array(sorted(s))) for s in (a, b))
                assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= (len(a) + len(b)) * nearcopies.most_apart(0.8) + 1e-6


@pytest.mark.parametrize("kind", ["substituted", "appended", "truncated", "merged"])
def test_finds_copies_of_every_form_near_the_limit(spark, kind):
    """Pairs at 0.80-0.85, by the brute-force similarity."""
    rng = random.Random(kind)
    rows = []
    while len(rows) < 400:
        n = rng.randint(60, 900)
        w = [f"w{rng.randrange(5000)}" for _ in range(n)]
        k = rng.randint(n * 14 // 100, n * 22 // 100)
        extra = [f"v{rng.randrange(5000)}" for _ in range(k)]
        if kind == "substituted":
            v = list(w)
            for i in rng.sample(range(n), max(1, k // 9)):
                v[i] = f"x{rng.randrange(10**6)}"
        else:
            v = {"appended": w + extra, "truncated": w[: n - k], "merged": w[k // 2 :] + extra[: k // 3]}[kind]
        a, b = grams(" ".join(w)), grams(" ".join(v))
        if 0.8 <= len(a & b) / len(a | b) < 0.85:
            rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(v))]
    got = dict(nearcopies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert sum(got.get(i + 1) == i for i in range(0, len(rows), 2)) >= 0.99 * len(rows) / 2
    assert all(r in (i, i - 1) and r % 2 == 0 for i, r in got.items())


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = corpus_pipeline.cut(stage(spark, docs, SF_DIR))
    return [*out, docs]


def test_language_stage_rejects_junk_with_letters(spark):
    rng = random.Random(8)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    junk = ["".join(chr(rng.randrange(256)) for _ in range(300)) + "a" for _ in range(20)]
    junk += ["a" + "".join(rng.choice("#$%&()*+<=>?@[]^{|}~0123456789") for _ in range(200)) for _ in range(20)]
    junk += ["".join(chr(rng.randrange(0x410, 0x430)) for _ in range(200)) for _ in range(20)]
    more = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(junk)], docs.schema)
    kept = corpus_pipeline.known_language(spark, docs.unionByName(more), SF_DIR).select("doc_id").collect()
    kept = {r.doc_id for r in kept}
    assert sum(i < 0 for i in kept) <= 3
    assert {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")} <= kept


def test_stages_keep_the_columns_and_clean_documents(spark, stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in stages]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    first = {r.doc_id: r.text for r in stages[0].collect()}
    assert ids[0] - ids[1] == {i for i, t in first.items() if not any(c.isalpha() for c in t or "")}
    assert {"".join((first[i] or "").split()) for i in ids[1]} == {"".join((first[i] or "").split()) for i in ids[2]}
    groups = plain_groups([(i, first[i]) for i in ids[2]])
    assert ids[2] - ids[3] <= set(groups)
    assert ids[4] == ids[5]


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, SF_DIR).count() == stages[-1].count()


def test_stages_with_clashing_names_nulls_repeats_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "a"), (2, text + " end", "en", None), (3, None, None, "a"), (4, "", "en", "a"), (5, "x " * 50, None, None), (5, "x " * 50, None, None)]
    rows += [(None, text, "en", "a"), (6, " ".join(reversed(text.split())), "de", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("__id", "__cell", "__rate", "__row", "__key", "topic", "tokens", "keep_id", "copies"):
        docs = docs.withColumn(name, F.col("doc_id") * 2)
    docs = docs.withColumnRenamed("copies", "__ID_")
    exact_out = corpus_pipeline.drop_exact_copies(spark, docs, SF_DIR)
    near_out = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR)
    mixed_out = corpus_pipeline.mix_sources(spark, docs, SF_DIR)
    for out in (exact_out, near_out, mixed_out):
        assert out.columns == docs.columns
        assert all(r["__id"] == (None if r.doc_id is None else 2 * r.doc_id) for r in out.collect())
    assert sorted((r.doc_id for r in exact_out.collect()), key=str) == [1, 2, 3, 5, 6]  # null ids lose against numbers
    assert sorted((r.doc_id for r in near_out.collect()), key=str) == [1, 3, 5, 5, 6, None]
    kept = [r.doc_id for r in mixed_out.collect()]
    assert kept.count(5) in (0, 2)
    packed = corpus_pipeline.pack_sequences(spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == {1, 2, 3, 4, 5, 6, None}
    empty = docs.limit(0)
    for stage in (corpus_pipeline.drop_exact_copies, corpus_pipeline.drop_near_copies, corpus_pipeline.mix_sources, corpus_pipeline.pack_sequences):
        assert stage(spark, empty, SF_DIR).count() == 0


def test_sketches_keep_pairs_at_the_similarity():
    rng = random.Random(9)
    kept = 0
    for _ in range(200):
        base = [rng.getrandbits(64) for _ in range(900)]
        a, b = base[:500], base[56:556]  # 444 of 556 are common: 0.799
        x, y = (nearcopies.points_of(nearcopies.np.unique(nearcopies.np.array(s, nearcopies.np.uint64)))[1] for s in (a, b))
        kept += 64 - bin((x ^ y) & (1 << 64) - 1).count("1") >= nearcopies.equal_bits(0.8)
    assert kept >= 199
