"""Scalable building blocks against plain windows and loops, with one hot key."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionloom.functions.joins import attach, first_containing, interval_nodes, points_in_intervals
from sessionloom.functions.ordered import first_k, over_frames, over_slices
from sessionloom.functions.quantiles import exact_positions, exact_quantiles


def hot_rows(spark, n=3000):
    """A third of the rows belongs to key 0; times repeat."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else int(rng.integers(1, 40))
        rows.append((key, int(rng.integers(0, 500)), i, float(rng.normal()), None if i % 5 else float(i)))
    return spark.createDataFrame(rows, "k long, t long, id long, x double, s double")


def rows_of(df, digits=9):
    norm = lambda v: round(v, digits) if isinstance(v, float) else v
    return sorted([tuple(norm(v) for v in r) for r in df.collect()], key=str)


def test_over_slices_equals_windows(spark):
    df = hot_rows(spark)
    w = Window.partitionBy("k").orderBy("t", "id")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(
        "*",
        F.row_number().over(w).cast("long").alias("r"),
        F.lag("x").over(w).alias("p"),
        F.lead("x").over(w).alias("n"),
        F.sum("x").over(up).alias("c"),
        F.min("x").over(up).alias("m"),
        F.last("s", True).over(up).alias("f"),
        F.first("s", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("b"),
    )
    for width in (1, 37, 10_000):
        got = over_slices(
            df, ["k"], ["t", "id"], width, rank="r", lags={"p": "x"}, leads={"n": "x"}, sums={"c": "x"}, mins={"m": "x"}, fills={"f": "s"}, backfills={"b": "s"}
        )
        assert rows_of(got.select(want.columns)) == rows_of(want)


def test_over_slices_without_key(spark):
    df = hot_rows(spark, 200)
    got = over_slices(df, [], ["t", "id"], 50, rank="r").select("id", "r")
    want = df.select("id", F.row_number().over(Window.orderBy("t", "id")).cast("long").alias("r"))
    assert rows_of(got) == rows_of(want)


def test_over_frames_equals_range_window(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), F.floor(F.col("id") / 2).alias("i"), F.sin(F.col("id")).alias("x"))
    w = Window.partitionBy("k").orderBy("i").rangeBetween(-7, 4)
    want = df.select("*", F.max("x").over(w).alias("m"))
    for block in (5, 13, 1000):
        got = over_frames(df, ["k"], "i", 7, 4, block, {"m": lambda win: F.max("x").over(win)})
        assert rows_of(got.select(want.columns)) == rows_of(want)


def test_first_k(spark):
    df = hot_rows(spark)
    got = first_k(df, ["k"], ["t", "id"], 3, "r").groupBy("k").count()
    assert max(r["count"] for r in got.collect()) == 3


def test_exact_quantiles_with_hot_key_and_copies(spark):
    rng = np.random.default_rng(2)
    data = {0: rng.normal(size=2000), 1: np.repeat([1.0, 2.0, 9.0], [300, 1, 5]), 2: np.array([4.5])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs] + [(0, float("nan")), (1, None)], "k long, x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for bits in (2, 8):
        got = exact_quantiles(df, ["k"], "x", probs, [f"q{i}" for i in range(6)], bits)
        for r in got.collect():
            want = np.quantile(data[r["k"]], probs)
            assert np.allclose([r[f"q{i}"] for i in range(6)], want)


def test_exact_quantiles_of_many_partial_sketches(spark):
    """Large enough that sketches compress and partial results arrive in any order."""
    df = spark.range(0, 200_000, numPartitions=16).select((F.col("id") % 3).alias("k"), (F.sin(F.col("id")) * 1000).alias("x"))
    df = df.repartition(16)
    probs = [0.05, 0.25, 0.5, 0.75]
    got = exact_quantiles(df, ["k"], "x", probs, ["a", "b", "c", "d"])
    want = {r["k"]: r["p"] for r in df.groupBy("k").agg(F.percentile("x", probs).alias("p")).collect()}
    for r in got.collect():
        assert np.allclose([r[c] for c in "abcd"], want[r["k"]], rtol=0, atol=1e-9)


def test_exact_quantiles_cut_cells_until_they_are_small(spark):
    """Every magnitude, both signs, infinities, heavy copies; cells of one value more than fits are cut again."""
    rng = np.random.default_rng(5)
    wide = np.concatenate([s * 10.0 ** rng.uniform(-320, 300, 300) for s in (1, -1)] + [[0.0, -0.0, 5e-324, -5e-324, np.inf, -np.inf]])
    data = {
        0: wide,
        1: 1 + rng.integers(0, 3000, 3000) * 2.0**-52,  # neighbours in the last bits
        2: np.concatenate([np.full(5000, 3.25), 3.25 + rng.random(200) * 1e-6]),
        3: -np.concatenate([rng.random(3000), np.full(400, 0.5)]),
    }
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "k long, x double").repartition(7)
    rank = [lambda n, p=p: F.floor((n - 1) * p) for p in (0.0, 0.1, 0.5, 0.77, 1.0)]
    for bits, most in ((5, 40), (12, 7)):
        got = {r["k"]: [r[f"q{i}"] for i in range(5)] for r in exact_positions(df, ["k"], "x", rank, [f"q{i}" for i in range(5)], bits, most).collect()}
        for k, vs in data.items():
            s = np.sort(vs)
            assert got.pop(k) == [s[int(np.floor((len(s) - 1) * p))] for p in (0.0, 0.1, 0.5, 0.77, 1.0)]
        assert not got


def test_exact_quantiles_without_rows_or_keys(spark):
    none = spark.createDataFrame([(1, None), (1, float("nan"))], "k long, x double")
    assert exact_quantiles(none, ["k"], "x", [0.5], ["m"]).collect() == []
    whole = spark.range(11).select(F.col("id").cast("double").alias("x"))
    assert exact_quantiles(whole, [], "x", [0.25, 0.5], ["a", "b"]).first().asDict() == {"a": 2.5, "b": 5.0}


def test_exact_positions(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), (F.col("id") % 50).cast("double").alias("x"))
    got = exact_positions(df, ["k"], "x", [lambda n: F.floor(n * 0.05), lambda n: n - 1 - F.floor(n * 0.05)], ["a", "b"]).first()
    s = sorted(i % 50 for i in range(100))
    assert (got["a"], got["b"]) == (s[5], s[94])


def test_attach_keeps_every_row(spark):
    df = hot_rows(spark)
    per = df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 7")
    got = attach(df, per, ["k"], "left")
    assert got.count() == df.count()
    assert got.where("k = 0 AND n <> 1000").count() == 0
    assert got.where("k = 7 AND n IS NOT NULL").count() == 0


def intervals(spark, n=60):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        a = int(rng.integers(0, 900))
        rows.append((int(i % 3 == 0), i * 7 % n, f"e{i}", a, a + int(rng.integers(-5, 400))))
    return rows, spark.createDataFrame(rows, "k long, ord long, name string, a long, b long")


def test_first_containing_equals_loop(spark):
    rows, iv = intervals(spark)
    pts = [(k, t) for k in (0, 1, 2) for t in range(0, 1000, 3)]
    got = first_containing(spark.createDataFrame(pts, "k long, t long"), iv, ["k"], "t", "a", "b", ["ord"], ["name"], 50, ["t"])
    res = {(r["k"], r["t"]): (r["hit"]["name"] if r["hit"] else None) for r in got.collect()}
    for k, t in pts:
        inside = sorted((o, n) for kk, o, n, a, b in rows if kk == k and a <= t <= b)
        assert res[(k, t)] == (inside[0][1] if inside else None)


def test_points_in_intervals_equals_loop(spark):
    rows, iv = intervals(spark)
    pts = [(k, t) for k in (0, 1) for t in range(0, 1000, 5)]
    p = spark.createDataFrame(pts, "k long, t long")
    for open_end in (False, True):
        got = points_in_intervals(p, iv, ["k"], "t", "a", "b", 64, open_end=open_end)
        want = sorted((k, t, n) for k, t in pts for kk, o, n, a, b in rows if kk == k and a <= t and (t < b if open_end else t <= b))
        assert sorted((r["k"], r["t"], r["name"]) for r in got.collect()) == want
    semi = points_in_intervals(p, iv, ["k"], "t", "a", "b", 64, "left_semi")
    assert semi.count() == len({(k, t) for k, t in pts for kk, o, n, a, b in rows if kk == k and a <= t <= b})


def test_intervals_of_many_levels_equal_loop(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(90):
        a = int(rng.integers(-3000, 3000)) * int(rng.choice([1, 16]))
        rows.append((i % 2, i * 7 % 90, f"e{i}", a, a + int(rng.choice([-1, 0, 3, 40, 255, 4096, 70000]))))
    rows.append((0, 200, "open", -5, 4 * 10**15))  # a missing stop set far in the future
    iv = spark.createDataFrame(rows, "k long, ord long, name string, a long, b long")
    pts = [(k, int(t)) for k in (0, 1, 2) for t in np.unique(rng.integers(-50000, 50000, 400))] + [(0, 10**15), (0, 5 * 10**15)]
    p = spark.createDataFrame(pts, "k long, t long")
    inside = {(k, t): sorted((o, n) for kk, o, n, a, b in rows if kk == k and a <= t <= b) for k, t in pts}
    for width in (1, 3, 1000):
        pairs = points_in_intervals(p, iv, ["k"], "t", "a", "b", width).collect()
        assert sorted((r["k"], r["t"], r["ord"]) for r in pairs) == sorted((k, t, o) for (k, t), h in inside.items() for o, _ in h)
        semi = points_in_intervals(p, iv, ["k"], "t", "a", "b", width, "left_semi").collect()
        assert sorted((r["k"], r["t"]) for r in semi) == sorted(kt for kt, h in inside.items() if h)
        got = first_containing(p, iv, ["k"], "t", "a", "b", ["ord"], ["name"], width, ["t"]).collect()
        assert {(r["k"], r["t"]): r["hit"] and r["hit"]["name"] for r in got} == {kt: h[0][1] if h else None for kt, h in inside.items()}


def test_a_long_interval_is_a_few_rows(spark):
    iv = spark.createDataFrame([(1, 0.0, 4e15), (1, float("-inf"), float("inf")), (1, 5.0, 5.0)], "k long, a double, b double")
    assert interval_nodes(iv, "a", "b", 1000).count() < 1000
    p = spark.createDataFrame([(1, 5.0), (1, -1e300), (1, None)], "k long, t double")
    assert points_in_intervals(p, iv, ["k"], "t", "a", "b", 1000).count() == 4


def test_cut_lies_in_the_shared_folder_and_is_released(spark):
    import glob

    from sessionloom.functions.lineage import cut, release, shared_dir

    df = cut(hot_rows(spark, 50))
    folder = shared_dir(spark).removeprefix("file:")
    assert df.count() == 50
    assert glob.glob(f"{folder}/cut-*")
    release(spark)
    assert not glob.glob(f"{folder}/*")
