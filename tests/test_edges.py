"""Hand-made cases, and whole chains against plain loops."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sessionloom.operators import align, audio, catalog, crossquery, curate, events, lang, optical, prep, quality, spectral


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


LOG = "session_id long, event_id long, kind string, client_ms long, payload string"


def log(spark, rows):
    return frame(spark, [(s, i, k, t, p) for i, (s, k, t, p) in enumerate(rows)], LOG)


def pair(spark, rows):
    e = log(spark, rows)
    got = events.pair_events(
        events.events_of(e, "a"), events.events_of(e, "b"), ["session_id"], "client_ms", "event_id", ["event_id", "client_ms"], 100, 10
    )
    return sorted((r["session_id"], r["start_client_ms"], r["end_client_ms"]) for r in got.collect())


def test_pairing_keeps_negative_durations_only_for_equal_counts(spark):
    # session 1: as many starts as ends, in crossed order; session 2: one end more; session 3: starts only
    rows = [(1, "a", 50, ""), (1, "b", 20, ""), (1, "a", 10, ""), (1, "b", 60, "")]
    rows += [(2, "b", 5, ""), (2, "a", 10, ""), (2, "b", 30, ""), (2, "a", 40, ""), (2, "b", 50, "")]
    rows += [(3, "a", 1, "")]
    assert pair(spark, rows) == [(1, 10, 60), (1, 50, 20)]
    assert pair(spark, rows[4:]) == []  # by time: 10-5 and 40-30 both end too early


def test_pair_by_key_last_row_wins(spark):
    e = frame(spark, [(1, "x", 0, 10), (1, "y", 1, 20), (1, "x", 2, 30)], "session_id long, k string, o long, t long")
    f = frame(spark, [(1, "x", 3, 40), (1, "x", 4, 50)], "session_id long, k string, o long, t long")
    got = events.pair_by_key(e, f, ["session_id", "k"], "o", ["t"]).collect()
    assert [(r["k"], r["ordinal"], r["start_t"], r["end_t"]) for r in got] == [("x", 0, 30, 50)]


def test_tasks_and_skips(spark):
    def payload(i):
        return json.dumps({"task_id": i, "task_type": "eye", "config": {"audio_mode": ""}})

    rows = [("t1", 100, 200), ("", 300, 400), ("t2", 500, 600)]
    pairs = frame(
        spark, [(1, n + 1, n, a, b, payload(i)) for n, (i, a, b) in enumerate(rows)],
        "session_id long, n long, start_event_id long, start_client_ms long, end_client_ms long, start_payload string",
    )
    tasks = events.tasks(pairs)
    assert sorted(r["task_id"] for r in tasks.collect()) == ["t1", "t2"]
    skips = frame(spark, [(1, 1, 50), (1, 2, 500), (1, 3, 900)], "session_id long, event_id long, client_ms long")
    got = {r["task_id"]: r for r in events.attribute_skips(tasks, skips, 1000).collect()}
    assert got["t1"]["completion_status"] == events.SKIPPED_BEFORE_START  # before all tasks: the next one
    assert got["t2"]["completion_status"] == events.SKIPPED_BEFORE_START and got["t2"]["skip_ms"] == 500  # exactly at its start
    inside = frame(spark, [(1, 1, 150), (1, 2, 120)], "session_id long, event_id long, client_ms long")
    got = {r["task_id"]: r for r in events.attribute_skips(tasks, inside, 1000).collect()}
    assert got["t1"]["completion_status"] == events.SKIPPED_PARTLY and got["t1"]["skip_event_id"] == "2"
    assert got["t2"]["skipped"] is False and got["t1"]["audio_mode"] == "text_only"


def test_nested_and_touching_elements(spark):
    el = frame(
        spark, [(1, "open_1", "eye", 0, 0, 100), (1, "close_1", "eye", 1, 20, 40), (1, "intro_1", "eye", 2, 100, 200)],
        "session_id long, element_id string, task_type string, ordinal long, start_ms long, end_ms long",
    )
    w = frame(spark, [(1, t, 0.0) for t in (0, 30, 100, 101, 200, 201)], "session_id long, time_ms long, value double")
    got = {r["time_ms"]: r["label"] for r in crossquery.labels(w, el, crossquery.EYE_LABELS, 50).collect()}
    assert got == {0: 1, 30: 1, 100: 1, 101: 2, 200: 2, 201: 3}
    assert crossquery.filter_elements(el, nothing=1).count() == 0
    with pytest.raises(ValueError):
        crossquery.middle(el, 0)


T = align.Timing(period=100, eeg_per_window=2, chunk=4, density=0.75, slice_ms=700, frame_slice=9)


def loop_fill(ts, period):
    out = [(ts[0], True)]
    for a, b in zip(ts, ts[1:]):
        n = round((b - a) / period)
        out += [(a + k * period, False) for k in range(1, n)] + [(b, True)]
    return out


def test_gap_fill_truncate_drift_equal_loop(spark):
    rng = np.random.default_rng(5)
    steps = rng.choice([95, 100, 105, 150, 250, 320, 800], size=300, p=[0.2, 0.4, 0.2, 0.05, 0.05, 0.05, 0.05])
    steps[-12:] = 900  # a bad tail
    ts = [int(x) for x in np.cumsum(steps)]
    df = frame(spark, [(1, "fnirs", i, t, 1.0) for i, t in enumerate(ts)], "session_id long, stream string, frame long, ts_ms long, value double")
    filled = align.gap_fill(df, T)
    want = loop_fill(ts, 100)
    got = [(r["ts_ms"], r["is_actual"]) for r in filled.orderBy("idx").collect()]
    assert got == [(float(t), a) for t, a in want]
    assert [r["idx"] for r in filled.orderBy("idx").collect()] == list(range(len(want)))

    flags = [a for _, a in want]
    end = next((i for i in range(len(flags) - 1, 2, -1) if sum(flags[i - 3 : i + 1]) / 4 >= 0.75), len(flags) - 1)
    cut = align.truncate(filled, T)
    assert cut.count() == end + 1 < len(want)

    kept = want[: end + 1]
    actual = [t for t, a in kept if a][:4]
    early = np.mean([t - actual[0] - i * 100 for i, t in enumerate(actual)])
    late = np.mean([t - kept[-4][0] - i * 100 for i, (t, _) in enumerate(kept[-4:])])
    r = align.drift(cut, T).first()
    assert math.isclose(r["early_ms"], early, abs_tol=1e-6) and math.isclose(r["late_ms"], late, abs_tol=1e-6)


def test_half_period_rounds_to_even(spark):
    df = frame(spark, [(1, "f", 0, 0, 1.0), (1, "f", 1, 150, 1.0), (1, "f", 2, 400, 1.0)], "session_id long, stream string, frame long, ts_ms long, value double")
    assert align.gap_fill(df, T).count() == 5  # 1.5 and 2.5 periods: one placeholder each
    later = align.gap_fill(df.withColumn("ts_ms", df.ts_ms + 1000), T)
    both = [[(r.idx, r.ts_ms - base, r.is_actual) for r in f.orderBy("idx").collect()] for f, base in ((align.gap_fill(df, T), 0), (later, 1000))]
    assert both[0] == both[1]  # times may begin at 0
    assert align.gap_fill(df, T, zero_unknown=True).count() == 4


def loop_repair(ts, period):
    ts = [float(t) for t in ts]
    orig = list(ts)
    for i, t in enumerate(orig):
        if t != 0:
            continue
        if i > 0 and ts[i - 1] != 0:
            nxt = next((x for x in orig[i + 1 :] if x != 0), None)
            if nxt is None or ts[i - 1] + period < nxt:
                ts[i] = ts[i - 1] + period
            elif ts[i - 1] < nxt:
                ts[i] = (ts[i - 1] + nxt) / 2
        elif i == 0 and len(ts) > 1 and orig[1] != 0 and orig[1] - period > 0:
            ts[0] = orig[1] - period
    return ts


@pytest.mark.parametrize(
    "ts",
    [
        [0, 1000, 1100],
        [0, 50, 100],
        [0, 0, 1000, 1100],
        [1000, 0, 1100, 1200],
        [1000, 0, 0, 0, 0, 1250, 0, 0, 1900, 0, 0],
        [1000, 0, 0, 1000, 1300],
        [1000, 0, 900, 0, 1400, 0, 0, 0, 1700],
    ],
)
def test_zero_time_repair_equals_loop(spark, ts):
    df = frame(spark, [(1, "fnirs", i, t) for i, t in enumerate(ts)], "session_id long, stream string, frame long, ts_ms long")
    got = [r["ts_ms"] for r in align.repair_zero_times(df, T).orderBy("frame").collect()]
    assert np.allclose(got, loop_repair(ts, 100))


def test_few_frames_are_kept(spark):
    df = frame(spark, [(1, "fnirs", i, i * 100, 1.0) for i in range(3)], "session_id long, stream string, frame long, ts_ms long, value double")
    assert align.truncate(align.gap_fill(df, T), T).count() == 3


def test_routes(spark):
    s = frame(spark, [(i,) for i in range(4)], "session_id long")
    f = frame(spark, [(0, "eeg"), (0, "fnirs"), (1, "eeg"), (2, "fnirs")], "session_id long, stream string")
    got = [r["route"] for r in align.route(s, f).orderBy("session_id").collect()]
    assert got == ["both", "eeg_only", "fnirs_only", "skipped_no_data_for_windowing"]


INF, NAN = float("inf"), float("nan")


def test_special_values(spark):
    cells = frame(
        spark, [(1, 0, 5, -INF), (1, 1, 5, -INF), (1, 0, 6, INF), (1, 1, 6, 2.0), (1, 0, 7, NAN), (1, 1, 7, 0.0), (1, 2, 7, -3.0)],
        "file_id long, frame long, channel long, value double",
    )
    r = optical.value_audit(cells).first()
    assert (r["n_nan"], r["n_inf"], r["n_zero"], r["n_negative"]) == (1, 3, 1, 1)
    assert (r["channels_with_inf"], r["channels_all_inf"]) == (2, 1)
    assert optical.ever_valid(cells).first()["ever_valid_channels"] == 2
    s = optical.value_stats(cells, []).first()
    assert (s["min"], s["max"], s["median"]) == (-3.0, 2.0, 0.0)
    none = frame(spark, [(99,)], "channel long")
    assert optical.prune(cells, none).count() == 7
    logged = align.log_windows(frame(spark, [([0.0, -1.0, 1.0],)], "samples array<double>")).first()["samples"]
    assert math.isnan(logged[0]) and math.isnan(logged[1]) and logged[2] == 0.0


def test_channel_code_round_trip(spark):
    r = optical.decode(frame(spark, [(0,), (228022,), (248831,), (248832,), (-1,)], "channel long")).collect()
    assert (r[1]["wave"], r[1]["moment"], r[1]["src_mod"], r[1]["src_id"], r[1]["det_mod"], r[1]["det_id"]) == (1, 2, 24, 3, 36, 5)
    assert r[3]["wave"] is None and r[4]["det_id"] is None
    assert optical.channels(spark).where("channel = 0").first()["name"] == "W0(Red)_M0(Zeroth)_S1_1_D1_1"


def test_nearest_within_equals_loop(spark):
    rng = np.random.default_rng(7)
    a, b = rng.uniform(0, 3, (60, 3)), rng.uniform(0, 3, (80, 3))
    b[40:] = b[3]  # many copies of one place
    da = frame(spark, [(i, *map(float, p)) for i, p in enumerate(a)], "sensor long, x double, y double, z double")
    db = frame(spark, [(i, *map(float, p)) for i, p in enumerate(b)], "id long, x double, y double, z double")
    got = {r["sensor"]: (r["nearest_id"], round(r["distance"], 9)) for r in optical.nearest_within(da, db, 0.4).collect()}
    want = {}
    for i, p in enumerate(a):
        d = np.sqrt(((b - p) ** 2).sum(axis=1))
        if d.min() < 0.4:
            want[i] = (int(d.argmin()), round(float(d.min()), 9))
    assert got == want


def test_axis_search_takes_any_layout(spark):
    s = frame(spark, [(1, 0.0, 0.0, 1.0)], "sensor long, x double, y double, z double")
    flipped = frame(spark, [(0.0, 0.0, -1.0)], "x double, y double, z double")
    assert optical.best_axes(s, flipped).first()["name"] == "Negate Z"
    large = spark.range(3000).selectExpr("double(id) x", "double(id) y", "double(id) z")
    costs = {r["name"]: r["cost"] for r in optical.axis_costs(s, large).collect()}
    assert len(costs) == len(optical.AXIS_CONVENTIONS) and min(costs.values()) == pytest.approx(math.sqrt(2 / 3), rel=0.5)


SIG = "session_id long, channel long, sample long, x double"


def test_constant_channel_and_silence(spark):
    s = frame(spark, [(1, 0, i, 5.0) for i in range(10)], SIG)
    assert {r["x"] for r in quality.zscore(s).collect()} == {0.0}
    assert quality.trimmed_std(s).first()["std"] == 0.0
    silent = frame(spark, [(1, "a", 0.0)] * 4, "session_id long, name string, x double")
    assert {r["x"] for r in audio.peak_normalise(silent, ["session_id", "name"]).collect()} == {0.0}
    w = audio.window_stats(s.select("session_id", "sample", F.lit(0.0).alias("x")), 5)
    assert audio.outlier_windows(w).count() == 0


def test_trimmed_std_with_ties(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=400), 1)
    s = frame(spark, [(1, 0, i, float(v)) for i, v in enumerate(x)], SIG)
    assert math.isclose(quality.trimmed_std(s).first()["std"], np.std(np.sort(x)[20:-20]), rel_tol=1e-9)


def test_bad_mask_equals_loop(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2, 400))
    x[0, 100] = 40
    x[1, 250:260] += 30
    want = np.zeros(400, dtype=bool)
    for ch in x:
        bad = np.abs(ch) > 7 * np.std(np.sort(ch)[20:-20])
        for i in range(0, 400 - 50, 25):
            if np.ptp(ch[i : i + 50]) > 25:
                bad[i : i + 50] = True
        want |= bad
    want = np.convolve(want, np.ones(50), mode="same") > 0
    s = frame(spark, [(1, c, i, float(v)) for c, ch in enumerate(x) for i, v in enumerate(ch)], SIG)
    got = [r["bad"] for r in quality.bad_mask(s, 7.0, 25.0, 50, 50, 70).orderBy("sample").collect()]
    assert got == want.tolist()


def test_normal_quantiles(spark):
    s = frame(spark, [(1, 0, i, float(v)) for i, v in enumerate([3, 1, 2, 5, 4])], SIG)
    got = [(r["x"], round(r["normal"], 4)) for r in quality.normal_quantiles(s, 1.5).orderBy("rank").collect()]
    assert [g[0] for g in got] == [1, 2, 3, 4, 5]
    assert got[2][1] == 0.0 and got[0][1] == -got[4][1] and round(got[4][1], 3) == 1.129


def sine(spark, freqs, fs, n):
    t = np.arange(n) / fs
    x = sum(np.sin(2 * np.pi * f * t) for f in freqs)
    return x, frame(spark, [(1, 0, i, float(v)) for i, v in enumerate(x)], SIG)


def test_bandpass_keeps_the_band_and_blocks_do_not_matter(spark):
    x, s = sine(spark, [1.0, 10.0, 28.0], 64.0, 4000)
    whole = np.array([r["x"] for r in spectral.bandpass(s, 5.0, 20.0, 64.0, block=5000).orderBy("sample").collect()])
    parts = np.array([r["x"] for r in spectral.bandpass(s, 5.0, 20.0, 64.0, block=700, halo=256).orderBy("sample").collect()])
    ten = np.sin(2 * np.pi * 10 * np.arange(4000) / 64.0)
    assert len(parts) == 4000
    assert np.abs(whole[300:-300] - ten[300:-300]).max() < 0.02
    assert np.abs(whole - parts).max() < 1e-4


def test_notch_removes_the_line(spark):
    x, s = sine(spark, [5.0, 20.0], 64.0, 4000)
    y = np.array([r["x"] for r in spectral.notch(s, 20.0, 64.0, 10.0, block=5000).orderBy("sample").collect()])
    five = np.sin(2 * np.pi * 5 * np.arange(4000) / 64.0)
    assert np.abs(y[800:-800] - five[800:-800]).max() < 0.05


def test_gain_of_the_filter(spark):
    x, s = sine(spark, [1.0, 10.0, 28.0], 64.0, 2000)
    after = spectral.bandpass(s, 5.0, 20.0, 64.0, block=5000)
    g = {r["zone"]: r["gain"] for r in spectral.filter_gain(spectral.psd(s, 64.0, 64), spectral.psd(after, 64.0, 64), 5.0, 20.0).collect()}
    assert g["inside"] > 0.9 and g["below"] < 0.05 and g["above"] < 0.05


def test_filter_bank_separates(spark):
    x, s = sine(spark, [6.0, 20.0], 64.0, 3000)
    bank = spectral.filter_bank(s, {"low": (4.0, 8.0), "high": (13.0, 30.0)}, 64.0, block=1500)
    std = {r["band"]: r["s"] for r in bank.where("sample BETWEEN 500 AND 2500").groupBy("band").agg(F.stddev_pop("x").alias("s")).collect()}
    assert abs(std["low"] - 0.7071) < 0.03 and abs(std["high"] - 0.7071) < 0.03


def test_labels(spark):
    df = frame(spark, [("7",), ("click",), ("zzz",), (None,)], "t string")
    assert [r[0] for r in df.select(prep.to_label(F.col("t"), {"click": 2})).collect()] == [7, 2, 0, 0]
    assert prep.inverse_weights(frame(spark, [(0,), (2,)], "label int"), 3).count() == 0


def test_splits(spark):
    rows = frame(spark, [(i, i % 9) for i in range(100)], "id long, session_id long")
    n = {r["split"]: r["count"] for r in prep.split_rows(rows, ["id"], 0.7, 0.15).groupBy("split").count().collect()}
    assert n == {"train": 70, "val": 15, "test": 15}
    s = prep.split_sessions(rows, 0.7, 0.3 - 1e-3)
    assert s.count() == 100
    assert s.select("session_id", "split").distinct().count() == 9
    one = prep.split_sessions(frame(spark, [(1,)], "session_id long"), 0.7, 0.15)
    assert one.first()["split"] == "train"
    with pytest.raises(Exception, match="empty"):
        prep.split_rows(rows.limit(3), ["id"], 0.1, 0.1).collect()


@pytest.mark.parametrize("train,val", [(0.7, 0.15), (0.5, 0.25), (0.34, 0.33), (0.1, 0.8)])
def test_split_by_size_equals_loop(spark, train, val):
    sizes = [(s, n) for s, n in enumerate([9, 3, 3, 8, 1, 2, 7, 7, 5, 4, 6, 2, 1, 1, 30, 12, 11, 2, 3, 4])]
    rows = frame(spark, [(s,) for s, n in sizes for _ in range(n)], "session_id long")
    got = {r["session_id"]: r["split"] for r in prep.split_by_size(rows, train, val, slice_rows=3).distinct().collect()}
    tr = va = 0
    for t, (s, _) in enumerate(sorted(sizes, key=lambda x: (-x[1], x[0])), 1):
        if tr < train * t:
            part, tr = "train", tr + 1
        elif va < val * t:
            part, va = "val", va + 1
        else:
            part = "test"
        assert got[s] == part


def test_resample_balances_and_repeats(spark):
    rows = spark.range(9000).selectExpr("id", "CASE WHEN id % 9 = 0 THEN 1 ELSE 0 END AS label")
    drawn = prep.resample(rows, prep.distribution(rows), ["id"])
    n = {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()}
    assert abs(n[0] - 4500) < 250 and abs(n[1] - 4500) < 300
    assert drawn.count() == 9000
    other = prep.resample(rows.repartition(7), prep.distribution(rows), ["id"])
    assert drawn.exceptAll(other).count() == 0 and other.exceptAll(drawn).count() == 0
    once = drawn.where("copy = 1").count()
    assert once == drawn.select("id").distinct().count()
    # 8,000 rows of the large class drawn 4,500 times: 8,000 (1 - exp(-4,500 / 8,000)) of them at least once
    assert abs(drawn.where("label = 0").select("id").distinct().count() - 3442) < 150
    assert prep.resample(rows, prep.distribution(rows), ["id"], n=123).count() == 123
    assert prep.resample(rows.limit(0), prep.distribution(rows), ["id"]).count() == 0
    none = rows.withColumn("label", F.when(F.col("id") % 2 == 0, F.col("label")))
    kept = prep.resample(none, prep.distribution(none.where("label IS NOT NULL")), ["id"])
    assert kept.count() == 4500 and kept.where("label IS NULL").count() == 0
    only = rows.sparkSession.createDataFrame([(0, 0.0), (1, 2.0)], "label int, weight double")
    assert prep.resample(rows, only, ["id"], n=50).where("label = 1").count() == 50
    even = rows.withColumn("label", F.col("id") % 2)
    assert prep.auto_balance(even, ["id"]).count() == 9000


CH = "session_id long, idx long, ch string, ts_ms long"


@pytest.mark.parametrize("width", [100, 150, 500, 100_000])
def test_tokens_cross_piece_borders(spark, width):
    text = "Hello, wörld! it's a-b  x\ny2 " + "l" * 45 + " . end"
    df = frame(spark, [(1, i, c, i * 50) for i, c in enumerate(text)], CH)
    got = lang.tokenize(df, width).orderBy("token_idx").collect()
    assert [(r["token"], r["start"], r["end"]) for r in got] == lang.regex_spans(text)
    assert [r["token_idx"] for r in got] == list(range(len(got)))
    assert [(r["start_ms"], r["end_ms"]) for r in got] == [(a * 50, (b - 1) * 50) for _, a, b in lang.regex_spans(text)]


def test_tokens_without_characters(spark):
    chars = frame(spark, [(1, 0, "a", 10), (1, 1, "b", 20)], CH)
    toks = frame(spark, [(1, 0, "ab", 0, 2), (1, 1, "", 2, 2), (1, 2, "zz", 9, 11)], "session_id long, token_idx long, token string, start long, end long")
    got = {r["token_idx"]: (r["start_ms"], r["end_ms"], r["special"]) for r in lang.align_chars(toks, chars).collect()}
    assert got == {0: (10, 20, False), 1: (0, 0, True), 2: (0, 0, False)}


def test_token_touching_two_words(spark):
    words = frame(spark, [(1, 0, "ab", 0, 5), (1, 1, "c", 10, 15), (1, 2, "d", 20, 25)], "session_id long, idx long, word string, start_ms long, end_ms long")
    placed = lang.word_offsets(words)
    assert [(r["text_start"], r["text_end"]) for r in placed.orderBy("idx").collect()] == [(0, 2), (3, 4), (5, 6)]
    tok = frame(spark, [(1, 0, "c", 3, 4), (1, 1, "b ", 1, 3)], "session_id long, token_idx long, token string, start long, end long")
    got = {r["token_idx"]: (r["start_ms"], r["end_ms"]) for r in lang.align_words(tok, placed).collect()}
    assert got == {0: (10, 15), 1: (0, 15)}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_corrections_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    words = sorted({"".join(rng.choice(list("abcé"), rng.integers(1, 6))) for _ in range(250)})
    known = {w: int(rng.integers(1, 6)) for w in words[::3]}
    tokens = words + ["Abca", "ABCA", "x", "éa", "12"]
    t = frame(spark, [(w,) for w in tokens], "token string")
    k = frame(spark, list(known.items()), "word string, n int")
    got = {r["token"]: r["corrected"] for r in lang.corrections(t, k).collect()}
    want = {}
    for tok in set(tokens):
        low = tok.lower()
        if len(tok) < 2 or tok.isupper() or not any(c.isalpha() for c in tok) or low in known:
            continue
        near = sorted((-n, w) for w, n in known.items() if edits(low, w) <= 1)
        if near:
            best = near[0][1]
            want[tok] = best[:1].upper() + best[1:] if tok[0].isupper() else best
    assert got == want


def test_aligned_runs(spark):
    rows = [("a", "a"), ("teh", "the"), ("ct", "cat"), ("b", "b"), ("dgo", "dog")]
    df = frame(
        spark, [(1, i, t, c, i * 10, i * 10 + 5) for i, (t, c) in enumerate(rows)],
        "session_id long, token_idx long, token string, corrected string, start_ms long, end_ms long",
    )
    got = lang.align_corrected(df, 2).orderBy("token_idx").collect()
    assert [(r["start_ms"], r["end_ms"], r["first_original"], r["last_original"], r["unchanged"]) for r in got] == [
        (0, 5, 0, 0, True), (10, 25, 1, 2, False), (10, 25, 1, 2, False), (30, 35, 3, 3, True), (40, 45, 4, 4, False),
    ]
    assert lang.score(lang.align_corrected(df)).first()["score"] == 2 / 5


def test_orphan_stop(spark):
    ev = "session_id long, event_id long, client_ms long"
    starts = frame(spark, [(1, 2, 1000), (1, 4, 5000), (2, 1, 0)], ev)
    stops = frame(spark, [(1, 1, 500), (1, 3, 2000), (1, 5, 5100), (2, 2, 900)], ev)
    got = sorted((r["session_id"], r["start_ms"], r["stop_ms"], r["name"]) for r in audio.recording_pairs(starts, stops, 10).collect())
    assert got == [(1, 1000, 2000, "segment_01_0000000001000_0000000002000"), (2, 0, 900, "segment_01_0000000000000_0000000000900")]


def test_sample_rate_default(spark):
    c = frame(spark, [(1, 0, 5), (2, 0, 0), (2, 1, 256)], "session_id long, chunk long, ts_ms long")
    assert {r["session_id"]: r["rate"] for r in audio.sample_rate(c).collect()} == {1: 16000, 2: 16000}


def test_catalog(spark):
    rows = [("s_20240101_000001", f"p/s_20240101_000001/s_{t}.h5", 2**20) for t in (1700000000000, 1700000060000)]
    rows += [("plain", "p/plain.h5", 3 * 2**20), ("x_20230101_000000", "p/x_20230101_000000/readme.txt", 5)]
    f = frame(spark, rows, "session_id string, path string, size_bytes long")
    got = {r["session_id"]: (r["duration_ms"], r["duration_source"], r["stamp"]) for r in catalog.catalog(f).collect()}
    assert got["s_20240101_000001"] == (60000.0, "timestamps", "20240101000001")
    assert got["plain"] == (30000.0, "estimated", catalog.NO_STAMP)
    assert sorted(r[0] for r in catalog.list_sessions(f, "p/").collect()) == ["plain", "s_20240101_000001", "x_20230101_000000"]
    names = frame(spark, [("a/b_20240101_000001_extra.zarr",), ("a/b_20240101_000001/",), ("odd.h5",)], "p string")
    assert [r[0] for r in names.select(catalog.session_of(F.col("p"))).collect()] == ["b_20240101_000001", "b_20240101_000001", "odd"]


def test_rates(spark):
    df = frame(spark, [(70 * 1024, 1000), (69 * 1024, 1000), (200 * 1024, 1000), (5, 0)], "b long, ms long")
    rate = curate.data_rate(F.col("b"), F.col("ms"))
    got = [r[0] for r in df.select(curate.rate_class(rate)).collect()]
    assert got == [curate.FNIRS_ONLY, curate.NEITHER, curate.BOTH, curate.NEITHER]


def test_mutual_information_of_equal_channels(spark):
    rng = np.random.default_rng(12)
    x = rng.uniform(size=500)
    s = frame(spark, [(1, c, i, float(v)) for c in (0, 1) for i, v in enumerate(x)], SIG)
    mi = quality.mutual_information(s, 4, 90).first()["mi"]
    p = np.bincount(np.minimum(((x - x.min()) / (np.ptp(x) / 4)).astype(int), 3)) / 500
    assert math.isclose(mi, float(-(p * np.log(p)).sum()), rel_tol=1e-9)
    assert math.isclose(quality.correlations(s, 90).first()["corr"], 1.0, rel_tol=1e-9)


def test_logistic_baseline_learns(spark):
    rng = np.random.default_rng(13)
    pdf = pd.DataFrame({"label": np.arange(200) % 2, "split": np.where(np.arange(200) < 150, "train", "test")})
    pdf["a"] = pdf["label"] * 3 + rng.normal(size=200)
    out = prep.lr_baseline(spark.createDataFrame(pdf), ["a"])
    assert prep.accuracy(out.where("split = 'test'"), "label", "p").first()["balanced_accuracy"] > 0.8


def test_files_do_not_speak_for_each_other(spark):
    """Channel 5 is dead in file 1 and alive in file 2; file 2 is longer."""
    rows = [(1, f, 5, -INF) for f in range(3)] + [(1, 0, 6, 1.0)] + [(2, f, 5, 2.0) for f in range(9)] + [(2, 8, 6, -INF)]
    cells = frame(spark, rows, "file_id long, frame long, channel long, value double")
    kept = frame(spark, [(5,), (6,), (7,), (8,)], "channel long")
    by_file = lambda df: {r["file_id"]: r.asDict() for r in df.collect()}
    v = by_file(optical.validity(cells, kept))
    assert [(v[i]["included_valid"], v[i]["included_invalid"], v[i]["valid_percent"]) for i in (1, 2)] == [(1, 3, 25.0), (1, 3, 25.0)]
    e = by_file(optical.ever_valid(cells))
    assert e[1]["always_inf_channels"] == e[2]["always_inf_channels"] == optical.N_CHANNELS - 1
    p = by_file(optical.pair_consistency(cells))
    assert p[1]["fully_valid"] == 0 and p[1]["partly_valid"] == 1 and p[1]["fully_invalid"] == optical.PAIRS - 1
    full = frame(spark, [(3, 0, m * optical.PAIRS, 1.0) for m in range(6)], "file_id long, frame long, channel long, value double")
    assert by_file(optical.pair_consistency(full))[3]["fully_valid"] == 1
    f = {(r["file_id"], r["frame"]) for r in optical.evenly_spaced(cells, 3).select("file_id", "frame").collect()}
    assert f == {(1, 0), (1, 1), (1, 2), (2, 0), (2, 4), (2, 8)}
    assert {r["file_id"]: r["channel"] for r in optical.valid_above(cells).collect()} == {1: 6, 2: 5}
    assert {(r["file_id"], r["frame"]) for r in optical.infinite_cells(cells, 2).collect()} == {(1, 0), (1, 1), (2, 8)}
    assert optical.random_frames(cells, 2, 1).count() == 4
    late = frame(spark, [(7,)], "channel long")
    assert optical.prune(cells, late).count() == len(rows)  # beyond both files: nothing is taken away
    assert optical.prune(cells, frame(spark, [(6,)], "channel long")).count() == 2


def test_element_text_with_crossed_order(spark):
    units = frame(spark, [("e", 0, 3000.0, "w0"), ("e", 1, 1000.0, "w1"), ("e", 2, 2000.0, "w2")], "element_id string, idx long, start_ms double, word string")
    got = sorted((r["piece"], r["text"]) for r in lang.element_text(units, width=500, units_per_piece=2).collect())
    assert got == [(0, "w1 w2"), (1, "w0")]


def test_a_gap_of_many_periods_spreads_and_zero_times_are_unknown(spark):
    t = align.Timing()
    rows = [("s", "fnirs", i, ts, 1.0) for i, ts in enumerate([0.0, 0.0, 1.7e12, 1.7e12 + 1e7 * t.period])]
    frames = frame(spark, rows, "session_id string, stream string, frame long, ts_ms double, value double")
    n = frames.selectExpr("session_id", "10000000L AS n")
    wide = align.expand(n, F.col("n"), "k")
    assert wide.agg(F.count_distinct("k")).first()[0] == 10_000_000
    parts = wide.groupBy(F.spark_partition_id()).count().count()
    assert parts > 1
    filled = align.gap_fill(frames.where("frame < 3"), t, zero_unknown=True)
    assert filled.count() == 3  # nothing is filled in between 0 and an epoch time
    assert align.clock(frames.where("frame < 3"), t).count() == 1


def test_normal_quantiles_of_ties(spark):
    from statistics import NormalDist

    x = [0.0] * 40 + [1.0, -1.0, 2.5]
    rows = [("s", 0, i, v) for i, v in enumerate(x)]
    got = sorted((r["rank"], r["x"], r["normal"]) for r in quality.normal_quantiles(frame(spark, rows, "session_id string, channel int, sample long, x double"), 0.7).collect())
    assert [g[:2] for g in got] == list(enumerate(sorted(x), 1))
    assert abs(got[9][2] - NormalDist().inv_cdf((10 - 0.3175) / 43.365)) < 1e-8
    assert abs(got[0][2] - NormalDist().inv_cdf(1 - 0.5 ** (1 / 43))) < 1e-8


def test_window_ranges_by_panes(spark):
    """Sizes that steps divide or not, steps beyond the size, gaps and an unfinished end, against plain windows."""
    rng = np.random.default_rng(8)
    data = {(s, c): {int(i): float(x) for i, x in enumerate(rng.normal(size=47 + 3 * c)) if i % 11 != 5} for s in "ab" for c in (0, 1)}
    df = frame(spark, [(s, c, i, x) for (s, c), xs in data.items() for i, x in xs.items()], "session_id string, channel int, sample long, x double")
    for size, step in ((10, 5), (7, 3), (12, 12), (4, 9), (9, 4), (48, 2)):
        want = {}
        for key, xs in data.items():
            for w in range((max(xs) + 1 - size) // step + 1 if max(xs) + 1 >= size else 0):
                inside = [xs[i] for i in range(w * step, w * step + size) if i in xs]
                want[(*key, w)] = max(inside) - min(inside)
        got = {(r["session_id"], r["channel"], r["window"]): r["range"] for r in quality.window_ranges(df, size, step).collect()}
        assert got == want


def test_lowest_segments_with_ties(spark, monkeypatch):
    monkeypatch.setattr(quality, "SEGMENTS", 3)
    rng = np.random.default_rng(9)
    data = {"a": rng.integers(0, 4, 41), "b": np.ones(10), "c": np.array([2.0]), "d": np.arange(9)[::-1]}
    df = frame(spark, [(s, w, float(x)) for s, xs in data.items() for w, x in enumerate(xs)], "session_id string, window long, range double")
    for ratio in (0.5, 0.9, 0.0):
        got = {}
        for r in quality.lowest_segments(df, ratio).collect():
            assert r["__n"] == len(data[r["session_id"]])
            got.setdefault(r["session_id"], []).append(r["window"])
        for s, xs in data.items():
            order = sorted(range(len(xs)), key=lambda w: (xs[w], w))
            assert sorted(got[s]) == sorted(order[: max(1, int(len(xs) * (1 - ratio) + 1e-9))])
