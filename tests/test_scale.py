"""Memory and disk of single tasks and tables: what must not grow with the plan or the input."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sessionloom.functions.ordered import dealt
from sessionloom.functions.strips import pack, unpack
from sessionloom.operators import align, lang
from sessionloom.plans.catalogue import QUERIES

DAY = 86_400_000


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_of_two_streams_are_few_steps_at_a_time(spark):
    rows = [(s, kind, k, 1_700_000_000_000 + k * DAY, 1.0) for s in (1, 2) for kind in ("eeg", "fnirs") for k in range(12)]
    frames = spark.createDataFrame(rows, "session_id long, stream string, frame long, ts_ms long, value double")
    t = align.Timing(period=DAY, eeg_per_window=2, chunk=5, density=0.6, slice_ms=10 * DAY)
    slots = align.two_stream_windows(frames, t)
    assert len(re.findall(r"Join|Aggregate|Window ", plan_of(slots))) <= 6
    # 12 EEG frames make six windows, on the first six of 12 slots
    found = slots.groupBy("session_id").agg(F.count(F.lit(1)), F.count_if("eeg_valid"), F.count_if("fnirs_valid")).collect()
    assert sorted(tuple(r) for r in found) == [(1, 12, 6, 6), (2, 12, 6, 6)]


def test_groups_are_dealt_by_rows_not_by_the_setting(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("b"))
    few, many = dealt(df, ["a", "b"], 1000, 100), dealt(df, ["a", "b"], 1000, 1000)
    assert (few.rdd.getNumPartitions(), many.rdd.getNumPartitions()) == (10, 4)
    keyed = few.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    assert len(re.findall(r"Exchange hash", plan_of(keyed))) == 1
    assert sorted(map(tuple, keyed.collect()), key=str) == sorted(map(tuple, df.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).collect()), key=str)


@pytest.mark.parametrize("name", ["g8_prune_frames", "g8_prune_without_match"])
def test_pruned_cells_are_not_gathered_by_the_reading_task(spark, name):
    first = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001")).split("REPARTITION_BY_NUM")[1]
    assert "count(1)" not in first.split("max(")[0]


@pytest.mark.parametrize("clock", [[0, 50, 100, 150, 200, 250, 300], [5, 5, 9, 100, 101, 7, -3], [2**62, 1, 2, 3, 4, 5, 2**62]])
@pytest.mark.parametrize("found", [[], [("ab", 0, 2), ("é", 2, 3), ("cd", 5, 7)], [("x", 1, 4), ("yyyyy", 0, 2), ("", 6, 7)]])
def test_packed_tokens_come_back(clock, found):
    times = np.array(clock, dtype="int64")
    token, lo, hi, t0, t1 = [c.to_pylist() for c in lang._unflat(unpack(pack(lang._flat(found, times))))]
    assert list(zip(token, lo, hi, strict=True)) == found
    assert t0 == [clock[a] for a in lo] and t1 == [clock[b - 1] for b in hi]


def test_packed_tokens_of_even_text_are_little_more_than_the_text():
    text = " ".join(f"word{k * 7919 % 1000}" for k in range(600))
    found, times = lang.regex_spans(text), np.arange(len(text), dtype="int64") * 50 + 10**12
    alone = len(pack([pa.array([t[0] for t in found])]))
    assert len(pack(lang._flat(found, times))) < 1.3 * alone


def test_characters_meet_all_tokens_by_one_shuffle(spark):
    chars = spark.createDataFrame([(1, k, "abcdefghij"[k % 10], k * 10) for k in range(40)], "session_id long, idx long, ch string, ts_ms long")
    tokens = spark.createDataFrame([(1, 0, "ab", 0, 2), (1, 1, "c-n", 2, 25), (1, 2, "x", 39, 40), (1, 3, "gone", 40, 44), (1, 4, "", 3, 3)], "session_id long, token_idx long, token string, start long, end long")
    out = lang.align_chars(tokens, chars, cell=8)
    got = sorted((r.token_idx, r.start_ms, r.end_ms) for r in out.collect())
    assert got == [(0, 0, 10), (1, 20, 240), (2, 390, 390), (3, 0, 0), (4, 0, 0)]
    final = plan_of(out).split("Initial Plan")[0]  # of two uses of the characters the second reads the first one's shuffle
    assert final.count("REPARTITION_BY_COL") - final.count("ReusedExchange") == 1
