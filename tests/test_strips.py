"""Strips: rows packed before a shuffle, and the language operators built on them."""

import random

import pyarrow as pa
import pytest

from sessionloom import session
from sessionloom.functions.strips import over_strips, pack, strips, unpack
from sessionloom.operators import lang, quality
from sessionloom.plans import lang as plans

CH = "session_id long, idx long, ch string, ts_ms long"


def test_pack_returns_the_columns():
    columns = [
        pa.array([5, None, -(2**62), 2**62, 0]),
        pa.array(["a", "", None, "wörld", "\U0001f600"])[1:].slice(0, 4),
        pa.array([1.5, None, float("inf"), -0.0]),
        pa.array([["k", None], None, [], ["é"]], pa.list_(pa.string())),
        pa.array([], pa.string()),
    ]
    assert [c.to_pylist() for c in unpack(pack(columns))] == [c.to_pylist() for c in columns]


def test_neighbours_become_one_row(spark):
    df = spark.range(0, 40_000, 1, 4).selectExpr("id div 20000 AS session_id", "id AS idx", "'a' AS ch", "id * 50 AS ts_ms")
    assert strips(df, ["session_id"], ["idx", "ch", "ts_ms"]).count() <= 8


def test_pieces_of_unordered_repeated_and_null_rows(spark):
    rows = [(s, i, c, i * 50) for s in (1, 2) for i, c in enumerate("Hello wörld " * 40)]
    rows += [(2, 3, "Z", 150), (2, 4, None, 200), (None, 0, "x", 0), (1, 9, "n", None)]
    random.Random(3).shuffle(rows)
    got = {(r["session_id"], r["piece"]): (r["text"], r["times"], r["n_chars"]) for r in lang.text_pieces(spark.createDataFrame(rows, CH).repartition(3), 1000).collect()}
    want: dict = {}
    null_first = lambda v: (v is not None, v)
    for s, i, c, t in sorted(rows, key=lambda r: (null_first(r[3]), null_first(r[1]), (r[2] is not None, r[2] or ""))):
        want.setdefault((s, None if t is None else t // 1000), []).append((c, t))
    assert got == {k: ("".join(c for c, _ in v if c is not None), [t for _, t in v], len(v)) for k, v in want.items()}


@pytest.mark.parametrize("cell", [4, 7, 1000])
def test_tokens_meet_their_characters_in_any_cell(spark, cell):
    rng = random.Random(cell)
    chars = [(s, i, "x", 100 * i + s, [f"k{i}", None], f"t{i}" if i % 3 == 0 else None) for s in (1, 2) for i in range(60) if i % 11]
    tokens = [(s, n, f"w{n}", a, a + rng.choice([0, 1, 3, 12])) for s in (1, 2, 3) for n, a in enumerate(rng.sample(range(70), 20))]
    c = spark.createDataFrame(rng.sample(chars, len(chars)), "session_id long, idx long, ch string, ts_ms long, keystrokes array<string>, trigger_keystroke string")
    t = spark.createDataFrame([*tokens, (None, 0, "w", 0, 5), (1, 99, "w", None, 5)], "session_id long, token_idx long, token string, start long, end long")
    inside = {(s, n): [r for r in chars if r[0] == s and a <= r[1] < b] for s, n, _, a, b in tokens} | {(None, 0): [], (1, 99): []}
    got = {(r["session_id"], r["token_idx"]): (r["start_ms"], r["end_ms"]) for r in lang.align_chars(t, c, cell).collect()}
    assert got == {k: (v[0][3], v[-1][3]) if v else (0, 0) for k, v in inside.items()}
    keys = {(r["session_id"], r["token_idx"]): (r["char_indices"], r["keystroke_events"], r["trigger_keystrokes"]) for r in lang.align_keys(t, c, cell).collect()}
    text = lambda v: "[" + ",".join(f'"{x}"' for x in v) + "]"
    assert keys == {
        k: ([r[1] for r in v], text([r[4][0] for r in v]), text([r[5] for r in v if r[5]])) for k, v in inside.items()
    }


def test_unchanged_tokens_are_not_shuffled(spark):
    df = spark.range(0, 5000, 1, 2).selectExpr("1L AS session_id", "id AS token_idx", "concat('w', id) AS token", "if(id % 500 IN (3, 4), 'new', concat('w', id)) AS corrected", "id * 10 AS start_ms", "id * 10 + 5 AS end_ms")
    out = lang.align_corrected(df)
    got = {r["token_idx"]: (r["start_ms"], r["end_ms"], r["first_original"], r["last_original"], r["unchanged"]) for r in out.collect()}
    assert len(got) == 5000 and got[5] == (50, 55, 5, 5, True)
    assert got[503] == got[504] == (5030, 5045, 503, 504, False)
    kept = out.where("unchanged")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in kept and "Join" not in kept


def test_view_of_tokens_in_order(spark):
    rows = [(1, 0, "a", "a", True), (1, 2, "c", "C", False), (1, 1, None, "b", None), (2, 5, "z", "z", True)]
    df = spark.createDataFrame(rows, "session_id long, token_idx long, token string, corrected string, unchanged boolean").repartition(3)
    got = {(r["session_id"], r["piece"]): (r["original"], r["corrected"], r["score"]) for r in lang.correction_view(df, 3).collect()}
    assert got == {(1, 0): ("a c", "a b C", 0.5), (2, 1): ("z", "z", 1.0)}


def test_view_of_pieces_without_a_token(spark):
    rows = [(1, 0, None, "b", True), (1, 1, None, None, False), (2, 1, "y", "y", True), (2, 0, "x", None, True), (2, 0, "w", None, True)]
    df = spark.createDataFrame(rows, "session_id long, token_idx long, token string, corrected string, unchanged boolean").repartition(1)
    got = {r["session_id"]: (r["original"], r["corrected"], r["score"]) for r in lang.correction_view(df, 3).collect()}
    assert got == {1: ("", "b", 0.5), 2: ("w x y", "y", 1.0)}


def test_rows_are_put_in_order_by_the_first_column_where_it_decides():
    columns = [pa.array([3, 1, 2]), pa.array([None, 5, 4])]
    assert [c.to_pylist() for c in lang._in_order(columns, 2)] == [[1, 2, 3], [5, 4, None]]
    columns = [pa.array([3, 1, 1]), pa.array([None, 5, 4])]
    assert [c.to_pylist() for c in lang._in_order(columns, 2)] == [[1, 1, 3], [4, 5, None]]


def test_channels_side_by_side_from_arrow():
    table = pa.table({"session_id": [7] * 6, "channel": [2, 1, 1, 2, 3, 1], "sample": [0, 0, 0, 1, 1, 2], "y": [4.0, 1.0, 3.0, None, float("nan"), 5.0]})
    channels, x = quality._by_channel(table, "y")
    assert channels.tolist() == [1, 2] and str(x.tolist()) == "[[2.0, 4.0], [5.0, nan]]"
    assert quality._moments(table).to_pylist() == [
        {"session_id": 7, "a": 1, "b": 2, "n": 1, "sa": 2.0, "sb": 4.0, "saa": 4.0, "sbb": 16.0, "sab": 8.0}
    ]
    assert quality._moments(table.filter(pa.array([True] + [False] * 5))).num_rows == 0
    none = table.filter(pa.array([False] * 3 + [True] + [False] * 2))
    assert quality._moments(none).num_rows == 0


def test_token_columns_equal_the_regular_expression():
    rng = random.Random(5)
    signs = "ab'_ \t\n\r.,\u00e9\u0663\u0301\u6f22\U0001f600\u00a0\x0b-\x1c\u00bd\u200d"
    for text in ["", " ", *("".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(500))]:
        token, lo, hi = lang.token_spans(text)
        assert list(zip(token.to_pylist(), lo.tolist(), hi.tolist(), strict=True)) == lang.regex_spans(text)


def test_a_tokenizer_may_give_rows_or_columns(spark):
    df = spark.createDataFrame([(s, i, c, i * 50) for s in (1, 2) for i, c in enumerate("It's one w\u00f6rld, or two " * 9)], CH)
    got = [sorted(tuple(r) for r in lang.tokenize(df, 700, *t).collect()) for t in ((), (lang.regex_spans,))]
    assert got[0] == got[1] and len(got[0]) == 2 * 9 * 6


def test_bytes_of_small_rows_are_not_counted(spark):
    of = lambda: spark.conf.get(session.BATCH_BYTES, None)
    session.tune(spark)
    usual = of()
    session.tune(spark, small_rows=True)
    assert of() == session.NO_LIMIT != usual
    session.tune(spark)  # texts and large strips keep their limit
    assert of() == usual


def test_keys_without_the_needed_strip_are_not_unpacked(spark):
    rows = spark.createDataFrame([(1, 0, 5), (1, 1, 6), (2, 0, 7)], "k long, tag byte, v long")
    parts = strips(rows, ["k"], ["v"], tag="tag").selectExpr("k", "tag", "if(k = 2, CAST('broken' AS BINARY), body) AS body")
    whole = lambda key, sides: {"v": sides[1][0], "w": sides[0][0]}
    got = over_strips(parts, ["k"], whole, spark.createDataFrame([], "k long, v long, w long").schema, need=1)
    assert [tuple(r) for r in got.collect()] == [(1, 6, 5)]


def test_tokens_are_counted_once_for_the_vocabulary(spark):
    out = lang.vocabulary(spark.createDataFrame([("b",), ("a",), ("b",)], "token string"))
    assert "LogicalRDD" not in out._jdf.queryExecution().optimizedPlan().toString() and sorted((r["token"], r["n"]) for r in out.collect()) == [("a", 1), ("b", 2)]


def test_known_words_and_corrections_come_from_counted_tokens(spark):
    rows = [("Their",)] * 5 + [("their",)] * 4 + [("thier",), ("Theis",), ("theirs",), ("...",), (None,)]
    t = spark.createDataFrame([(1, k, w) for k, (w,) in enumerate(rows)], "session_id long, token_idx long, token string")
    each = plans.counted(t)
    assert {r["token"]: r["n"] for r in each.collect()} == {"Their": 5, "their": 4, "thier": 1, "Theis": 1, "theirs": 1, "...": 1, None: 1}
    assert [tuple(r) for r in plans.known(each).collect()] == [tuple(r) for r in plans.known(t).collect()] == [("their", 9)]
    got = sorted((r["token"], r["corrected"]) for r in plans.corrected(t).where("token <> corrected").collect())
    assert got == sorted((r["token"], r["corrected"]) for r in lang.correct(t, plans.known(t)).where("token <> corrected").collect())
    assert got == [("Theis", "Their"), ("theirs", "their")]
