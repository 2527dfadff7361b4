"""Cross-table queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crossquery as op
from . import inputs as px
from .registry import query, rounded

CELL = px.DAY
PRE = 36_000

HITS = """hits AS (SELECT DISTINCT w.session_id, w.time_ms, w.value, w.n FROM px_windows w JOIN px_elements e ON w.session_id=e.session_id AND {cond}
  AND w.time_ms BETWEEN e.start_ms+{m}*(e.end_ms-e.start_ms) AND e.end_ms-{m}*(e.end_ms-e.start_ms))"""


def labelled_sql(task: str, seconds: float, margin: float, cases: str, other: int) -> str:
    cond = f"e.task_type='{task}' AND e.end_ms-e.start_ms>={seconds}*1000"
    return f"""WITH {HITS.format(cond=cond, m=f'{margin}::DOUBLE')}, lab AS (
  SELECT h.session_id, h.time_ms, h.value, h.n, arg_min(e.element_id, e.ordinal) AS element_id FROM hits h JOIN px_elements e
    ON h.session_id=e.session_id AND {cond} AND h.time_ms BETWEEN e.start_ms AND e.end_ms GROUP BY ALL),
 res AS (SELECT session_id, time_ms, value, n, element_id, CAST(CASE {cases} ELSE {other} END AS INT) AS label FROM lab)"""


EYE_CASES = "WHEN contains(element_id,'close') THEN 0 WHEN contains(element_id,'open') THEN 1 WHEN contains(element_id,'intro') THEN 2"
BREATH_CASES = "WHEN contains(element_id,'hold') THEN 0 WHEN contains(element_id,'normal') THEN 1 WHEN contains(element_id,'intro') THEN 2"
EYE_NEURAL = labelled_sql("eye", 0, 0, EYE_CASES, 3)
EYE_GOOD = labelled_sql("eye", 10, 0.25, EYE_CASES, 3)
BREATH_GOOD = labelled_sql("breath", 10, 0.25, BREATH_CASES, 3)
COLS = "SELECT session_id, time_ms, round(value,6) AS value, n, element_id, label FROM res"


def eye_good(spark, d):
    return op.eye_good(px.elements(spark, d), px.windows(spark, d), CELL)


def pairs(spark, d):
    return op.neuro_lang(px.timed_tokens(spark, d), px.elements(spark, d), px.windows(spark, d), px.DAY // 4, PRE)


PAIRS = f"""WITH placed AS (SELECT t.session_id, t.idx, t.token, t.start_ms, t.end_ms, arg_min(e.element_id, e.ordinal) AS element_id
  FROM px_timed_tokens t JOIN px_elements e ON t.session_id=e.session_id AND t.start_ms BETWEEN e.start_ms AND e.end_ms GROUP BY ALL),
 pairs AS (SELECT p.*, w.time_ms FROM placed p JOIN px_windows w ON p.session_id=w.session_id AND w.time_ms BETWEEN greatest(0, p.start_ms-{PRE}*1000) AND p.end_ms)"""


@query("j1_all_elements", "SELECT session_id, element_id, task_type, ordinal, start_ms, end_ms FROM px_elements")
def _(spark, d):
    return op.all_elements(px.elements(spark, d))


@query("j2_filter_elements", "SELECT * FROM px_elements WHERE task_type='eye' AND element_id='open_30'")
def _(spark, d):
    return op.filter_elements(px.elements(spark, d), task_type="eye", element_id="open_30")


@query("j2_filter_elements_unknown_column", "SELECT * FROM px_elements WHERE false")
def _(spark, d):
    return op.filter_elements(px.elements(spark, d), no_such_column=1)


@query("j4_min_duration", "SELECT * FROM px_elements WHERE end_ms-start_ms>=86400000")
def _(spark, d):
    return op.min_duration(px.elements(spark, d), 86400)


@query(
    "j5_middle_of_elements",
    "SELECT session_id, element_id, ordinal, round(start_ms+0.25::DOUBLE*(end_ms-start_ms),3) AS mid_start, round(end_ms-0.25::DOUBLE*(end_ms-start_ms),3) AS mid_end FROM px_elements",
)
def _(spark, d):
    out = op.middle(px.elements(spark, d), 0.5)
    return rounded(out.select("session_id", "element_id", "ordinal", "mid_start", "mid_end"), 3)


@query(
    "j6_windows_in_range",
    "SELECT w.session_id, w.time_ms, e.element_id FROM px_windows w JOIN px_elements e ON w.session_id=e.session_id AND w.time_ms BETWEEN e.start_ms AND e.end_ms",
)
def _(spark, d):
    out = op.in_range(px.windows(spark, d), px.elements(spark, d), "start_ms", "end_ms", CELL)
    return out.select("session_id", "time_ms", "element_id")


@query(
    "j7_distinct_hits",
    "SELECT DISTINCT w.session_id, w.time_ms FROM px_windows w JOIN px_elements e ON w.session_id=e.session_id AND w.time_ms BETWEEN e.start_ms AND e.end_ms",
)
def _(spark, d):
    out = op.hits(px.windows(spark, d), px.elements(spark, d), "start_ms", "end_ms", CELL)
    return out.select("session_id", "time_ms")


@query(
    "j8_window_labels",
    f"""SELECT w.session_id, w.time_ms, CAST(coalesce(CASE {EYE_CASES.replace('element_id', 'arg_min(e.element_id,e.ordinal)')} END, 100) AS INT) AS label
  FROM px_windows w LEFT JOIN px_elements e ON w.session_id=e.session_id AND w.time_ms BETWEEN e.start_ms AND e.end_ms GROUP BY 1,2""",
)
def _(spark, d):
    no_unknown = {"close": 0, "open": 1, "intro": 2}
    return op.labels(px.windows(spark, d), px.elements(spark, d), no_unknown, CELL).select("session_id", "time_ms", "label")


@query(
    "j8_window_labels_by_task_type",
    """SELECT w.session_id, w.time_ms, CAST(coalesce(CASE arg_min(e.task_type,e.ordinal) WHEN 'eye' THEN 7 WHEN 'breath' THEN 8 END, 9) AS INT) AS label
  FROM px_windows w LEFT JOIN px_elements e ON w.session_id=e.session_id AND w.time_ms BETWEEN e.start_ms AND e.end_ms GROUP BY 1,2""",
)
def _(spark, d):
    out = op.labels(px.windows(spark, d), px.elements(spark, d), {"eye": 7, "breath": 8, "unknown": 9}, CELL, "task_type")
    return out.select("session_id", "time_ms", "label")


@query(
    "j9_element_per_window",
    """SELECT w.session_id, w.time_ms, coalesce(arg_min(e.element_id,e.ordinal),'') AS element_id
  FROM px_windows w LEFT JOIN px_elements e ON w.session_id=e.session_id AND w.time_ms BETWEEN e.start_ms AND e.end_ms GROUP BY 1,2""",
)
def _(spark, d):
    out = op.element_at(px.windows(spark, d), px.elements(spark, d), CELL)
    return out.select("session_id", "time_ms", F.coalesce(F.col("hit.element_id"), F.lit("")).alias("element_id"))


@query("j10_gather_windows", EYE_GOOD + " SELECT session_id, time_ms, round(value,6) AS value, n FROM hits")
def _(spark, d):
    w = px.windows(spark, d)
    return rounded(op.gather(w, eye_good(spark, d)).select("session_id", "time_ms", "value", "n"))


@query("j11_eye_neural", EYE_NEURAL + COLS)
def _(spark, d):
    return rounded(op.eye_neural(px.elements(spark, d), px.windows(spark, d), CELL))


@query("j12_eye_good", EYE_GOOD + COLS)
def _(spark, d):
    return rounded(eye_good(spark, d))


@query("j13_breath_good", BREATH_GOOD + COLS)
def _(spark, d):
    return rounded(op.breath_good(px.elements(spark, d), px.windows(spark, d), CELL))


@query("j14_neuro_lang", PAIRS + " SELECT session_id, idx, token, element_id, time_ms FROM pairs")
def _(spark, d):
    return pairs(spark, d).select("session_id", "idx", "token", "element_id", "time_ms")


@query(
    "j15_token_window_map",
    PAIRS
    + """ SELECT session_id, idx, time_ms, dense_rank() OVER (PARTITION BY session_id ORDER BY start_ms, idx)-1 AS token_idx,
 dense_rank() OVER (PARTITION BY session_id ORDER BY time_ms)-1 AS window_idx FROM pairs""",
)
def _(spark, d):
    return op.token_window_map(pairs(spark, d), px.DAY)


@query(
    "j16_eye_good_label_counts",
    EYE_GOOD
    + """ SELECT label, count(*) AS n_windows, count(DISTINCT (session_id, element_id)) AS n_elements,
 CASE label WHEN 0 THEN 'close' WHEN 1 THEN 'open' WHEN 2 THEN 'intro' ELSE 'unknown' END AS label_name FROM res GROUP BY label""",
)
def _(spark, d):
    return op.label_counts(eye_good(spark, d), op.EYE_LABELS)


@query(
    "j17_label_breakdown",
    EYE_GOOD
    + """ SELECT label, count(*) AS n, min(time_ms) AS first_ms, max(time_ms) AS last_ms,
 array_to_string(list_sort(list_distinct(list(element_id)))[1:5], ',') AS examples, round(count(*)*100.0::DOUBLE/sum(count(*)) OVER (),6) AS percent FROM res GROUP BY label""",
)
def _(spark, d):
    return rounded(op.breakdown(eye_good(spark, d)))


@query(
    "j18_result_sanity",
    EYE_GOOD + """ SELECT count(DISTINCT session_id) AS n_sessions, count(*) AS n_windows, count(value) AS with_value, count(label) AS with_label, count(DISTINCT session_id) FILTER (value IS NOT NULL) AS sessions_value,
 count(DISTINCT session_id) FILTER (label IS NOT NULL) AS sessions_label, (SELECT round(max(n)*100.0::DOUBLE/sum(n),6) FROM (SELECT count(*) AS n FROM res GROUP BY label)) AS top_label_percent FROM res""",
)
def _(spark, d):
    return rounded(op.sanity(eye_good(spark, d), ["value", "label"]))


@query(
    "j19_inspect_token_windows",
    PAIRS + " SELECT session_id, count(DISTINCT idx) AS n_tokens, count(DISTINCT time_ms) AS n_windows, count(*) AS n_pairs FROM pairs GROUP BY 1",
)
def _(spark, d):
    return op.inspect_pairs(pairs(spark, d))


@query(
    "j19_sample_token_windows",
    PAIRS + " SELECT session_id, idx, token, time_ms FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY start_ms, idx, time_ms) AS r FROM pairs) WHERE r<=10",
)
def _(spark, d):
    return op.sample_pairs(pairs(spark, d)).select("session_id", "idx", "token", "time_ms")
