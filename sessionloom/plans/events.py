"""Tasks, elements and segments from the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as op
from . import inputs as px
from .registry import query, rounded

SLICE = 30 * px.DAY
IDS_PER_SLICE = 1_000_000
CELL = px.DAY
SEGMENT_KINDS = {"recording": ("click", "error"), "thinking": ("signup", "view"), "pause": ("purchase", "error")}


def pairs(log, start, end, cols, mode="auto"):
    return op.pair_sides(op.sided(log, start, end), ["session_id"], "client_ms", "event_id", cols, SLICE, IDS_PER_SLICE, mode)


def pair_sql(start: str, end: str, mode: str = "auto") -> str:
    """Pairing of the n-th start with the n-th end, by source order or by time."""
    keep = {"auto": "true", "positional": "by_pos", "ranked": "NOT by_pos"}[mode]
    return f"""SELECT session_id, n, s.event_id AS start_event_id, e.event_id AS end_event_id, s.client_ms AS start_client_ms, e.client_ms AS end_client_ms,
   by_pos, s.payload AS start_payload FROM
 (SELECT *, CASE WHEN by_pos THEN row_number() OVER (PARTITION BY session_id ORDER BY event_id) ELSE row_number() OVER (PARTITION BY session_id ORDER BY client_ms, event_id) END AS n
   FROM px_log JOIN (SELECT session_id, count(*) FILTER (kind='{start}')=count(*) FILTER (kind='{end}') AS by_pos FROM px_log GROUP BY 1) USING (session_id) WHERE kind='{start}') s
 JOIN (SELECT *, CASE WHEN by_pos THEN row_number() OVER (PARTITION BY session_id ORDER BY event_id) ELSE row_number() OVER (PARTITION BY session_id ORDER BY client_ms, event_id) END AS n
   FROM px_log JOIN (SELECT session_id, count(*) FILTER (kind='{start}')=count(*) FILTER (kind='{end}') AS by_pos FROM px_log GROUP BY 1) p USING (session_id) WHERE kind='{end}') e
 USING (session_id, n, by_pos) WHERE (by_pos OR e.client_ms>=s.client_ms) AND {keep}"""


PAIR_OUT = "SELECT session_id, n, start_event_id, end_event_id, start_client_ms, end_client_ms FROM ({})"

TASKS = f"""tasks AS (SELECT session_id, task_id, min(n) AS ordinal, arg_max(task_type,n) AS task_type, arg_max(st,n) AS start_ms, arg_max(en,n) AS end_ms,
  arg_max(cnt,n) AS count, arg_max(im,n) AS input_modality FROM (
   SELECT session_id, n, json_extract_string(start_payload,'$.task_id') AS task_id, json_extract_string(start_payload,'$.task_type') AS task_type, start_client_ms AS st,
     end_client_ms AS en, CAST(json_extract(start_payload,'$.config.count') AS INT) AS cnt, coalesce(nullif(json_extract_string(start_payload,'$.config.input_modality'),''),'text') AS im
   FROM ({pair_sql('signup', 'error')})) WHERE task_id<>'' GROUP BY 1,2)"""

SKIPS = (
    TASKS
    + """, skips AS (SELECT session_id, event_id, client_ms FROM px_log WHERE kind='purchase'),
 running AS (SELECT s.session_id, s.event_id, arg_min(t.task_id,t.ordinal) AS task_id, arg_min(t.start_ms,t.ordinal) AS st FROM skips s JOIN tasks t
   ON s.session_id=t.session_id AND s.client_ms BETWEEN t.start_ms AND t.end_ms GROUP BY 1,2),
 coming AS (SELECT s.session_id, s.event_id, arg_min(t.task_id,(t.start_ms,t.ordinal)) AS task_id, arg_min(t.start_ms,(t.start_ms,t.ordinal)) AS st FROM skips s JOIN tasks t
   ON s.session_id=t.session_id AND t.start_ms>s.client_ms GROUP BY 1,2),
 hit AS (SELECT s.*, coalesce(r.task_id,c.task_id) AS task_id, coalesce(r.st,c.st) AS st FROM skips s LEFT JOIN running r USING (session_id,event_id)
   LEFT JOIN coming c USING (session_id,event_id)),
 last AS (SELECT session_id, task_id, max(event_id) AS skip_event, arg_max(client_ms,event_id) AS skip_ms, arg_max(st,event_id) AS st FROM hit WHERE task_id IS NOT NULL GROUP BY 1,2)"""
)

ELEMENTS = """elems AS (SELECT session_id, s.k AS element_id, ordinal, 't'||(CAST(s.k AS INT)%3) AS element_type,
   CASE WHEN CAST(s.k AS INT)%10=0 THEN '' ELSE concat('task_', CAST(s.k AS INT)%10) END AS task_id, CAST(s.k AS INT)%4 AS sequence_idx, st AS start_ms, en AS end_ms, en-st AS duration_ms,
   'text_only' AS audio_mode, 'voice' AS input_modality,
   coalesce(nullif(CAST(s.k AS INT)%3,0), nullif(CAST(s.k AS INT)%5,0), -1) AS response_time_seconds
 FROM (SELECT session_id, k, min(event_id) AS ordinal, arg_max(client_ms,event_id) AS st FROM px_log WHERE kind='view' GROUP BY 1,2) s
 JOIN (SELECT session_id, k, arg_max(client_ms,event_id) AS en FROM px_log WHERE kind='purchase' GROUP BY 1,2) e USING (session_id,k))"""

SEGMENTS = "segs AS (" + " UNION ALL ".join(
    f"SELECT session_id, start_event_id AS segment_id, '{name}' AS segment_type, n AS type_index, start_client_ms AS start_ms, end_client_ms AS end_ms, end_client_ms-start_client_ms AS duration_ms, end_event_id FROM ({pair_sql(a, b)})"
    for name, (a, b) in SEGMENT_KINDS.items()
) + ")"


def task_rows(spark, d):
    cols = ["event_id", "client_ms", "payload"]
    return op.tasks(pairs(px.log(spark, d), "signup", "error", cols))


def element_rows(spark, d):
    log = px.log(spark, d)
    paired = op.pair_by_key(
        op.events_of(log, "view"), op.events_of(log, "purchase"), ["session_id", "k"], "event_id", ["event_id", "client_ms", "payload"]
    )
    return op.elements(paired)


def segment_rows(spark, d):
    return op.segments(px.log(spark, d), SEGMENT_KINDS, SLICE, IDS_PER_SLICE)


@query(
    "c1_pair_by_key",
    """SELECT session_id, k, ordinal, start_event_id, start_client_ms, end_event_id, end_client_ms FROM
 (SELECT session_id, k, min(event_id) AS ordinal, max(event_id) AS start_event_id, arg_max(client_ms,event_id) AS start_client_ms FROM px_log WHERE kind='view' GROUP BY 1,2)
 JOIN (SELECT session_id, k, max(event_id) AS end_event_id, arg_max(client_ms,event_id) AS end_client_ms FROM px_log WHERE kind='purchase' GROUP BY 1,2) USING (session_id,k)""",
)
def _(spark, d):
    log = px.log(spark, d)
    return op.pair_by_key(
        op.events_of(log, "view"), op.events_of(log, "purchase"), ["session_id", "k"], "event_id", ["event_id", "client_ms"]
    )


def _pair_query(name, mode):
    @query(name, PAIR_OUT.format(pair_sql("click", "error", mode)))
    def _(spark, d):
        out = pairs(px.log(spark, d), "click", "error", ["event_id", "client_ms"], mode)
        return out.drop("positional")


_pair_query("c2_pair_positional", "positional")
_pair_query("c3_pair_ranked", "ranked")


@query(
    "c4_task_table",
    f"WITH {TASKS} SELECT *, 'completed' AS completion_status, end_ms-start_ms AS duration_ms, false AS skipped, 'text_only' AS audio_mode FROM tasks",
)
def _(spark, d):
    return task_rows(spark, d).select(
        "session_id", "task_id", "ordinal", "task_type", "start_ms", "end_ms", "count", "input_modality",
        "completion_status", "duration_ms", "skipped", "audio_mode",
    )


@query(
    "c5_skip_attribution",
    f"""WITH {SKIPS} SELECT t.session_id, t.task_id, t.ordinal, l.task_id IS NOT NULL AS skipped, coalesce(l.skip_ms,0) AS skip_ms, coalesce(CAST(l.skip_event AS VARCHAR),'') AS skip_event_id,
  CASE WHEN l.task_id IS NULL THEN 'completed' WHEN l.skip_ms<=l.st THEN 'skipped_before_start' ELSE 'partially_completed_then_skipped' END AS completion_status
  FROM tasks t LEFT JOIN last l USING (session_id, task_id)""",
)
def _(spark, d):
    skips = op.events_of(px.log(spark, d), "purchase").select("session_id", "event_id", "client_ms")
    out = op.attribute_skips(task_rows(spark, d), skips, CELL)
    return out.select("session_id", "task_id", "ordinal", "skipped", "skip_ms", "skip_event_id", "completion_status")


@query("c6_element_table", f"WITH {ELEMENTS} SELECT * FROM elems")
def _(spark, d):
    return element_rows(spark, d).select(
        "session_id", "element_id", "ordinal", "element_type", "task_id", "sequence_idx", "start_ms", "end_ms",
        "duration_ms", "audio_mode", "input_modality", "response_time_seconds",
    )


@query(
    "c7_elements_with_task_type",
    f"WITH {TASKS}, {ELEMENTS} SELECT e.session_id, e.element_id, e.task_id, coalesce(t.task_type,'') AS task_type FROM elems e LEFT JOIN tasks t USING (session_id, task_id)",
)
def _(spark, d):
    out = op.with_task_type(element_rows(spark, d), task_rows(spark, d))
    return out.select("session_id", "element_id", "task_id", "task_type")


@query(
    "c7_task_element_count",
    f"WITH {TASKS}, {ELEMENTS} SELECT t.session_id, t.task_id, count(e.element_id) AS element_count FROM tasks t LEFT JOIN elems e USING (session_id, task_id) GROUP BY 1,2",
)
def _(spark, d):
    out = op.with_element_count(task_rows(spark, d), element_rows(spark, d))
    return out.select("session_id", "task_id", "element_count")


@query("c8_segment_table", f"WITH {SEGMENTS} SELECT * FROM segs")
def _(spark, d):
    return segment_rows(spark, d)


CONTAIN = f"""WITH {SEGMENTS}, {ELEMENTS}, found AS (SELECT s.session_id, s.segment_type, s.segment_id, arg_min(e.element_id,e.ordinal) AS eid, arg_min(s.start_ms-e.start_ms,e.ordinal) AS rel
 FROM segs s LEFT JOIN elems e ON s.session_id=e.session_id AND s.start_ms BETWEEN e.start_ms AND e.end_ms GROUP BY 1,2,3)
 SELECT session_id, segment_type, segment_id, coalesce(eid,'') AS containing_element_id, CAST(coalesce(rel,0) AS DOUBLE) AS element_relative_start FROM found"""


@query("c9_segment_containment", CONTAIN)
def _(spark, d):
    out = op.contain(segment_rows(spark, d), element_rows(spark, d), CELL)
    return out.select("session_id", "segment_type", "segment_id", "containing_element_id", "element_relative_start")


@query(
    "c10_typed_fill",
    f"""WITH {TASKS}, {ELEMENTS} SELECT e.session_id, e.element_id, coalesce(t.task_type,'') AS known_type, coalesce(t.start_ms,0) AS task_start_ms,
 CAST(coalesce(t.start_ms*0.001::DOUBLE,0) AS DOUBLE) AS task_start_s, coalesce(t.count>2,false) AS many FROM elems e LEFT JOIN tasks t USING (session_id, task_id)""",
)
def _(spark, d):
    t = task_rows(spark, d).selectExpr(
        "session_id", "task_id", "task_type AS known_type", "start_ms AS task_start_ms", "start_ms * 0.001D AS task_start_s", "count > 2 AS many"
    )
    joined = element_rows(spark, d).select("session_id", "element_id", "task_id").join(t, ["session_id", "task_id"], "left")
    return op.fill_missing(joined.drop("task_id"))


@query(
    "c11_relative_times",
    """SELECT session_id, element_id, start_ms-t0 AS relative_start_ms, round((start_ms-t0)/86400.0::DOUBLE,6) AS fraction_start_raw, round((end_ms-t0)/86400.0::DOUBLE,6) AS fraction_end_raw,
 round((start_ms-t0)/nullif(t1-t0,0)::DOUBLE,6) AS fraction_start FROM px_elements JOIN (SELECT session_id, min(client_ms) AS t0, max(client_ms) AS t1 FROM px_events GROUP BY 1) USING (session_id)""",
)
def _(spark, d):
    out = op.relative_times(px.elements(spark, d), px.events(spark, d))
    return rounded(
        out.select("session_id", "element_id", "relative_start_ms", "fraction_start_raw", "fraction_end_raw", "fraction_start")
    )


@query("c12_events_of_kind", "SELECT session_id, event_id, client_ms, value FROM px_events WHERE kind='signup'")
def _(spark, d):
    return op.events_of(px.events(spark, d), "signup").select("session_id", "event_id", "client_ms", "value")


@query(
    "c12_event_kinds_summary",
    "SELECT kind, count(*) AS n, count(DISTINCT session_id) AS n_sessions, min(client_ms) AS first_ms, max(client_ms) AS last_ms FROM px_events GROUP BY kind",
)
def _(spark, d):
    return (
        px.events(spark, d)
        .groupBy("kind")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("session_id").alias("n_sessions"),
            F.min("client_ms").alias("first_ms"),
            F.max("client_ms").alias("last_ms"),
        )
    )
