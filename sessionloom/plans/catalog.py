"""Catalogue, ledger, stores and curation on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.lineage import shared_dir
from ..operators import catalog as op
from ..operators import curate
from ..sources import events as source
from ..sources import stores
from . import inputs as px
from .crossquery import EYE_GOOD, eye_good
from .registry import query, rounded


@query("a1_session_listing", "SELECT DISTINCT session_id FROM px_manifest")
def _(spark, d):
    return op.list_sessions(px.manifest(spark, d), "curated/")


@query(
    "a2_parse_name",
    "SELECT path, session_id, substr(session_id,5,8)||substr(session_id,14,6) AS stamp FROM px_manifest UNION SELECT url, regexp_replace(regexp_extract(url,'([^/]*)$',1),'\\.h5$',''), '00000000000000' FROM (SELECT regexp_replace(url,'/+$','') AS url FROM pages)",
)
def _(spark, d):
    urls = px.table(spark, d, "pages").selectExpr("regexp_replace(url, '/+$', '') AS path")
    paths = px.manifest(spark, d).select("path").unionByName(urls).distinct()
    return paths.select("path", op.session_of(F.col("path")).alias("session_id"), op.stamp_of(F.col("path")).alias("stamp"))


CATALOG = """cat AS (SELECT session_id, count(*) AS n_files, CAST(sum(size_bytes) AS BIGINT) AS size_bytes,
  CASE WHEN max(meta) IS NOT NULL THEN max(meta)*1000 WHEN count(ms)>=2 THEN CAST(max(ms)-min(ms) AS DOUBLE) ELSE arg_min(size_bytes,(path,size_bytes))/1048576.0::DOUBLE*10*1000 END AS duration_ms,
  CASE WHEN max(meta) IS NOT NULL THEN 'metadata' WHEN count(ms)>=2 THEN 'timestamps' ELSE 'estimated' END AS duration_source, substr(session_id,5,8)||substr(session_id,14,6) AS stamp
 FROM (SELECT *, CASE WHEN file_id%50=0 THEN 3600.0::DOUBLE END AS meta, TRY_CAST(nullif(regexp_extract(path,'_(\\d{13})\\.h5$',1),'') AS BIGINT) AS ms FROM px_manifest) GROUP BY 1)"""


def catalog(spark, d):
    files = px.manifest(spark, d).withColumn("meta_duration_s", F.expr("CASE WHEN file_id % 50 = 0 THEN 3600.0D END"))
    return op.catalog(files)


@query("a3_session_catalog", f"WITH {CATALOG} SELECT session_id, n_files, size_bytes, round(duration_ms,3) AS duration_ms, duration_source, stamp FROM cat")
def _(spark, d):
    return rounded(catalog(spark, d), 3)


@query(
    "a4_filter_catalog",
    f"WITH {CATALOG} SELECT session_id, size_bytes FROM cat WHERE contains(session_id,'_0001') AND stamp>='20240105000000' AND size_bytes BETWEEN 500*1048576 AND 4000*1048576::BIGINT AND duration_ms>=30*60000",
)
def _(spark, d):
    return op.filter_catalog(catalog(spark, d), "_0001", "20240105", 500, 4000, 30).select("session_id", "size_bytes")


@query("a5_latest_session", f"WITH {CATALOG} SELECT session_id, stamp FROM cat WHERE contains(session_id,'_0002') ORDER BY stamp DESC, session_id DESC LIMIT 1")
def _(spark, d):
    return op.latest(catalog(spark, d), "_0002").select("session_id", "stamp")


@query(
    "a6_sessions_in_every_store",
    "SELECT session_id FROM px_events WHERE kind='view' INTERSECT SELECT session_id FROM px_events WHERE kind='click' INTERSECT SELECT session_id FROM px_events WHERE kind='signup'",
)
def _(spark, d):
    e = px.events(spark, d)
    return op.in_every_store([e.where("kind = 'view'"), e.where("kind = 'click'"), e.where("kind = 'signup'")])


LATEST = "lat AS (SELECT data_id, transform_id, status, ts_ms, seq FROM (SELECT *, row_number() OVER (PARTITION BY data_id, transform_id ORDER BY ts_ms DESC, seq DESC) AS r FROM (SELECT * FROM px_ledger {more})) WHERE r=1)"


@query(
    "a7_ledger_last_write",
    f"WITH {LATEST.format(more=chr(39).join(['UNION ALL SELECT data_id, ', '2-HIGH', ', ', 'failed', ', ts_ms+1, seq FROM px_ledger WHERE transform_id=', '1-URGENT', '']))} SELECT * FROM lat",
)
def _(spark, d):
    led = px.ledger(spark, d)
    new = led.where("transform_id = '1-URGENT'").selectExpr("data_id", "'2-HIGH' AS transform_id", "'failed' AS status", "ts_ms + 1 AS ts_ms", "seq")
    return op.record(led, new)


def _work(name, sql, **modes):
    @query(name, f"WITH {LATEST.format(more='')}, u AS (SELECT * FROM lat WHERE transform_id='1-URGENT') {sql}")
    def _(spark, d):
        items = px.table(spark, d, "customer").selectExpr("c_custkey AS data_id")
        return op.select_work(items, px.ledger(spark, d), "1-URGENT", **modes)


ITEMS = "SELECT c_custkey AS data_id FROM customer"
_work("a8_select_work", f"{ITEMS} WHERE c_custkey NOT IN (SELECT data_id FROM u WHERE status IN ('success','skipped'))")
_work("a8_select_work_with_skipped", f"{ITEMS} WHERE c_custkey NOT IN (SELECT data_id FROM u WHERE status='success')", include_skipped=True)
_work("a8_select_work_all", ITEMS, include_processed=True)
_work("a8_select_work_skipped_only", f"{ITEMS} WHERE c_custkey IN (SELECT data_id FROM u WHERE status='skipped')", skipped_only=True)
_work("a8_select_work_first_items", f"{ITEMS} WHERE c_custkey NOT IN (SELECT data_id FROM u WHERE status IN ('success','skipped')) ORDER BY 1 LIMIT 25", max_items=25)


@query("a9_latest_status", f"WITH {LATEST.format(more='')} SELECT data_id FROM lat WHERE transform_id='3-MEDIUM' AND status='skipped'")
def _(spark, d):
    return op.with_status(px.ledger(spark, d), "3-MEDIUM", "skipped")


@query(
    "a10_run_stats",
    "SELECT count(*) AS processed, count(*) FILTER (status='success') AS success, count(*) FILTER (status='failed') AS failed, count(*) FILTER (status='skipped') AS skipped FROM px_ledger",
)
def _(spark, d):
    return op.run_stats(px.ledger(spark, d))


@query("a11_reset_transform", "SELECT transform_id, count(*) AS n, (SELECT count(*) FROM px_ledger WHERE transform_id='5-LOW') AS n_deleted FROM px_ledger WHERE transform_id<>'5-LOW' GROUP BY 1")
def _(spark, d):
    kept, dropped = op.reset(px.ledger(spark, d), "5-LOW")
    return kept.groupBy("transform_id").agg(F.count(F.lit(1)).alias("n")).withColumn("n_deleted", dropped.scalar())


@query("a12_result_store", EYE_GOOD + " SELECT CAST(session_id AS BIGINT) AS session_id, count(*) AS n_rows FROM res GROUP BY 1")
def _(spark, d):
    out = eye_good(spark, d)
    path = f"{shared_dir(spark)}/result-{uuid.uuid4().hex}"
    stores.save_results(out, path)
    return stores.session_index(stores.load_results(spark, path)).select(F.col("session_id").cast("long").alias("session_id"), "n_rows")


@query("a12_result_attributes", EYE_GOOD + " SELECT count(DISTINCT session_id) AS session_count, count(*) AS row_count FROM res")
def _(spark, d):
    return stores.result_attributes(eye_good(spark, d))


@query("a13_nested_store", "SELECT session_id, element_id, start_ms AS times_start_ms, end_ms AS times_end_ms, task_type AS task_task_type FROM px_elements")
def _(spark, d):
    e = px.elements(spark, d).select("session_id", "element_id", "start_ms", "end_ms", "task_type")
    path = f"{shared_dir(spark)}/tree-{uuid.uuid4().hex}"
    stores.save_tree(e, path, {"times": ["start_ms", "end_ms"], "task": ["task_type"]})
    return stores.flatten_tree(spark.read.parquet(path))


@query(
    "a14_event_payloads",
    "SELECT event_id, CASE WHEN json_valid(p) THEN coalesce(CAST(json_extract(p,'$.k') AS INT),-1) ELSE -2 END AS k, CASE WHEN json_valid(p) THEN '' ELSE p END AS raw FROM (SELECT event_id, CASE WHEN value<1 THEN substr(props,1,4) ELSE props END AS p FROM px_events)",
)
def _(spark, d):
    e = px.events(spark, d).selectExpr("event_id", "CASE WHEN value < 1 THEN substr(props, 1, 4) ELSE props END AS payload")
    parsed = source.parse_payload(e, "k INT")
    return parsed.selectExpr("event_id", "CASE WHEN raw IS NULL THEN coalesce(data.k, -1) ELSE -2 END AS k", "coalesce(raw, '') AS raw")


@query(
    "a15_session_reports",
    """SELECT session_id, '{"session_id":'||session_id||',"n_events":'||count(*)||',"first_ms":'||min(client_ms)||',"kinds":['||array_to_string(list_sort(list_distinct(list('"'||kind||'"'))),',')||']}' AS report FROM px_events GROUP BY session_id""",
)
def _(spark, d):
    per = px.events(spark, d).groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("client_ms").alias("first_ms"), F.sort_array(F.collect_set("kind")).alias("kinds")
    )
    return stores.reports(per)


@query(
    "a16_batch_index",
    "SELECT session_id, (r-1)//20 AS batch, count(*) AS n_windows, min(time_ms) AS first, max(time_ms) AS last FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY time_ms) AS r FROM px_windows) GROUP BY 1,2",
)
def _(spark, d):
    return op.batch_index(op.batches(px.windows(spark, d), "time_ms", 10 * px.DAY, 20), "time_ms")


# --- curation -------------------------------------------------------------

RATE = "CASE WHEN clean_ms>0 THEN (size_bytes/1024.0::DOUBLE)/(clean_ms/1000.0::DOUBLE) ELSE 0 END"
CLASS = "CASE WHEN {r}<70 THEN 'neither' WHEN {r}<200 THEN 'fnirs only' ELSE 'both (fnirs+eeg)' END"
CLEAN = "cl AS (SELECT *, last_ms-first_ms AS clean_ms FROM px_sessions)"


@query("b1_rate_class", f"WITH {CATALOG}, c AS (SELECT session_id, size_bytes, duration_ms/1000000 AS clean_ms FROM cat), r AS (SELECT session_id, {RATE} AS rate FROM c) SELECT session_id, round(rate,4) AS rate, {CLASS.format(r='rate')} AS class FROM r")
def _(spark, d):
    rate = curate.data_rate(F.col("size_bytes"), F.col("duration_ms") / 1000000)
    out = catalog(spark, d).select("session_id", rate.alias("rate"))
    return rounded(out.withColumn("class", curate.rate_class(F.col("rate"))), 4)


@query("b2_clean_duration", "SELECT session_id, first_ms, last_ms FROM px_sessions")
def _(spark, d):
    return curate.clean_duration(px.events(spark, d), "event_id")


@query(
    "b3_qualified_sessions",
    f"""WITH {CLEAN}, r AS (SELECT *, {RATE} AS rate FROM cl), k AS (SELECT *, CASE WHEN clean_ms>0 THEN {CLASS.format(r='rate')} ELSE 'neither' END AS class FROM r)
 SELECT session_id, clean_ms, round(rate,4) AS data_rate, class, concat_ws(',', CASE WHEN clean_ms/1000.0<2500000 THEN 'too_short' END, CASE WHEN class='neither' THEN 'class_too_low' END) AS reasons,
  clean_ms/1000.0>=2500000 AND class<>'neither' AS qualifies FROM k""",
)
def _(spark, d):
    out = curate.qualify(px.sessions(spark, d), 2_500_000, curate.FNIRS_ONLY)
    return rounded(out.select("session_id", "clean_ms", "data_rate", "class", "reasons", "qualifies"), 4)


HOURS = f"""{CLEAN}, h AS (SELECT session_id, CASE WHEN clean_ms>0 THEN {CLASS.format(r=f'({RATE})')} ELSE 'x' END AS class, clean_ms/60000.0::DOUBLE AS clean_minutes,
  CASE WHEN clean_ms>0 AND clean_ms/60000.0>10 THEN clean_ms/60000.0::DOUBLE WHEN file_ms/60000.0>10 THEN file_ms/60000.0::DOUBLE END AS minutes FROM cl)"""


@query(
    "b4_corpus_hours",
    f"""WITH {HOURS} SELECT count(*) AS n_sessions, round(sum(minutes)/60,7) AS hours, round(coalesce(sum(clean_minutes) FILTER (class='both (fnirs+eeg)'),0),7) AS both_minutes,
 round(coalesce(sum(clean_minutes) FILTER (class<>'neither'),0),7) AS fnirs_minutes, round(coalesce(sum(clean_minutes) FILTER (class='both (fnirs+eeg)'),0),7) AS eeg_minutes FROM h WHERE minutes IS NOT NULL""",
)
def _(spark, d):
    return rounded(curate.corpus_hours(curate.session_minutes(px.sessions(spark, d))), 7)


@query("b4_class_counts", f"WITH {HOURS} SELECT class, count(*) AS n, round(sum(minutes),7) AS minutes FROM h WHERE minutes IS NOT NULL GROUP BY 1")
def _(spark, d):
    return rounded(curate.class_counts(curate.session_minutes(px.sessions(spark, d))), 7)
