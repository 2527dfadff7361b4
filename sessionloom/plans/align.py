"""Windowing of the two device streams.

The streams have about one frame a day, so the ideal period is a day, two EEG
frames make a window, and offsets use five frames.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align as op
from . import inputs as px
from .registry import query, rounded

T = op.Timing(period=px.DAY, eeg_per_window=2, chunk=5, density=0.6, slice_ms=10 * px.DAY)
P = px.DAY

OV = """ov AS (SELECT session_id, greatest(e0,f0) AS from_ms, least(e1,f1) AS to_ms FROM (SELECT session_id, min(ts_ms) FILTER (stream='eeg') AS e0, max(ts_ms) FILTER (stream='eeg') AS e1,
  min(ts_ms) FILTER (stream='fnirs') AS f0, max(ts_ms) FILTER (stream='fnirs') AS f1 FROM px_frames GROUP BY 1) WHERE e0 IS NOT NULL AND f0 IS NOT NULL AND greatest(e0,f0)<least(e1,f1))"""
BOUNDS = """bounds AS (SELECT session_id, from_ms, to_ms, min(frame) FILTER (stream='eeg') AS eeg_first, max(frame) FILTER (stream='eeg') AS eeg_last,
  min(frame) FILTER (stream='fnirs') AS fnirs_first, max(frame) FILTER (stream='fnirs') AS fnirs_last FROM px_frames JOIN ov USING (session_id) WHERE ts_ms BETWEEN from_ms AND to_ms GROUP BY 1,2,3)"""


def fill_sql(src: str) -> str:
    return f"""gf0 AS (SELECT *, lead(ts_ms) OVER (PARTITION BY session_id ORDER BY ts_ms, frame) AS nx FROM ({src})),
 gf AS (SELECT session_id, frame, k, CAST(ts_ms+k*{P} AS DOUBLE) AS ts_ms, k=0 AS is_actual, CASE WHEN k=0 THEN value ELSE 0 END AS value,
   row_number() OVER (PARTITION BY session_id ORDER BY ts_ms+k*{P}, frame, k)-1 AS idx
   FROM (SELECT *, unnest(range(0, greatest(1, CAST(coalesce(round_even((nx-ts_ms)/{P}::DOUBLE,0),1) AS BIGINT)))) AS k FROM gf0)),
 dens AS (SELECT *, sum(CAST(is_actual AS INT)) OVER (PARTITION BY session_id ORDER BY idx ROWS 4 PRECEDING) AS s FROM gf),
 good AS (SELECT session_id, max(idx) FILTER (idx>=4 AND s/5>=0.6::DOUBLE) AS e FROM dens GROUP BY 1),
 pr AS (SELECT gf.* FROM gf JOIN good USING (session_id) WHERE e IS NULL OR idx<=e),
 early AS (SELECT session_id, avg(ts_ms-t0-j*{P}) AS early_ms, min(t0) AS first_ms FROM (SELECT session_id, ts_ms, row_number() OVER w -1 AS j, first_value(ts_ms) OVER w AS t0
   FROM pr WHERE is_actual WINDOW w AS (PARTITION BY session_id ORDER BY idx)) WHERE j<5 GROUP BY 1),
 late AS (SELECT session_id, avg(ts_ms-t0-j*{P}) AS late_ms, max(n) AS n, max(ts_ms) AS last_ms FROM (SELECT *, idx-(n-5) AS j, first_value(ts_ms) OVER (PARTITION BY session_id ORDER BY idx) AS t0
   FROM (SELECT *, count(*) OVER (PARTITION BY session_id) AS n FROM pr) WHERE idx>=n-5) GROUP BY 1),
 dr AS (SELECT session_id, early_ms, CASE WHEN n>=5 THEN late_ms ELSE early_ms END AS late_ms, first_ms, last_ms, first_ms-early_ms AS start_ms,
   CASE WHEN last_ms-first_ms>{P} THEN ((CASE WHEN n>=5 THEN late_ms ELSE early_ms END)-early_ms)/(last_ms-first_ms)*1000.0 ELSE 0 END AS drift_ms_per_s FROM early JOIN late USING (session_id))"""


IN_OVERLAP = "SELECT session_id, frame, ts_ms, value FROM px_frames JOIN ov USING (session_id) WHERE stream='fnirs' AND ts_ms BETWEEN from_ms AND to_ms"
CHAIN = f"WITH {OV}, {BOUNDS}, {fill_sql(IN_OVERLAP)}"
STARTS = f"""{CHAIN}, ends AS (SELECT session_id, eeg_first, eeg_last, start_ms, max(frame) FILTER (ts_ms<=last_ms) AS e FROM px_frames JOIN bounds USING (session_id) JOIN dr USING (session_id)
   WHERE stream='eeg' AND eeg_last-eeg_first+1>=2 GROUP BY ALL),
 use AS (SELECT *, CASE WHEN e-eeg_first+1>=2 THEN least(e,eeg_last) ELSE eeg_last END AS last_frame FROM ends),
 st AS (SELECT session_id, last_frame, start_ms, min(frame) AS first_frame FROM px_frames JOIN use USING (session_id) WHERE stream='eeg' AND ts_ms>=start_ms AND frame BETWEEN eeg_first AND last_frame GROUP BY ALL)"""
CHUNKS = f"""{STARTS}, ch AS (SELECT session_id, (frame-first_frame)//2 AS window_idx, start_ms, min(frame) AS eeg_frame, arg_min(ts_ms,frame) AS eeg_ms, arg_max(ts_ms,frame) AS eeg_last_ms, avg(value) AS eeg_value
   FROM px_frames JOIN st USING (session_id) WHERE stream='eeg' AND frame BETWEEN first_frame AND last_frame GROUP BY 1,2,3 HAVING count(*)=2),
 cp AS (SELECT c.*, p.ts_ms AS fnirs_ms, p.is_actual, p.value AS fnirs_value, c.start_ms+c.window_idx*{P} AS ideal_ms FROM ch c JOIN pr p ON c.session_id=p.session_id AND c.window_idx=p.idx)"""


def clock_sql(src: str) -> str:
    return f"""cr AS (SELECT session_id, CAST(min(ts_ms) AS DOUBLE) AS t0, CAST(ceil((max(ts_ms+CASE WHEN stream='eeg' THEN {P}/2::DOUBLE ELSE {P} END)-min(ts_ms))/{P}) AS BIGINT) AS n FROM ({src}) GROUP BY 1),
 clk AS (SELECT session_id, slot, t0+slot*{P} AS time_ms FROM (SELECT *, unnest(range(0,n)) AS slot FROM cr))"""


PLACED = f"""placed AS (SELECT * FROM (SELECT w.*, least(greatest(CAST(ceil((ideal_ms-t0)/{P}-0.5::DOUBLE) AS BIGINT),0),n-1) AS slot, t0 FROM wins w JOIN cr USING (session_id)) WHERE abs(t0+slot*{P}-ideal_ms)<={P}/1.9::DOUBLE),
 uniq AS (SELECT session_id, slot, arg_max(eeg_ms,window_idx) AS eeg_ms, arg_max(eeg_last_ms,window_idx) AS eeg_last_ms, arg_max(fnirs_ms,window_idx) FILTER (is_actual) AS fnirs_ms, bool_or(is_actual) AS is_actual FROM placed GROUP BY 1,2),
 sl AS (SELECT c.session_id, c.slot, c.time_ms, coalesce(p.eeg_ms IS NOT NULL,false) AS eeg_valid, coalesce(p.is_actual,false) AS fnirs_valid, CAST(p.eeg_ms AS DOUBLE) AS real_eeg_ms,
   CAST(p.eeg_last_ms AS DOUBLE) AS eeg_last_ms, CASE WHEN p.is_actual THEN CAST(p.fnirs_ms AS DOUBLE) END AS real_fnirs_ms FROM clk c LEFT JOIN uniq p ON c.session_id=p.session_id AND c.slot=p.slot)"""
SLOTS = f"{CHUNKS}, wins AS (SELECT * FROM cp), {clock_sql('SELECT * FROM px_frames WHERE session_id IN (SELECT session_id FROM st)')}, {PLACED}"
SPANS = """SELECT session_id, coalesce(min(slot) FILTER (eeg_valid),-1) AS eeg_start, coalesce(max(slot) FILTER (eeg_valid)+1,-1) AS eeg_end,
 coalesce(min(slot) FILTER (fnirs_valid),-1) AS fnirs_start, coalesce(max(slot) FILTER (fnirs_valid)+1,-1) AS fnirs_end,
 coalesce(min(slot) FILTER (eeg_valid AND fnirs_valid),-1) AS both_start, coalesce(max(slot) FILTER (eeg_valid AND fnirs_valid)+1,-1) AS both_end FROM sl GROUP BY 1"""
SLOT_OUT = " SELECT session_id, slot, time_ms, eeg_valid, fnirs_valid, coalesce(real_eeg_ms,-1) AS real_eeg_ms, coalesce(round(real_fnirs_ms,3),-1) AS real_fnirs_ms FROM sl"

# One stream only: every EEG frame or every optical frame of a session.
EEG_ONLY = f"""WITH st AS (SELECT session_id, min(ts_ms) AS start_ms FROM px_frames WHERE stream='eeg' GROUP BY 1 HAVING count(*)>=2),
 wins AS (SELECT session_id, frame//2 AS window_idx, start_ms+(frame//2)*{P}::DOUBLE AS ideal_ms, arg_min(ts_ms,frame) AS eeg_ms, arg_max(ts_ms,frame) AS eeg_last_ms, NULL::DOUBLE AS fnirs_ms, NULL::BOOLEAN AS is_actual
   FROM px_frames JOIN st USING (session_id) WHERE stream='eeg' GROUP BY 1,2,3 HAVING count(*)=2),
 {clock_sql("SELECT * FROM px_frames WHERE stream='eeg' AND session_id IN (SELECT session_id FROM st)")}, {PLACED}"""
FNIRS_SRC = "SELECT session_id, frame, ts_ms, value FROM px_frames WHERE stream='fnirs'"
FNIRS_ONLY = f"""WITH {fill_sql(FNIRS_SRC)}, wins AS (SELECT session_id, idx AS window_idx, start_ms+idx*{P} AS ideal_ms, NULL::DOUBLE AS eeg_ms, NULL::DOUBLE AS eeg_last_ms, ts_ms AS fnirs_ms, is_actual FROM pr JOIN dr USING (session_id)),
 {clock_sql("SELECT * FROM px_frames WHERE stream='fnirs'")}, {PLACED}"""


def slots_out(df):
    keep = [F.coalesce(c, F.lit(-1.0)).alias(c) for c in ("real_eeg_ms", "real_fnirs_ms")]
    return rounded(df.select("session_id", "slot", "time_ms", "eeg_valid", "fnirs_valid", *keep), 3)


@query("d1_overlap", f"WITH {OV}, {BOUNDS} SELECT * FROM bounds")
def _(spark, d):
    return op.overlap_frames(px.frames(spark, d))


def filled(spark, d):
    f = px.frames(spark, d)
    inside = op.attach(op.of(f, "fnirs"), op.overlap(f), ["session_id"]).where("ts_ms BETWEEN from_ms AND to_ms")
    return op.gap_fill(inside.drop("from_ms", "to_ms"), T)


@query("d2_gap_fill", CHAIN + " SELECT session_id, idx, CAST(ts_ms AS BIGINT) AS ts_ms, is_actual, round(value,6) AS value FROM gf")
def _(spark, d):
    return rounded(filled(spark, d).selectExpr("session_id", "idx", "bigint(ts_ms) AS ts_ms", "is_actual", "value"))


@query("d3_truncate_tail", CHAIN + " SELECT session_id, idx, CAST(ts_ms AS BIGINT) AS ts_ms, is_actual FROM pr")
def _(spark, d):
    return op.truncate(op.cut(filled(spark, d)), T).selectExpr("session_id", "idx", "bigint(ts_ms) AS ts_ms", "is_actual")


@query("d4_clock_drift", CHAIN + " SELECT session_id, round(early_ms,3) AS early_ms, round(late_ms,3) AS late_ms, round(drift_ms_per_s,6) AS drift_ms_per_s FROM dr")
def _(spark, d):
    out = op.drift(op.cut(op.processed_fnirs(px.frames(spark, d), T)), T)
    out = out.select("session_id", "early_ms", "late_ms", "drift_ms_per_s")
    return rounded(rounded(out, 3, "early_ms", "late_ms"), 6, "drift_ms_per_s")


def starts(spark, d):
    f = op.cut(px.frames(spark, d))
    processed = op.cut(op.processed_fnirs(f, T))
    return f, processed, op.align_start(f, op.overlap_frames(f), op.drift(processed, T), T)


@query("d5_align_start", STARTS + " SELECT session_id, first_frame, last_frame, round(start_ms,3) AS start_ms FROM st")
def _(spark, d):
    return rounded(starts(spark, d)[2], 3)


@query(
    "d6_chunk_pairs",
    CHUNKS + " SELECT session_id, window_idx, eeg_frame, eeg_ms, CAST(fnirs_ms AS BIGINT) AS fnirs_ms, is_actual, round(ideal_ms,3) AS ideal_ms, round(eeg_value,6) AS eeg_value FROM cp",
)
def _(spark, d):
    f, processed, st = starts(spark, d)
    out = op.chunk_pairs(f, processed, st, T).selectExpr(
        "session_id", "window_idx", "eeg_frame", "eeg_ms", "bigint(fnirs_ms) AS fnirs_ms", "is_actual", "ideal_ms", "eeg_value"
    )
    return rounded(rounded(out, 3, "ideal_ms"), 6, "eeg_value")


@query("d7_master_clock", f"WITH {clock_sql('SELECT * FROM px_frames')} SELECT * FROM clk")
def _(spark, d):
    return op.clock(px.frames(spark, d), T)


@query("d8_windows_on_slots", SLOTS + SLOT_OUT)
def _(spark, d):
    return slots_out(op.two_stream_windows(px.frames(spark, d), T))


@query(
    "d9_window_arrays",
    """SELECT session_id, channel, window_idx, string_agg(x, ',' ORDER BY sample) AS samples FROM (SELECT session_id, channel, sample//24 AS window_idx, sample, CAST(CAST(round(x*1000000) AS BIGINT) AS VARCHAR) AS x FROM px_samples)
 GROUP BY 1,2,3 HAVING count(*)=24""",
)
def _(spark, d):
    frames = (
        px.samples(spark, d)
        .groupBy("session_id", "channel", F.expr("sample div 8").alias("frame"))
        .agg(F.expr("transform(sort_array(collect_list(struct(sample, x))), s -> s.x)").alias("samples"))
    )
    out = op.window_arrays(frames, 3)
    return out.select(
        "session_id", "channel", "window_idx", F.expr("array_join(transform(samples, x -> string(bigint(round(x * 1000000)))), ',')").alias("samples")
    )


@query("d10_valid_span", f"{SLOTS} {SPANS}")
def _(spark, d):
    return op.valid_span(op.two_stream_windows(px.frames(spark, d), T))


@query(
    "d10_joint_windows",
    f"{SLOTS}, spans AS ({SPANS}) SELECT session_id, slot, slot-both_start AS dataset_idx, eeg_valid, fnirs_valid FROM sl JOIN spans USING (session_id) WHERE slot>=both_start AND slot<both_end",
)
def _(spark, d):
    out = op.joint_windows(op.cut(op.two_stream_windows(px.frames(spark, d), T)))
    return out.select("session_id", "slot", "dataset_idx", "eeg_valid", "fnirs_valid")


@query(
    "d11_trim_stats",
    f"""{SLOTS}, spans AS ({SPANS}), raw AS (SELECT session_id, max(ts_ms) FILTER (stream='eeg')+{P}/2-min(ts_ms) FILTER (stream='eeg') AS ea, max(ts_ms) FILTER (stream='fnirs')+{P}-min(ts_ms) FILTER (stream='fnirs') AS fa FROM px_frames GROUP BY 1),
 cov AS (SELECT session_id, arg_max(eeg_last_ms,slot) FILTER (eeg_valid)+{P}/2-min(real_eeg_ms) AS eg, arg_max(real_fnirs_ms,slot) FILTER (fnirs_valid)+{P}-min(real_fnirs_ms) AS fg, count(*) FILTER (fnirs_valid) AS nf FROM sl GROUP BY 1)
 SELECT session_id, round(coalesce(least(greatest((1-eg/ea)*100,0),100),100),4) AS percent_eeg_trimmed, round(coalesce(least(greatest((1-fg/fa)*100,0),100),100),4) AS percent_fnirs_trimmed,
  round(CASE WHEN fnirs_end>fnirs_start THEN least(greatest((fnirs_end-fnirs_start-nf)/(fnirs_end-fnirs_start)::DOUBLE*100,0),100) ELSE 0 END,4) AS percent_fnirs_missing
 FROM spans JOIN raw USING (session_id) JOIN cov USING (session_id)""",
)
def _(spark, d):
    f = op.cut(px.frames(spark, d))
    return rounded(op.trim_stats(op.cut(op.two_stream_windows(f, T)), f, T), 4)


@query("d12_eeg_only_windows", EEG_ONLY + SLOT_OUT)
def _(spark, d):
    return slots_out(op.eeg_only_windows(px.frames(spark, d), T))


@query("d13_fnirs_only_windows", FNIRS_ONLY + SLOT_OUT)
def _(spark, d):
    return slots_out(op.fnirs_only_windows(px.frames(spark, d), T))


# Every fifth optical frame loses its time; single zeros follow the closed form directly.
@query(
    "d13_zero_time_repair",
    f"""WITH z AS (SELECT session_id, frame, CASE WHEN frame%5=0 THEN 0 ELSE ts_ms END AS ts FROM px_frames WHERE stream='fnirs'),
 n AS (SELECT *, lag(ts) OVER w AS p, lead(ts) OVER w AS nx FROM z WINDOW w AS (PARTITION BY session_id ORDER BY frame))
 SELECT session_id, frame, round(CASE WHEN ts<>0 THEN ts::DOUBLE WHEN p IS NULL THEN CASE WHEN nx-{P}>0 THEN nx-{P} ELSE 0 END
   WHEN nx IS NULL OR p+{P}<nx THEN p+{P} WHEN p<nx THEN (p+nx)/2::DOUBLE ELSE 0 END,3) AS ts_ms FROM n""",
)
def _(spark, d):
    z = op.of(px.frames(spark, d), "fnirs").withColumn("ts_ms", F.expr("CASE WHEN frame % 5 = 0 THEN 0L ELSE ts_ms END"))
    return rounded(op.repair_zero_times(z, T).select("session_id", "frame", "ts_ms"), 3)


@query(
    "d14_log_windows",
    "SELECT channel, count(*) FILTER (x<=0) AS n_nan, round(sum(CASE WHEN x>0 THEN ln(x) END),6) AS sum_log FROM px_samples GROUP BY 1",
)
def _(spark, d):
    arrays = px.table(spark, d, "embeddings").selectExpr("vec_id AS channel", "transform(embedding, x -> double(x)) AS samples")
    logged = op.log_windows(arrays)
    return rounded(
        logged.selectExpr(
            "channel",
            "bigint(size(filter(samples, x -> isnan(x)))) AS n_nan",
            "aggregate(filter(samples, x -> NOT isnan(x)), 0D, (a, x) -> a + x) AS sum_log",
        )
    )


@query(
    "d15_modality_route",
    """SELECT session_id, CASE WHEN e AND f THEN 'both' WHEN e THEN 'eeg_only' WHEN f THEN 'fnirs_only' ELSE 'skipped_no_data_for_windowing' END AS route
 FROM (SELECT session_id, bool_or(kind='click') AS e, bool_or(kind='error') AS f FROM px_events GROUP BY 1)""",
)
def _(spark, d):
    return op.route(px.events(spark, d), px.frames(spark, d))


@query("d15_windows_of_all_sessions", SLOTS + " SELECT session_id, 'both' AS route, count(*) AS n_slots, count(*) FILTER (eeg_valid) AS n_eeg, count(*) FILTER (fnirs_valid) AS n_fnirs FROM sl GROUP BY 1")
def _(spark, d):
    out = op.all_windows(px.events(spark, d), px.frames(spark, d), T)
    return out.groupBy("session_id", "route").agg(
        F.count(F.lit(1)).alias("n_slots"), F.count_if("eeg_valid").alias("n_eeg"), F.count_if("fnirs_valid").alias("n_fnirs")
    )


@query(
    "d16_sliding_windows",
    """WITH w AS (SELECT label AS session_id, channel, 'eeg' AS modality, unnest(range(0,7)) AS win, 16 AS size, 8 AS stride FROM (SELECT DISTINCT label, channel FROM px_samples WHERE channel%2=0)
   UNION ALL SELECT label, channel, 'fnirs', unnest(range(0,7)), 8, 4 FROM (SELECT DISTINCT label, channel FROM px_samples WHERE channel%2=1))
 SELECT w.session_id, w.channel, w.modality, w.win AS "window", round(avg(x),6) AS mean, count(*) AS n, w.win*0.125::DOUBLE AS start_s, w.win*0.125::DOUBLE+0.25::DOUBLE AS end_s
 FROM w JOIN px_samples s ON w.channel=s.channel AND s.sample>=win*stride AND s.sample<win*stride+size
 WHERE w.session_id IN (SELECT session_id FROM w GROUP BY 1 HAVING count(DISTINCT modality)=2) GROUP BY ALL""",
)
def _(spark, d):
    # Both kinds of device in one recording: even channels are electrodes, odd ones optical.
    s = px.samples(spark, d).withColumn("session_id", F.col("label"))
    s = s.withColumn("device", F.expr("CASE channel % 2 WHEN 0 THEN 'eeg' ELSE 'fnirs' END"))
    keys = ["session_id", "channel"]
    eeg = op.slide(s.where("device = 'eeg'").drop("device"), keys, 16, 8)
    optical = op.slide(s.where("device = 'fnirs'").drop("device"), keys, 8, 4)
    both = op.common_windows([(eeg, "eeg"), (optical, "fnirs")])
    out = both.groupBy("session_id", "channel", "modality", "window").agg(F.avg("x").alias("mean"), F.count(F.lit(1)).alias("n"))
    return rounded(out).selectExpr("*", "window * 0.125D AS start_s", "window * 0.125D + 0.25D AS end_s")


NAMES = {"click": "left button", "error": "fault"}


@query(
    "d17_window_events",
    """SELECT e.session_id, w.time_ms AS start_ms, e.event_id, round((e.client_ms-w.time_ms)/1000.0::DOUBLE,3) AS relative_s, CASE kind WHEN 'click' THEN 'left button' WHEN 'error' THEN 'fault' ELSE 'unknown' END AS description
 FROM px_windows w JOIN px_events e ON w.session_id=e.session_id AND e.client_ms>=w.time_ms AND e.client_ms<w.time_ms+7200000""",
)
def _(spark, d):
    w = px.windows(spark, d).selectExpr("session_id", "time_ms AS start_ms", "time_ms + 7200000 AS end_ms")
    out = op.window_events(w, px.events(spark, d), NAMES, 4 * px.HOUR)
    return rounded(out.select("session_id", "start_ms", "event_id", "relative_s", "description"), 3)


@query(
    "d18_epochs",
    f"""WITH m AS (SELECT session_id, event_id AS marker, client_ms AS marker_ms FROM px_events WHERE kind='signup'),
 c AS (SELECT m.session_id, m.marker, e.client_ms-m.marker_ms AS offset_ms, e.event_id, e.value FROM m JOIN px_events e ON e.session_id=m.session_id AND e.kind<>'signup' AND e.client_ms BETWEEN m.marker_ms-2*{P} AND m.marker_ms+{P}),
 b AS (SELECT session_id, marker, avg(value) AS base FROM c WHERE offset_ms BETWEEN -2*{P} AND 0 GROUP BY 1,2)
 SELECT session_id, marker, event_id, offset_ms, round(value-coalesce(base,0),6) AS value FROM c LEFT JOIN b USING (session_id, marker) WHERE offset_ms BETWEEN 0 AND {P}""",
)
def _(spark, d):
    ev = px.events(spark, d)
    signal = ev.where("kind <> 'signup'").selectExpr("session_id", "event_id", "client_ms AS ts_ms", "value")
    marks = ev.where("kind = 'signup'").selectExpr("session_id", "event_id AS marker", "client_ms AS marker_ms")
    out = op.epochs(signal, marks, 0, P, (-2 * P, 0), P)
    return rounded(out.select("session_id", "marker", "event_id", "offset_ms", "value"))


@query(
    "d20_match_datasets",
    """WITH c AS (SELECT label AS dataset, vec_id%16 AS channel, 64+label AS rate FROM embeddings) SELECT channel, (SELECT min(rate)-0.5::DOUBLE FROM c) AS rate FROM c GROUP BY 1 HAVING count(DISTINCT dataset)=(SELECT count(DISTINCT dataset) FROM c)""",
)
def _(spark, d):
    c = px.table(spark, d, "embeddings").selectExpr("label AS dataset", "vec_id % 16 AS channel", "64 + label AS rate")
    return op.match_all(c)
