"""Audio chunks and segments on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audio as op
from . import inputs as px
from .registry import query, rounded

IDS = 1_000_000
SAMPLES = "smp AS (SELECT session_id, chunk*64+pos-1 AS sample, CAST(x AS DOUBLE) AS x FROM (SELECT session_id, chunk, unnest(samples) AS x, unnest(range(1,len(samples)+1)) AS pos FROM px_audio))"
WIN = f"{SAMPLES}, w AS (SELECT session_id, sample//160 AS \"window\", avg(x) AS mean, stddev_pop(x) AS std, sqrt(avg(x*x)) AS rms, max(abs(x)) AS max_abs, quantile_cont(abs(x),0.95) AS p95 FROM smp GROUP BY 1,2 HAVING count(*)=160)"
G = "g AS (SELECT session_id, avg(mean) AS mm, stddev_pop(mean) AS sm, avg(std) AS ms, stddev_pop(std) AS ss, avg(rms) AS mr, stddev_pop(rms) AS sr FROM w GROUP BY 1)"
PAIRS = """sx AS (SELECT session_id, event_id, client_ms, row_number() OVER (PARTITION BY session_id ORDER BY event_id) AS n FROM px_events WHERE kind='click'),
 ex AS (SELECT session_id, event_id, client_ms, row_number() OVER (PARTITION BY session_id ORDER BY event_id) AS n FROM px_events WHERE kind='error'),
 hd AS (SELECT session_id, CASE WHEN e.client_ms<s.client_ms THEN 1 ELSE 0 END AS o FROM (SELECT * FROM sx WHERE n=1) s JOIN (SELECT * FROM ex WHERE n=1) e USING (session_id)),
 pr AS (SELECT sx.session_id, sx.n, sx.event_id AS start_id, ex.event_id AS stop_id, sx.client_ms AS start_ms, ex.client_ms AS stop_ms, printf('segment_%02d_%013d_%013d', sx.n, sx.client_ms, ex.client_ms) AS name
   FROM sx JOIN hd USING (session_id) JOIN ex ON ex.session_id=sx.session_id AND ex.n=sx.n+hd.o WHERE (ex.client_ms-sx.client_ms)/1000.0>=0.5)"""


def pairs(spark, d):
    e = px.events(spark, d)
    return op.recording_pairs(e.where("kind = 'click'"), e.where("kind = 'error'"), IDS)


def samples(spark, d):
    return op.samples(px.audio(spark, d))


@query("i1_chunk_samples", f"WITH {SAMPLES} SELECT session_id, sample, round(x,6) AS x FROM smp")
def _(spark, d):
    return rounded(samples(spark, d))


@query(
    "i2_sample_rate",
    """WITH f AS (SELECT session_id, ts_ms-lag(ts_ms) OVER (PARTITION BY session_id ORDER BY chunk) AS g FROM px_audio WHERE chunk<20), a AS (SELECT session_id, round_even(64/(avg(g) FILTER (g>0)/1000),0) AS r FROM f GROUP BY 1)
 SELECT session_id, CAST(arg_min(c, abs(c-r)) AS INT) AS rate FROM a, (SELECT unnest([8000,16000,22050,44100,48000]) AS c) GROUP BY 1""",
)
def _(spark, d):
    return op.sample_rate(px.audio(spark, d), 64)


@query("i3_recording_segments", f"WITH {PAIRS} SELECT session_id, n, start_id, stop_id, start_ms, stop_ms, name FROM pr")
def _(spark, d):
    return pairs(spark, d)


@query(
    "i3_segment_chunks",
    f"WITH {PAIRS} SELECT p.session_id, p.name, count(*) AS n_chunks, min(c.client_ms) AS first_ms, max(c.client_ms) AS last_ms FROM pr p JOIN px_events c ON c.session_id=p.session_id AND c.kind='signup' AND c.client_ms BETWEEN p.start_ms AND p.stop_ms GROUP BY 1,2",
)
def _(spark, d):
    chunks = px.events(spark, d).where("kind = 'signup'").selectExpr("session_id", "event_id AS chunk", "client_ms AS ts_ms")
    out = op.segment_chunks(chunks, pairs(spark, d), px.DAY)
    return out.groupBy("session_id", "name").agg(F.count(F.lit(1)).alias("n_chunks"), F.min("ts_ms").alias("first_ms"), F.max("ts_ms").alias("last_ms"))


@query("i4_window_stats", f"WITH {WIN} SELECT session_id, \"window\", round(mean,6) AS mean, round(std,6) AS std, round(rms,6) AS rms, round(max_abs,6) AS max_abs, round(p95,6) AS p95 FROM w")
def _(spark, d):
    return rounded(op.window_stats(samples(spark, d), 160))


@query(
    "i5_global_stats",
    f"WITH {WIN}, {G} SELECT session_id, round(mm,6) AS mean_of_means, round(sm,6) AS std_of_means, round(ms,6) AS mean_of_stds, round(ss,6) AS std_of_stds, round(mr,6) AS mean_of_rms, round(sr,6) AS std_of_rms FROM g",
)
def _(spark, d):
    return rounded(op.global_stats(op.window_stats(samples(spark, d), 160)))


@query(
    "i6_outlier_windows",
    f"""WITH {WIN}, {G}, z AS (SELECT session_id, "window", abs((mean-mm)/nullif(sm,0)) AS mz, abs((std-ms)/nullif(ss,0)) AS sz, abs((rms-mr)/nullif(sr,0)) AS rz FROM w JOIN g USING (session_id))
 SELECT session_id, "window", round(mz,5) AS mean_z, round(sz,5) AS std_z, round(rz,5) AS rms_z FROM z WHERE greatest(mz,sz,rz)>2""",
)
def _(spark, d):
    out = op.outlier_windows(op.window_stats(samples(spark, d), 160), 2.0)
    return rounded(out.select("session_id", "window", "mean_z", "std_z", "rms_z"), 5)


# Segments of events: every sample is the value of a sign-up inside the segment.
SEG = f"{PAIRS}, seg AS (SELECT p.session_id, p.name, CASE WHEN c.value<20 THEN 0 ELSE c.value END AS x, c.event_id FROM pr p JOIN px_events c ON c.session_id=p.session_id AND c.kind='signup' AND c.client_ms BETWEEN p.start_ms AND p.stop_ms)"


def segment_samples(spark, d):
    chunks = px.events(spark, d).where("kind = 'signup'").selectExpr(
        "session_id", "event_id", "client_ms AS ts_ms", "CASE WHEN value < 20 THEN 0D ELSE value END AS x"
    )
    return op.segment_chunks(chunks, pairs(spark, d), px.DAY).select("session_id", "name", "event_id", "x")


@query(
    "i7_segment_stats",
    f"WITH {SEG} SELECT session_id, name, count(*)/16000.0::DOUBLE AS duration_s, round(avg(x),6) AS mean, round(stddev_pop(x),6) AS std, round(sqrt(avg(x*x)),6) AS rms, round(max(abs(x)),6) AS max_abs, round(avg(CASE WHEN x=0 THEN 1.0::DOUBLE ELSE 0 END)*100,6) AS zero_percent FROM seg GROUP BY 1,2",
)
def _(spark, d):
    out = op.segment_stats(segment_samples(spark, d), 16000)
    return rounded(out, 6, "mean", "std", "rms", "max_abs", "zero_percent")


@query(
    "i8_peak_normalise",
    f"WITH {SEG} SELECT session_id, name, event_id, round(CASE WHEN t>0 THEN x/t ELSE x END,6) AS x FROM (SELECT *, max(abs(x)) OVER (PARTITION BY session_id, name) AS t FROM seg)",
)
def _(spark, d):
    return rounded(op.peak_normalise(segment_samples(spark, d), ["session_id", "name"]))


@query(
    "i9_session_meta",
    """SELECT s.session_id, count(*) FILTER (kind='signup') AS n_words, count(*) FILTER (kind='view') AS n_elements, count(*) FILTER (kind='signup')>0 AS has_words, count(*) FILTER (kind='view')>0 AS has_elements FROM px_events s GROUP BY 1""",
)
def _(spark, d):
    e = px.events(spark, d)
    return op.session_meta(e, {"words": e.where("kind = 'signup'"), "elements": e.where("kind = 'view'")})
