"""Signal quality of the recording."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as op
from . import inputs as px
from .registry import query, rounded


@query(
    "f1_channel_stats",
    "SELECT session_id, channel, round(stddev_pop(x),6) AS std, round(max(x)-min(x),6) AS range FROM px_signal GROUP BY 1,2",
)
def _(spark, d):
    return rounded(op.channel_stats(px.signal(spark, d)))


def slide_sql(size: int, step: int) -> str:
    return f"""len AS (SELECT session_id, channel, max(sample)+1 AS n FROM px_signal GROUP BY 1,2), win AS (SELECT session_id, channel, unnest(range(0, greatest(0,(n-{size})//{step}+1))) AS w FROM len WHERE n>={size}),
 sl AS (SELECT s.*, w.w FROM win w JOIN px_signal s ON s.session_id=w.session_id AND s.channel=w.channel AND s.sample>=w.w*{step} AND s.sample<w.w*{step}+{size})"""


@query("f2_sliding_range", f"WITH {slide_sql(40, 8)} SELECT session_id, channel, w*8+20 AS centre, round(max(x)-min(x),6) AS range FROM sl GROUP BY 1,2,3")
def _(spark, d):
    return rounded(op.sliding_range(px.signal(spark, d), 40))


@query(
    "f3_flatline_percent",
    """SELECT session_id, channel, round(avg(CASE WHEN r<=0.35::DOUBLE THEN 1.0::DOUBLE ELSE 0 END)*100,6) AS flat_percent FROM
 (SELECT session_id, channel, sample//16 AS w, max(x)-min(x) AS r FROM px_signal GROUP BY 1,2,3 HAVING count(*)=16) GROUP BY 1,2""",
)
def _(spark, d):
    return rounded(op.flatline_percent(px.signal(spark, d), 16, 0.35))


@query(
    "f4_reject_segments",
    f"""WITH {slide_sql(16, 12)}, seg AS (SELECT session_id, w, median(r) AS r FROM (SELECT session_id, channel, w, max(x)-min(x) AS r FROM sl GROUP BY 1,2,3) GROUP BY 1,2),
 rk AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY r, w) AS k, count(*) OVER (PARTITION BY session_id) AS n FROM seg), ch AS (SELECT * FROM rk WHERE k<=greatest(1, n//2)),
 keep AS (SELECT DISTINCT session_id, unnest(range(w*12, w*12+16)) AS sample FROM ch)
 SELECT session_id, channel, sample, round(x,6) AS x FROM px_signal SEMI JOIN keep USING (session_id, sample)""",
)
def _(spark, d):
    out = op.reject_segments(px.signal(spark, d), 16, 1.0, 0.125, 0.5)
    return rounded(out.select("session_id", "channel", "sample", "x"))


@query(
    "f5_clip_quantiles",
    """SELECT session_id, channel, sample, round(least(greatest(x,lo),hi),6) AS x, x<lo OR x>hi AS clipped FROM px_signal
 JOIN (SELECT session_id, channel, quantile_cont(x,0.01) AS lo, quantile_cont(x,0.99) AS hi FROM px_signal GROUP BY 1,2) USING (session_id, channel)""",
)
def _(spark, d):
    return rounded(op.clip(px.signal(spark, d)).select("session_id", "channel", "sample", "x", "clipped"))


@query(
    "f5_clipped_percent",
    """SELECT session_id, channel, round(avg(CASE WHEN x<lo OR x>hi THEN 1.0::DOUBLE ELSE 0 END)*100,6) AS clipped_percent FROM px_signal
 JOIN (SELECT session_id, channel, quantile_cont(x,0.01) AS lo, quantile_cont(x,0.99) AS hi FROM px_signal GROUP BY 1,2) USING (session_id, channel) GROUP BY 1,2""",
)
def _(spark, d):
    return rounded(op.clipped_percent(op.clip(px.signal(spark, d))))


@query(
    "f6_zscore",
    """SELECT session_id, channel, sample, round(CASE WHEN s>0 THEN (x-m)/s ELSE x-m END,5) AS x FROM px_signal
 JOIN (SELECT session_id, channel, avg(x) AS m, stddev_pop(x) AS s FROM px_signal GROUP BY 1,2) USING (session_id, channel)""",
)
def _(spark, d):
    return rounded(op.zscore(px.signal(spark, d)).select("session_id", "channel", "sample", "x"), 5)


@query(
    "f7_log_offset",
    "SELECT session_id, channel, sample, round(ln(x+CASE WHEN m<=0 THEN abs(m)+0.000001::DOUBLE ELSE 0 END),5) AS x FROM px_signal JOIN (SELECT session_id, min(x) AS m FROM px_signal GROUP BY 1) USING (session_id)",
)
def _(spark, d):
    return rounded(op.log_offset(px.signal(spark, d)).select("session_id", "channel", "sample", "x"), 5)


TRIM = """trim AS (SELECT session_id, channel, stddev_pop(x) AS s FROM (SELECT *, row_number() OVER (PARTITION BY session_id, channel ORDER BY x)-1 AS r, count(*) OVER (PARTITION BY session_id, channel) AS n FROM px_signal)
 WHERE r>=floor(n*0.05::DOUBLE+1e-9) AND r<n-floor(n*0.05::DOUBLE+1e-9) GROUP BY 1,2)"""
MASK = f"""{TRIM}, ch AS (SELECT session_id, channel, max(x)-min(x) AS r, max(sample)+1 AS n FROM px_signal GROUP BY 1,2), wn AS (SELECT *, unnest(range(0,n,4)) AS st FROM ch WHERE r>0.9),
 jump AS (SELECT w.session_id, w.channel, w.st FROM wn w JOIN px_signal s ON s.session_id=w.session_id AND s.channel=w.channel AND s.sample>=w.st AND s.sample<w.st+8 WHERE w.st<w.n-8 GROUP BY ALL HAVING max(x)-min(x)>0.9),
 bad0 AS (SELECT session_id, sample, bool_or(b) AS b FROM (SELECT s.session_id, s.sample, abs(x)>3.5*t.s AS b FROM px_signal s JOIN trim t USING (session_id, channel)
   UNION ALL SELECT session_id, unnest(range(st,st+8)), true FROM jump) GROUP BY 1,2),
 mask AS (SELECT session_id, sample, max(b) OVER (PARTITION BY session_id ORDER BY sample RANGE BETWEEN 4 PRECEDING AND 3 FOLLOWING) AS bad FROM bad0)"""


def mask(spark, d):
    return op.bad_mask(px.signal(spark, d), 3.5, 0.9, 8, 8)


@query("f8_trimmed_std", f"WITH {TRIM} SELECT session_id, channel, round(s,6) AS std FROM trim")
def _(spark, d):
    return rounded(op.trimmed_std(px.signal(spark, d)))


@query("f8_bad_sample_mask", f"WITH {MASK} SELECT session_id, sample, bad FROM mask")
def _(spark, d):
    return mask(spark, d)


@query(
    "f9_active_channels",
    """WITH m AS (SELECT session_id, channel, avg(x) AS m, stddev_pop(x) AS s FROM px_signal GROUP BY 1,2), p AS (SELECT session_id, channel, stddev_pop(least(greatest(x,m-2*s),m+2*s)) AS std FROM px_signal JOIN m USING (session_id, channel) GROUP BY 1,2),
 a AS (SELECT *, std>0.12::DOUBLE AND std>=0.1::DOUBLE AS act FROM p) SELECT session_id, channel, round(std,6) AS std, act OR NOT bool_or(act) OVER (PARTITION BY session_id) AS chosen FROM a""",
)
def _(spark, d):
    return rounded(op.channels_clipped(px.signal(spark, d), 0.12, 0.1, 2.0))


@query(
    "f10_channel_status",
    f"""WITH {MASK}, p AS (SELECT session_id, channel, count(*) AS n, count(*) FILTER (NOT bad) AS g, stddev_pop(x) FILTER (NOT bad) AS s FROM px_signal JOIN mask USING (session_id, sample) GROUP BY 1,2)
 SELECT session_id, channel, round(CASE WHEN g>=n*0.3::DOUBLE THEN s END,6) AS std, CASE WHEN g>=n*0.3::DOUBLE AND s>=0.115 AND s<=0.125 THEN 'good' ELSE 'bad' END AS status,
  CASE WHEN g<n*0.3::DOUBLE THEN 'too many artifacts' WHEN s<0.115 THEN 'flat signal' WHEN s>0.125 THEN 'extreme artifacts' ELSE '' END AS reason FROM p""",
)
def _(spark, d):
    return rounded(op.channel_status(px.signal(spark, d), mask(spark, d), 0.115, 0.125, 0.3))


CORR = """corrs AS (SELECT a.session_id, a.channel AS a, b.channel AS b, corr(a.x,b.x) AS corr FROM px_signal a JOIN px_signal b ON a.session_id=b.session_id AND a.sample=b.sample AND a.channel<b.channel GROUP BY 1,2,3)"""


@query("f11_channel_correlation", f"WITH {CORR} SELECT session_id, a, b, round(corr,6) AS corr FROM corrs")
def _(spark, d):
    return rounded(op.correlations(px.signal(spark, d), 128))


@query("f11_correlated_pairs", f"WITH {CORR} SELECT session_id, a, b, round(corr,6) AS corr FROM corrs WHERE abs(corr)>0.1")
def _(spark, d):
    return rounded(op.correlated_pairs(op.correlations(px.signal(spark, d)), 0.1))


@query(
    "f11_without_duplicates",
    f"WITH {CORR} SELECT DISTINCT s.session_id, s.channel FROM px_signal s WHERE NOT EXISTS (SELECT 1 FROM corrs c WHERE c.session_id=s.session_id AND c.b=s.channel AND abs(corr)>0.12)",
)
def _(spark, d):
    s = px.signal(spark, d)
    return op.without_duplicates(s.select("session_id", "channel").distinct(), op.correlations(s), 0.12)


@query(
    "f12_mutual_information",
    """WITH e AS (SELECT session_id, channel, min(x) AS lo, (max(x)-min(x))/8 AS w FROM px_signal GROUP BY 1,2), b AS (SELECT s.session_id, s.channel, sample, CAST(least(floor((x-lo)/w),7) AS INT) AS b FROM px_signal s JOIN e USING (session_id, channel)),
 j AS (SELECT p.session_id, p.channel AS a, q.channel AS b, p.b AS i, q.b AS jj, count(*) AS n FROM b p JOIN b q ON p.session_id=q.session_id AND p.sample=q.sample AND p.channel<q.channel GROUP BY ALL),
 t AS (SELECT *, sum(n) OVER (PARTITION BY session_id,a,b) AS t, sum(n) OVER (PARTITION BY session_id,a,b,i) AS pa, sum(n) OVER (PARTITION BY session_id,a,b,jj) AS pb FROM j)
 SELECT session_id, a, b, round(sum(n/t::DOUBLE*ln(n*t/(pa*pb)::DOUBLE)),6) AS mi FROM t GROUP BY 1,2,3""",
)
def _(spark, d):
    return rounded(op.mutual_information(px.signal(spark, d), 8, 128))


@query(
    "f13_equal_segments",
    """SELECT session_id, channel, CAST(least(sample//(n//5),4) AS INT) AS segment, count(*) AS n, round(avg(x),6) AS mean FROM px_signal JOIN (SELECT session_id, channel, max(sample)+1 AS n FROM px_signal GROUP BY 1,2) USING (session_id, channel) GROUP BY 1,2,3""",
)
def _(spark, d):
    out = op.equal_segments(px.signal(spark, d), 5)
    return rounded(out.groupBy("session_id", "channel", "segment").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean")))


@query(
    "f14_stability",
    """WITH s AS (SELECT session_id, channel, least(sample//(n//3),2) AS seg, avg(x) AS m, stddev_pop(x) AS s FROM px_signal JOIN (SELECT session_id, channel, max(sample)+1 AS n FROM px_signal GROUP BY 1,2) USING (session_id, channel) GROUP BY 1,2,3),
 l AS (SELECT session_id, channel, abs(m-lag(m) OVER w) AS dm, abs(s-lag(s) OVER w) AS ds FROM s WINDOW w AS (PARTITION BY session_id, channel ORDER BY seg))
 SELECT session_id, channel, round(avg(dm),6) AS mean_change, round(avg(ds),6) AS std_change, avg(dm)>0.01 AS unstable_mean, avg(ds)>0.005 AS unstable_std FROM l GROUP BY 1,2""",
)
def _(spark, d):
    return rounded(op.stability(px.signal(spark, d), 0.01, 0.005))


@query(
    "f16_pick_channels",
    """WITH s AS (SELECT session_id, channel, stddev_pop(x) AS std FROM px_signal GROUP BY 1,2), r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY std, channel)-1 AS r, count(*) OVER (PARTITION BY session_id) AS n FROM s)
 SELECT session_id, channel, round(std,6) AS std FROM r WHERE r>=n-3 OR (r>=n//2-1 AND r<n//2+1) OR r<1""",
)
def _(spark, d):
    return rounded(op.pick_channels(op.channel_stats(px.signal(spark, d)), 6))


def _horner(coefficients: list[float], x: str) -> str:
    out = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out}*{x}+({c!r}::DOUBLE))"
    return out


@query(
    "f17_normal_quantiles",
    f"""WITH r AS (SELECT session_id, channel, x, row_number() OVER (PARTITION BY session_id, channel ORDER BY x, sample) AS rank, count(*) OVER (PARTITION BY session_id, channel) AS n FROM px_signal),
 p AS (SELECT *, CASE WHEN rank=1 THEN 1-pow(0.5::DOUBLE,1.0::DOUBLE/n) WHEN rank=n THEN pow(0.5::DOUBLE,1.0::DOUBLE/n) ELSE (rank-0.3175::DOUBLE)/(n+0.365::DOUBLE) END AS p FROM r),
 q AS (SELECT *, p-0.5::DOUBLE AS q, (p-0.5::DOUBLE)*(p-0.5::DOUBLE) AS q2, sqrt(-2*ln(least(p,1-p))) AS t FROM p)
 SELECT session_id, channel, rank, round(x,6) AS x, round(CASE WHEN least(p,1-p)>={op.TAIL_BELOW}::DOUBLE THEN {_horner(op.MIDDLE[0], 'q2')}*q/{_horner(op.MIDDLE[1], 'q2')}
  ELSE {_horner(op.TAIL[0], 't')}/{_horner(op.TAIL[1], 't')}*CASE WHEN p<0.5 THEN 1 ELSE -1 END END,6) AS normal FROM q""",
)
def _(spark, d):
    return rounded(op.normal_quantiles(px.signal(spark, d), 0.05))


@query("f18_exclude_channels", "SELECT session_id, channel, sample, round(x,6) AS x FROM px_signal WHERE channel NOT IN (3,7,11)")
def _(spark, d):
    return rounded(op.exclude(px.signal(spark, d), [3, 7, 11]).select("session_id", "channel", "sample", "x"))


@query(
    "f18_zero_channels",
    "SELECT session_id, channel, round(sum(CASE WHEN channel IN (3,7,11) THEN 0 ELSE x END),6) AS total FROM px_signal GROUP BY 1,2",
)
def _(spark, d):
    out = op.exclude(px.signal(spark, d), [3, 7, 11], zero=True)
    return rounded(out.groupBy("session_id", "channel").agg(F.sum("x").alias("total")))


@query(
    "f19_finite_check",
    """SELECT CAST(file_id%4 AS BIGINT) AS session_id, count(*) AS n, count(*) FILTER (isnan(value)) AS n_nan, count(*) FILTER (isinf(value)) AS n_inf FROM px_cells GROUP BY 1""",
)
def _(spark, d):
    cells = px.cells(spark, d).selectExpr("file_id % 4 AS session_id", "channel", "value AS x")
    return op.finite_check(cells, cells.select("session_id", "channel").distinct())
