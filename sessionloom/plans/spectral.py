"""Spectra of the recording, taken as 64 Hz and, for line noise, as 128 Hz."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from ..operators import align, quality, recursive
from ..operators import spectral as op
from . import inputs as px
from .quality import slide_sql
from .registry import query, rounded

FS, N = 64.0, 64


def fourier_sql(src: str, keys: str, size: int, step: int, fs: int, taper: bool = False) -> str:
    """Windowed Fourier sums; ``src`` has the keys, w, sample, x."""
    pre = f"*(0.5::DOUBLE-0.5::DOUBLE*cos(2*pi()*i/{size - 1}::DOUBLE))" if taper else ""
    return f"""tap AS (SELECT {keys}, w, i, x{pre} AS x FROM (SELECT *, sample-w*{step} AS i FROM {src})),
 det AS (SELECT {keys}, w, i, (x-avg(x) OVER (PARTITION BY {keys}, w))*(0.5::DOUBLE-0.5::DOUBLE*cos(2*pi()*i/{size}::DOUBLE)) AS y FROM tap),
 ft AS (SELECT {keys}, w, k AS bin, sum(y*cos(2*pi()*((k*i)%{size})/{size}::DOUBLE)) AS re, sum(y*sin(2*pi()*((k*i)%{size})/{size}::DOUBLE)) AS im FROM det, range(0,{size // 2 + 1}) r(k) GROUP BY ALL),
 wp AS (SELECT {keys}, w, bin, bin*{fs / size}::DOUBLE AS freq, (re*re+im*im)/({fs}*{size * 3 / 8}::DOUBLE)*CASE WHEN bin=0 OR bin={size // 2} THEN 1 ELSE 2 END AS power FROM ft)"""


PSD = f"{slide_sql(64, 32)}, {fourier_sql('sl', 'session_id, channel', 64, 32, 64)}, psd AS (SELECT session_id, channel, bin, freq, avg(power) AS power FROM wp GROUP BY ALL)"
WPSD = f"{slide_sql(128, 64)}, {fourier_sql('sl', 'session_id, channel', 128, 64, 128, True)}"


def psd(spark, d):
    return op.psd(px.signal(spark, d), FS, N)


def wpsd(spark, d):
    return op.window_psd(px.signal(spark, d), 128.0, 1.0, 0.5)


def filter_sql(pad: int, gain: str, bands: str) -> str:
    """The whole channel with reflected ends, transformed, weighted and transformed back.

    ``bands`` lists (band, lo, hi); ``gain`` is an expression of w, lo and hi.
    """
    return f"""whole AS (SELECT session_id, channel, list(x ORDER BY sample) AS l, count(*) AS n, least({pad}, count(*)-1) AS p FROM px_signal GROUP BY 1,2),
 ext AS (SELECT session_id, channel, n, p, n+2*p AS nn, q, CASE WHEN q<p THEN 2*l[1]-l[p-q+1] WHEN q<p+n THEN l[q-p+1] ELSE 2*l[n]-l[n-1-(q-p-n)] END AS y FROM (SELECT *, unnest(range(0,n+2*p)) AS q FROM whole)),
 fw AS (SELECT session_id, channel, n, p, nn, k, sum(y*cos(2*pi()*((k*q)%nn)/nn::DOUBLE)) AS re, sum(y*sin(2*pi()*((k*q)%nn)/nn::DOUBLE)) AS im FROM (SELECT *, unnest(range(0,nn//2+1)) AS k FROM ext) GROUP BY ALL),
 wt AS (SELECT *, 2*pi()*k/nn::DOUBLE AS w, CASE WHEN k=0 OR 2*k=nn THEN 1 ELSE 2 END AS c FROM fw, (VALUES {bands}) b(band,lo,hi)),
 gn AS (SELECT *, CASE WHEN k=0 AND lo<hi THEN 0 ELSE {gain} END AS g FROM wt),
 flt AS (SELECT session_id, channel, band, q-p AS sample, sum(c*g*(re*cos(2*pi()*((k*q)%nn)/nn::DOUBLE)+im*sin(2*pi()*((k*q)%nn)/nn::DOUBLE)))/any_value(nn) AS x
   FROM (SELECT *, unnest(range(p,p+n)) AS q FROM gn) GROUP BY session_id, channel, band, q, p)"""


_A, _B = (f"tan(pi()*{v}/64)" for v in ("lo", "hi"))
BUTTER = f"1/(1+power((tan(w/2)*tan(w/2)-{_A}*{_B})/(({_B}-{_A})*tan(w/2)),8))"
NOTCH = "power(cos(w)-cos(2*pi()*lo/64),2)/(power(cos(w)-cos(2*pi()*lo/64),2)+power(tan(2*pi()*lo/64/5/2)*sin(w),2))"
BANDPASS = filter_sql(128, BUTTER, "('band',5.0,20.0)")
NOTCHED = filter_sql(160, NOTCH, "('notch',20.0,20.0)")
BANK = {"low": (4.0, 8.0), "mid": (8.0, 13.0), "high": (13.0, 30.0)}
BANKED = filter_sql(160, BUTTER, ", ".join(f"('{b}',{lo},{hi})" for b, (lo, hi) in BANK.items()))


@query("e1_bandpass", f"WITH {BANDPASS} SELECT session_id, channel, sample, round(x,6)+0.0 AS x FROM flt")
def _(spark, d):
    return rounded(op.bandpass(px.signal(spark, d), 5.0, 20.0, FS))


@query("e2_notch", f"WITH {NOTCHED} SELECT session_id, channel, sample, round(x,6)+0.0 AS x FROM flt")
def _(spark, d):
    return rounded(op.notch(px.signal(spark, d), 20.0, FS, 5.0))


def recursion_sql(filters: dict[str, recursive.Filter]) -> str:
    """CTEs down to ``flt``: the plain recursion, sample by sample, forward and back over the reflected signal."""
    number = lambda v: f"({float(v):.17e})"
    ctes, out = ["whole AS (SELECT session_id, channel, list(x ORDER BY sample) AS l, count(*) AS n FROM px_signal GROUP BY 1,2)"], []
    for k, (band, (zeros, poles, gain)) in enumerate(filters.items()):
        b, a = gain * np.real(np.poly(zeros)), np.real(np.poly(poles))
        n, step = len(poles), np.eye(len(poles), k=1)
        step[:, 0] -= a[1:]
        rest = np.linalg.solve(np.eye(n) - step, b[1:] - a[1:] * b[0])
        z = [f"z{i}" for i in range(1, n + 1)]
        first = ", ".join(f"{number(v)}*x AS {c}" for v, c in zip(rest, z, strict=True))
        y = f"({number(b[0])}*e.x+f.z1)"
        after = ", ".join(f"{'f.z%d+' % (i + 1) if i < n else ''}{number(b[i])}*e.x-{number(a[i])}*{y} AS z{i}" for i in range(1, n + 1))

        def run(name, src):
            return f"""{name} AS (SELECT session_id, channel, n, p, CAST(-1 AS BIGINT) AS t, x AS y, {first} FROM {src} WHERE t=0
 UNION ALL SELECT f.session_id, f.channel, f.n, f.p, e.t, {y} AS y, {after} FROM {name} f JOIN {src} e ON e.session_id=f.session_id AND e.channel=f.channel AND e.t=f.t+1)"""  # noqa: B023

        ctes += [
            f"""ext{k} AS MATERIALIZED (SELECT session_id, channel, n, p, q AS t, CASE WHEN q<p THEN 2*l[1]-l[p-q+1] WHEN q<p+n THEN l[q-p+1] ELSE 2*l[n]-l[n-1-(q-p-n)] END AS x
 FROM (SELECT *, unnest(range(0,n+2*p)) AS q FROM (SELECT *, least({3 * (n + 1)}, n-1) AS p FROM whole)))""",
            run(f"fwd{k}", f"ext{k}"),
            f"rev{k} AS MATERIALIZED (SELECT session_id, channel, n, p, n+2*p-1-t AS t, y AS x FROM fwd{k} WHERE t>=0)",
            run(f"bwd{k}", f"rev{k}"),
        ]
        out.append(f"SELECT session_id, channel, '{band}' AS band, n+p-1-t AS sample, y AS x FROM bwd{k} WHERE t>=p AND t<n+p")
    return ", ".join([*ctes, f"flt AS ({' UNION ALL '.join(out)})"])


RECURSIVE = {"e1_recursive_bandpass": {"band": recursive.butterworth(5.0, 20.0, FS)}, "e2_recursive_notch": {"notch": recursive.notch_filter(20.0, FS, 5.0)},
             "d19_recursive_bank": {n: recursive.butterworth(lo, hi, FS) for n, (lo, hi) in BANK.items()}}


def _recursive(name, filters):
    @query(name, f"WITH RECURSIVE {recursion_sql(filters)} SELECT session_id, channel, band, sample, round(x,5)+0.0 AS x FROM flt")
    def _(spark, d):
        return rounded(recursive.forward_back(px.signal(spark, d), filters), 5)


for _name, _filters in RECURSIVE.items():
    _recursive(_name, _filters)


@query("e3_welch_psd", f"WITH {PSD} SELECT session_id, channel, bin, round(freq,6) AS freq, round(power,7) AS power FROM psd")
def _(spark, d):
    return rounded(rounded(psd(spark, d), 6, "freq"), 7, "power").withColumn("bin", F.col("bin").cast("long"))


NOISE = """nz AS (SELECT session_id, channel, w, sum(power) FILTER (freq BETWEEN 59 AND 61) AS lp, sum(power) AS tp FROM wp GROUP BY 1,2,3)"""


@query(
    "e4_line_noise",
    f"""WITH {WPSD}, {NOISE} SELECT session_id, channel, round(avg(lp/tp),6) AS ratio_avg, round(max(lp/tp),6) AS ratio_max, round(min(lp/tp),6) AS ratio_min, round(stddev_pop(lp/tp),6) AS ratio_std, count(*) AS n_windows,
 round(avg(lp),6) AS avg_line_power, round(avg(tp),6) AS avg_total_power FROM nz GROUP BY 1,2""",
)
def _(spark, d):
    return rounded(op.line_noise(wpsd(spark, d)))


@query(
    "e5_binned_spectrum",
    f"""WITH {WPSD}, b AS (SELECT session_id, channel, w, CAST(floor(freq/2) AS BIGINT) AS fbin, avg(power) AS p FROM wp WHERE freq<64 GROUP BY 1,2,3,4), c AS (SELECT session_id, channel, fbin, avg(p) AS p FROM b GROUP BY 1,2,3)
 SELECT session_id, fbin, fbin*2.0::DOUBLE+1 AS centre, round(avg(p),7) AS power FROM c GROUP BY 1,2""",
)
def _(spark, d):
    return rounded(op.binned_spectrum(op.binned_channels(wpsd(spark, d), 128.0)), 7)


BAND_SQL = "(VALUES ('delta',1,4),('theta',4,8),('alpha',8,13),('beta',13,30),('gamma',30,45)) b(band,lo,hi)"


@query(
    "e6_band_power",
    f"WITH {PSD} SELECT session_id, channel, band, round(sum(power),6) AS power FROM psd, {BAND_SQL} WHERE freq>=lo AND freq<hi GROUP BY 1,2,3",
)
def _(spark, d):
    return rounded(op.band_power(psd(spark, d), op.K))


@query(
    "e6_band_power_mean",
    f"WITH {PSD} SELECT session_id, channel, band, round(avg(power),6) AS power FROM psd, {BAND_SQL} WHERE freq>=lo AND freq<=hi GROUP BY 1,2,3",
)
def _(spark, d):
    return rounded(op.band_power(psd(spark, d), op.K, closed=True, mean=True))


@query(
    "e7_peak_frequency",
    f"""WITH {PSD}, p AS (SELECT * FROM psd WHERE freq BETWEEN 0.5 AND 100) SELECT session_id, channel, arg_max(freq,power) AS peak_freq, round(max(power),6) AS peak_power,
 arg_max(freq,power) FILTER (freq BETWEEN 8 AND 13) AS alpha_freq, round(max(power) FILTER (freq BETWEEN 8 AND 13),6) AS alpha_power FROM p GROUP BY 1,2""",
)
def _(spark, d):
    return rounded(op.peaks(psd(spark, d), op.K))


LINE = """ll AS (SELECT *, log10(freq) AS lf, log10(CASE WHEN power<=0 THEN 1e-20 ELSE power END) AS lp FROM psd WHERE freq BETWEEN 1 AND 45),
 line AS (SELECT {k}, -regr_slope(lp,lf) AS exponent, regr_intercept(lp,lf) AS off, regr_r2(lp,lf) AS r2 FROM ll GROUP BY ALL)"""


@query(
    "e8_aperiodic_line",
    f"WITH {PSD}, {LINE.format(k='session_id, channel')} SELECT session_id, channel, round(exponent,5) AS exponent, round(off,5) AS \"offset\", round(r2,5) AS r2 FROM line",
)
def _(spark, d):
    return rounded(op.aperiodic(psd(spark, d), op.K), 5)


@query(
    "e8_periodic_part",
    f"WITH {PSD}, {LINE.format(k='session_id, channel')} SELECT session_id, channel, freq, round(lp-(off-exponent*lf),5) AS residual FROM ll JOIN line USING (session_id, channel)",
)
def _(spark, d):
    p = psd(spark, d)
    return rounded(op.periodic(p, op.aperiodic(p, op.K), op.K).select("session_id", "channel", "freq", "residual"), 5)


SEGMENTED = f"""seg AS (SELECT session_id, channel, CAST(least(sample//(n//2),1) AS INT) AS segment, sample-least(sample//(n//2),1)*(n//2) AS sample, x FROM px_signal JOIN (SELECT session_id, channel, max(sample)+1 AS n FROM px_signal GROUP BY 1,2) USING (session_id, channel)),
 len AS (SELECT session_id, channel, segment, max(sample)+1 AS n FROM seg GROUP BY 1,2,3), win AS (SELECT session_id, channel, segment, unnest(range(0,(n-64)//32+1)) AS w FROM len WHERE n>=64),
 sl AS (SELECT s.*, w.w FROM win w JOIN seg s ON s.session_id=w.session_id AND s.channel=w.channel AND s.segment=w.segment AND s.sample>=w.w*32 AND s.sample<w.w*32+64),
 {fourier_sql('sl', 'session_id, channel, segment', 64, 32, 64)}, psd AS (SELECT session_id, channel, segment, bin, freq, avg(power) AS power FROM wp GROUP BY ALL)"""


@query(
    "e9_band_summary",
    f"""WITH {SEGMENTED}, {LINE.format(k='session_id, channel, segment')}, res AS (SELECT ll.*, lp-(off-exponent*lf) AS r, exponent, off, r2 FROM ll JOIN line USING (session_id, channel, segment)),
 per AS (SELECT session_id, segment, channel, band, sum(power) AS p, max(r) AS pk, max(exponent) AS e, max(off) AS o, max(r2) AS r2 FROM res, {BAND_SQL} WHERE freq>=lo AND freq<=hi GROUP BY 1,2,3,4)
 SELECT session_id, segment, band, round(avg(p),5) AS mean_power, round(avg(CASE WHEN pk>0.05 THEN 1.0::DOUBLE ELSE 0 END),5) AS peak_rate, round(avg(e),5) AS mean_exponent, round(avg(o),5) AS mean_offset, round(avg(r2),5) AS mean_r2 FROM per GROUP BY 1,2,3""",
)
def _(spark, d):
    keys = ["session_id", "channel", "segment"]
    s = quality.equal_segments(px.signal(spark, d), 2)
    first = s.groupBy(*keys).agg(F.min("sample").alias("s0"))
    s = align.attach(s, first, keys).withColumn("sample", F.col("sample") - F.col("s0"))
    return rounded(op.band_summary(op.psd(s, FS, N, keys), keys, ["session_id", "segment"]), 5)


def renamed(ctes: str, names: list[str], suffix: str) -> str:
    """A second copy of a chain of CTEs under other names."""
    for n in names:
        ctes = re.sub(rf"\b{n}\b(?= AS \()|(?<=FROM ){n}\b", n + suffix, ctes)
    return ctes


BEFORE = renamed(PSD, ["len", "win", "sl", "tap", "det", "ft", "wp", "psd"], "0")
GAIN = f"""{BANDPASS}, {BEFORE}, {PSD.replace('px_signal', 'flt')},
 z AS (SELECT session_id, channel, CASE WHEN b.freq<5 THEN 'below' WHEN b.freq<=20 THEN 'inside' ELSE 'above' END AS zone, b.power AS b, a.power AS a FROM psd0 b JOIN psd a USING (session_id, channel, bin))"""


@query("e10_filter_gain", f"WITH {GAIN} SELECT session_id, channel, zone, round(sum(b),5) AS before, round(sum(a),5) AS after, round(sum(a)/sum(b),5) AS gain FROM z GROUP BY 1,2,3")
def _(spark, d):
    s = px.signal(spark, d)
    after = op.bandpass(s, 5.0, 20.0, FS)
    return rounded(op.filter_gain(op.psd(s, FS, N), op.psd(after, FS, N), 5.0, 20.0), 5)


@query(
    "d19_filter_bank",
    f"WITH {BANKED} SELECT session_id, channel, band, sample, round(x,5)+0.0 AS x FROM flt",
)
def _(spark, d):
    return rounded(op.filter_bank(px.signal(spark, d), BANK, FS), 5)


@query(
    "f15_window_metrics",
    f"""WITH {slide_sql(128, 128)}, {fourier_sql('sl', 'session_id, channel', 128, 128, 128, True)}, m AS (SELECT session_id, channel, w, avg(x) AS mean, stddev_pop(x) AS std, kurtosis_pop(x) AS kurtosis FROM sl GROUP BY 1,2,3),
 r AS (SELECT session_id, channel, w, sum(power) FILTER (freq BETWEEN 49 AND 51)/sum(power) AS r50, sum(power) FILTER (freq BETWEEN 59 AND 61)/sum(power) AS r60 FROM wp GROUP BY 1,2,3)
 SELECT session_id, channel, w AS "window", round(mean,6) AS mean, round(std,6) AS std, round(kurtosis,5) AS kurtosis, round(r50,6) AS ratio_50, round(r60,6) AS ratio_60 FROM m JOIN r USING (session_id, channel, w)""",
)
def _(spark, d):
    s = px.signal(spark, d)
    rows = op.window_psd(s, 128.0, 1.0, 1.0)
    keys = [*op.K, "window"]
    r50 = op.line_ratio(rows, keys, 50.0).select(*keys, F.col("ratio").alias("ratio_50"))
    r60 = op.line_ratio(rows, keys, 60.0).select(*keys, F.col("ratio").alias("ratio_60"))
    out = quality.window_metrics(s, 128).join(r50, keys).join(r60, keys)
    return rounded(rounded(out, 5, "kurtosis"), 6, "mean", "std", "ratio_50", "ratio_60")
