"""Spectra and zero-phase filters.

A spectrum is an average over short windows, so the signal is cut into windows
first: a window is a bounded array, the transform is vectorised over batches
of windows, and long channels spread over many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import attach
from .align import slide

K = ["session_id", "channel"]

# Frequency bands in Hz.
BANDS = {"delta": (1, 4), "theta": (4, 8), "alpha": (8, 13), "beta": (13, 30), "gamma": (30, 45)}
ALPHA = (8, 13)


def window_signals(samples: DataFrame, keys: list[str], size: int, stride: int) -> DataFrame:
    """Complete windows as arrays of ``size`` values in sample order."""
    parts = F.sort_array(F.collect_list(F.struct("sample", "x")))
    return (
        slide(samples.select(*keys, "sample", "x"), keys, size, stride)
        .groupBy(*keys, "window")
        .agg(parts.alias("p"))
        .where(F.size("p") == size)
        .select(*keys, "window", F.transform("p", lambda s: s["x"]).alias("signal"))
    )


def welch(signal: Column, fs: float, nperseg: int, taper: bool = False) -> Column:
    """One-sided power density of each array: periodic Hann, half overlap, mean removed.

    ``taper`` first multiplies the whole array with a symmetric Hann window.
    """

    @F.pandas_udf("array<double>")
    def density(arrays: pd.Series) -> pd.Series:
        if arrays.empty:
            return arrays
        x = np.stack(arrays.to_numpy())
        if taper:
            x = x * np.hanning(x.shape[1])
        hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(nperseg) / nperseg)
        starts = range(0, x.shape[1] - nperseg + 1, max(nperseg // 2, 1))
        seg = np.stack([x[:, s : s + nperseg] for s in starts], axis=1)
        seg = (seg - seg.mean(axis=2, keepdims=True)) * hann
        p = np.abs(np.fft.rfft(seg, axis=2)) ** 2 / (fs * (hann**2).sum())
        p[:, :, 1 : (-1 if nperseg % 2 == 0 else None)] *= 2
        return pd.Series(list(p.mean(axis=1)))

    return density(signal)


def by_frequency(windows: DataFrame, keys: list[str], fs: float, nperseg: int, psd: str = "psd") -> DataFrame:
    """One row per frequency of a density array."""
    return windows.select(*keys, F.posexplode(psd).alias("bin", "power")).withColumn("freq", F.col("bin") * F.lit(fs / nperseg))


def psd(samples: DataFrame, fs: float, nperseg: int, keys: list[str] | None = None) -> DataFrame:
    """Welch density per key and frequency."""
    keys = keys or K
    windows = window_signals(samples, keys, nperseg, max(nperseg // 2, 1)).withColumn("psd", welch(F.col("signal"), fs, nperseg))
    return by_frequency(windows, keys, fs, nperseg).groupBy(*keys, "bin", "freq").agg(F.avg("power").alias("power"))


def window_psd(samples: DataFrame, fs: float, seconds: float, step: float) -> DataFrame:
    """Density of sliding windows, tapered as a whole, per channel and window."""
    size = int(seconds * fs)
    nperseg = max(2, min(int(2 * fs), size))
    windows = window_signals(samples, K, size, max(1, int(step * fs)))
    return by_frequency(windows.withColumn("psd", welch(F.col("signal"), fs, nperseg, taper=True)), [*K, "window"], fs, nperseg)


def line_ratio(psd_rows: DataFrame, keys: list[str], line: float = 60.0, half: float = 1.0) -> DataFrame:
    """Power around a line frequency over total power; no row without power."""
    near = F.col("freq").between(line - half, line + half)
    return (
        psd_rows.groupBy(*keys)
        .agg(F.sum(F.when(near, F.col("power"))).alias("line_power"), F.sum("power").alias("total_power"))
        .where("line_power IS NOT NULL AND total_power > 0")
        .withColumn("ratio", F.col("line_power") / F.col("total_power"))
    )


def line_noise(psd_rows: DataFrame, line: float = 60.0) -> DataFrame:
    """Line ratio per channel over its windows."""
    return line_ratio(psd_rows, [*K, "window"], line).groupBy(*K).agg(
        F.avg("ratio").alias("ratio_avg"),
        F.max("ratio").alias("ratio_max"),
        F.min("ratio").alias("ratio_min"),
        F.stddev_pop("ratio").alias("ratio_std"),
        F.count(F.lit(1)).alias("n_windows"),
        F.avg("line_power").alias("avg_line_power"),
        F.avg("total_power").alias("avg_total_power"),
    )


def binned_channels(psd_rows: DataFrame, fs: float, width: float = 2.0, top: float = 200.0) -> DataFrame:
    """Mean power per frequency bin and window, averaged over the windows of a channel."""
    limit = min(top, fs / 2)
    per = (
        psd_rows.where(F.col("freq") < np.ceil(limit / width) * width)
        .groupBy(*K, "window", F.floor(F.col("freq") / width).cast("long").alias("fbin"))
        .agg(F.avg("power").alias("p"))
    )
    return per.groupBy(*K, "fbin").agg(F.avg("p").alias("power")).withColumn("centre", F.col("fbin") * F.lit(width) + F.lit(width / 2))


def binned_spectrum(channels: DataFrame) -> DataFrame:
    """The channel spectra averaged per session."""
    return channels.groupBy("session_id", "fbin", "centre").agg(F.avg("power").alias("power"))


def band_rows(psd_rows: DataFrame, bands: dict[str, tuple[float, float]], closed: bool = False) -> DataFrame:
    """Copy each frequency to the bands that hold it: [low, high) or [low, high]."""
    table = F.array(*[F.struct(F.lit(n).alias("band"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi")) for n, (lo, hi) in bands.items()])
    below = (lambda b: F.col("freq") <= b["hi"]) if closed else (lambda b: F.col("freq") < b["hi"])
    inside = F.filter(table, lambda b: (F.col("freq") >= b["lo"]) & below(b))
    return psd_rows.withColumn("__b", F.explode(inside)).withColumn("band", F.col("__b.band")).drop("__b")


def band_power(
    psd_rows: DataFrame, keys: list[str], bands: dict[str, tuple[float, float]] | None = None, closed: bool = False, mean: bool = False
) -> DataFrame:
    """Summed (or mean) power per band."""
    agg = F.avg("power") if mean else F.sum("power")
    return band_rows(psd_rows, bands or BANDS, closed).groupBy(*keys, "band").agg(agg.alias("power"))


def peaks(psd_rows: DataFrame, keys: list[str], low: float = 0.5, high: float = 100.0) -> DataFrame:
    """Strongest frequency overall and inside the alpha band (lowest on ties)."""
    rank = F.struct("power", (-F.col("freq")).alias("f"))
    alpha = F.col("freq").between(*ALPHA)
    return psd_rows.where(F.col("freq").between(low, high)).groupBy(*keys).agg(
        F.max_by("freq", rank).alias("peak_freq"),
        F.max("power").alias("peak_power"),
        F.max_by("freq", F.when(alpha, rank)).alias("alpha_freq"),
        F.max(F.when(alpha, F.col("power"))).alias("alpha_power"),
    )


def _loglog(psd_rows: DataFrame, low: float, high: float) -> DataFrame:
    p = F.when(F.isnan("power") | (F.abs("power") == float("inf")) | (F.col("power") <= 0), F.lit(1e-20)).otherwise(F.col("power"))
    return psd_rows.where(F.col("freq").between(low, high) & (F.col("freq") > 0)).withColumn("lf", F.log10("freq")).withColumn("lp", F.log10(p))


def aperiodic(psd_rows: DataFrame, keys: list[str], low: float = 1.0, high: float = 45.0) -> DataFrame:
    """The 1/f line of a spectrum: log10 power = offset - exponent * log10 frequency."""
    return (
        _loglog(psd_rows, low, high)
        .groupBy(*keys)
        .agg((-F.regr_slope("lp", "lf")).alias("exponent"), F.regr_intercept("lp", "lf").alias("offset"), F.regr_r2("lp", "lf").alias("r2"))
    )


def periodic(psd_rows: DataFrame, line: DataFrame, keys: list[str], low: float = 1.0, high: float = 45.0) -> DataFrame:
    """What a spectrum has above its 1/f line, in log10 units per frequency."""
    rows = attach(_loglog(psd_rows, low, high), line, keys)
    return rows.withColumn("residual", F.col("lp") - (F.col("offset") - F.col("exponent") * F.col("lf"))).select(*keys, "freq", "power", "residual")


def band_summary(psd_rows: DataFrame, keys: list[str], group: list[str], least_peak: float = 0.05) -> DataFrame:
    """Per group and band over channels: mean power, share with a peak, mean 1/f line."""
    line = aperiodic(psd_rows, keys)
    per = (
        band_rows(periodic(psd_rows, line, keys), BANDS, closed=True)
        .groupBy(*keys, "band")
        .agg(F.sum("power").alias("power"), F.max("residual").alias("peak"))
    )
    return (
        per.join(line, keys)
        .groupBy(*group, "band")
        .agg(
            F.avg("power").alias("mean_power"),
            F.avg((F.col("peak") > least_peak).cast("double")).alias("peak_rate"),
            F.avg("exponent").alias("mean_exponent"),
            F.avg("offset").alias("mean_offset"),
            F.avg("r2").alias("mean_r2"),
        )
    )


# --- zero-phase filters -----------------------------------------------------


def bandpass_gain(fs: float, order: int = 4):
    """Squared magnitude of the digital Butterworth band-pass, as run forward and back."""

    def gain(w: np.ndarray, lo: float, hi: float) -> np.ndarray:
        a, b = np.tan(np.pi * lo / fs), np.tan(np.pi * hi / fs)
        with np.errstate(divide="ignore", over="ignore"):
            t = np.tan(w / 2)
            ratio = (t * t - a * b) / ((b - a) * t)
            return np.nan_to_num(1.0 / (1.0 + ratio ** (2 * order)))

    return gain


def notch_gain(fs: float, q: float = 30.0):
    """Squared magnitude of the second-order notch, as run forward and back."""

    def gain(w: np.ndarray, lo: float, _hi: float) -> np.ndarray:
        w0 = 2 * np.pi * lo / fs
        beta = np.tan(w0 / q / 2)
        c = (np.cos(w) - np.cos(w0)) ** 2
        return c / (c + (beta * np.sin(w)) ** 2)

    return gain


def _filtered(gain):
    @F.pandas_udf("array<double>")
    def run(signal: pd.Series, lo: pd.Series, hi: pd.Series, pad_left: pd.Series, pad_right: pd.Series) -> pd.Series:
        out = []
        for x, a, b, left, right in zip(signal, lo, hi, pad_left, pad_right):
            # odd reflection where the channel ends
            head = 2 * x[0] - x[left:0:-1] if left else x[:0]
            tail = 2 * x[-1] - x[-2 : -right - 2 : -1] if right else x[:0]
            y = np.concatenate([head, x, tail])
            w = 2 * np.pi * np.arange(len(y) // 2 + 1) / len(y)
            y = np.fft.irfft(np.fft.rfft(y) * gain(w, a, b), len(y))
            out.append(y[len(head) : len(head) + len(x)])
        return pd.Series(out)

    return run


def apply_filter(samples: DataFrame, gain, bands: dict[str, tuple[float, float]], block: int, halo: int) -> DataFrame:
    """Filter each channel in blocks, once per band.

    A block is filtered together with ``halo`` samples on both sides, long
    enough for the response to die away, and only its own samples are kept.
    """
    s = F.col("sample")
    own = F.floor(s / block).cast("long")
    reach = F.sequence(F.greatest(F.floor((s - halo) / block), F.lit(0)).cast("long"), F.floor((s + halo) / block).cast("long"))
    length = samples.groupBy(*K).agg((F.max("sample") + 1).alias("__n"))
    parts = F.sort_array(F.collect_list(F.struct("sample", "x")))
    blocks = (
        attach(samples.select(*K, "sample", "x"), length, K)
        .withColumn("__block", F.explode(reach))
        .where(F.col("__block") * block < F.col("__n"))
        .groupBy(*K, "__n", "__block")
        .agg(parts.alias("p"))
    )
    table = F.array(*[F.struct(F.lit(n).alias("band"), F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi")) for n, (a, b) in bands.items()])
    first, last = F.col("p")[0]["sample"], F.element_at("p", -1)["sample"]
    room = F.least(F.lit(halo), F.size("p") - 1)
    done = (
        blocks.withColumn("b", F.explode(table))
        .withColumn("first", first)
        .withColumn(
            "y",
            _filtered(gain)(
                F.transform("p", lambda v: v["x"]),
                F.col("b.lo"),
                F.col("b.hi"),
                F.when(first == 0, room).otherwise(F.lit(0)),
                F.when(last == F.col("__n") - 1, room).otherwise(F.lit(0)),
            ),
        )
    )
    return (
        done.select(*K, F.col("b.band").alias("band"), "__block", "first", F.posexplode("y").alias("pos", "x"))
        .withColumn("sample", F.col("first") + F.col("pos"))
        .where(F.floor(F.col("sample") / block) == F.col("__block"))
        .select(*K, "band", "sample", "x")
    )


def bandpass(samples: DataFrame, lo: float, hi: float, fs: float, order: int = 4, block: int = 60_000, halo: int | None = None) -> DataFrame:
    halo = halo or int(np.ceil(10.0 * fs / lo))
    return apply_filter(samples, bandpass_gain(fs, order), {"band": (lo, hi)}, block, halo).drop("band")


def notch(samples: DataFrame, line: float, fs: float, q: float = 30.0, block: int = 60_000, halo: int | None = None) -> DataFrame:
    halo = halo or int(np.ceil(10.0 * fs * q / line))
    return apply_filter(samples, notch_gain(fs, q), {"notch": (line, line)}, block, halo).drop("band")


def filter_bank(samples: DataFrame, bands: dict[str, tuple[float, float]], fs: float, order: int = 4, block: int = 60_000) -> DataFrame:
    """The signal under several bands, with the band as a column."""
    lowest = min(lo for lo, _ in bands.values())
    return apply_filter(samples, bandpass_gain(fs, order), bands, block, int(np.ceil(10.0 * fs / lowest)))


def filter_gain(before: DataFrame, after: DataFrame, lo: float, hi: float) -> DataFrame:
    """Power after over before, below, inside and above a band."""
    zone = F.when(F.col("freq") < lo, "below").when(F.col("freq") <= hi, "inside").otherwise("above")
    total = lambda df, n: df.groupBy(*K, zone.alias("zone")).agg(F.sum("power").alias(n))
    return total(before, "before").join(total(after, "after"), [*K, "zone"]).withColumn("gain", F.try_divide("after", "before"))
