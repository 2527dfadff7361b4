"""Audio chunks: samples, rate, recording segments, statistics.

Chunks come as (session_id, chunk, ts_ms, samples[]).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import attach, points_in_intervals
from ..functions.ordered import first_k, over_slices

S = ["session_id"]

# Usual sample rates, and the one assumed without timing.
RATES = [8000, 16000, 22050, 44100, 48000]
DEFAULT_RATE = 16000


def samples(chunks: DataFrame) -> DataFrame:
    """One row per sample with its number in the session (chunks of equal length)."""
    return chunks.select(*S, "chunk", F.size("samples").alias("__n"), F.posexplode("samples").alias("pos", "x")).select(
        *S, (F.col("chunk") * F.col("__n") + F.col("pos")).alias("sample"), F.col("x").cast("double").alias("x")
    )


def sample_rate(chunks: DataFrame, samples_per_chunk: int = 4096, first: int = 20) -> DataFrame:
    """Usual rate nearest to the mean positive gap of the first chunks."""
    w = Window.partitionBy(*S).orderBy("chunk")  # at most ``first`` rows
    few = first_k(chunks.select(*S, "chunk", "ts_ms"), S, ["chunk"], first, "__r")
    gap = F.col("ts_ms") - F.lag("ts_ms").over(w)
    mean = few.withColumn("gap", gap).groupBy(*S).agg(F.avg(F.when(F.col("gap") > 0, F.col("gap"))).alias("gap_ms"))
    guess = F.rint(F.lit(float(samples_per_chunk)) / (F.col("gap_ms") / 1000.0))
    near = F.array_min(F.array(*[F.struct(F.abs(guess - r).alias("d"), F.lit(i).alias("i"), F.lit(r).alias("rate")) for i, r in enumerate(RATES)]))
    return mean.select(*S, F.when(F.col("gap_ms").isNull(), F.lit(DEFAULT_RATE)).otherwise(near["rate"]).alias("rate"))


def recording_pairs(starts: DataFrame, stops: DataFrame, width: float, min_seconds: float = 0.5) -> DataFrame:
    """The i-th start with the i-th stop of a session, after dropping a leading orphan stop.

    Both sides have session_id, event_id, client_ms in source order of event_id.
    """
    numbered = lambda df, n: over_slices(df.select(*S, "event_id", "client_ms"), S, ["event_id"], width, rank=n)
    heads = starts.groupBy(*S).agg(F.min_by("client_ms", "event_id").alias("__s0")).join(
        stops.groupBy(*S).agg(F.min_by("client_ms", "event_id").alias("__e0")), S
    )
    orphan = F.when(F.col("__e0") < F.col("__s0"), 1).otherwise(0)
    e = attach(numbered(stops, "n"), heads, S).select(
        *S, (F.col("n") - orphan).alias("n"), F.col("event_id").alias("stop_id"), F.col("client_ms").alias("stop_ms")
    )
    s = numbered(starts, "n").select(*S, "n", F.col("event_id").alias("start_id"), F.col("client_ms").alias("start_ms"))
    return (
        s.join(e, [*S, "n"])
        .where((F.col("stop_ms") - F.col("start_ms")) / 1000.0 >= min_seconds)
        .withColumn("name", F.format_string("segment_%02d_%013d_%013d", "n", "start_ms", "stop_ms"))
    )


def segment_chunks(chunks: DataFrame, segments: DataFrame, width: float) -> DataFrame:
    """Chunks with ``start <= ts <= stop`` of each segment; empty segments drop out."""
    return points_in_intervals(chunks, segments, S, "ts_ms", "start_ms", "stop_ms", width)


def _stats(x: str = "x") -> list[Column]:
    c = F.col(x)
    return [
        F.avg(c).alias("mean"),
        F.stddev_pop(c).alias("std"),
        F.sqrt(F.avg(c * c)).alias("rms"),
        F.max(F.abs(c)).alias("max_abs"),
    ]


def window_stats(sample_rows: DataFrame, size: int) -> DataFrame:
    """Statistics of complete tumbling windows of ``size`` samples."""
    return (
        sample_rows.groupBy(*S, F.floor(F.col("sample") / size).cast("long").alias("window"))
        .agg(F.count(F.lit(1)).alias("n"), *_stats(), F.percentile(F.abs("x"), 0.95).alias("p95"))
        .where(F.col("n") == size)
        .drop("n")
    )


def global_stats(windows: DataFrame) -> DataFrame:
    """Mean and std over windows of the window mean, std and rms."""
    out = []
    for c, name in (("mean", "means"), ("std", "stds"), ("rms", "rms")):
        out += [F.avg(c).alias(f"mean_of_{name}"), F.stddev_pop(c).alias(f"std_of_{name}")]
    return windows.groupBy(*S).agg(*out)


def outlier_windows(windows: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Windows whose mean, std or rms is far from the other windows."""
    g = global_stats(windows)
    z = lambda c, name: F.abs((F.col(c) - F.col(f"mean_of_{name}")) / F.nullif(F.col(f"std_of_{name}"), F.lit(0.0)))
    joined = (
        attach(windows, g, S)
        .withColumn("mean_z", z("mean", "means"))
        .withColumn("std_z", z("std", "stds"))
        .withColumn("rms_z", z("rms", "rms"))
    )
    far = F.coalesce(F.greatest("mean_z", "std_z", "rms_z") > threshold, F.lit(False))
    return joined.where(far).select(*windows.columns, "mean_z", "std_z", "rms_z")


def segment_stats(rows: DataFrame, rate: int, key: str = "name") -> DataFrame:
    """Statistics of the samples of each segment, with the percent of zeros."""
    return rows.groupBy(*S, key).agg(
        (F.count(F.lit(1)) / F.lit(float(rate))).alias("duration_s"),
        *_stats(),
        (F.avg((F.col("x") == 0).cast("double")) * 100.0).alias("zero_percent"),
    )


def peak_normalise(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Scale to a peak of one; silence stays."""
    top = rows.groupBy(*keys).agg(F.max(F.abs("x")).alias("__top"))
    return attach(rows, top, keys).withColumn("x", F.when(F.col("__top") > 0, F.col("x") / F.col("__top")).otherwise(F.col("x"))).drop("__top")


def session_meta(sessions: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """Presence flag and row count of each related table per session."""
    out = sessions.select(*S).distinct()
    for name, df in parts.items():
        n = df.groupBy(*S).agg(F.count(F.lit(1)).alias(f"n_{name}"))
        out = (
            out.join(n, S, "left")
            .withColumn(f"n_{name}", F.coalesce(f"n_{name}", F.lit(0).cast("long")))
            .withColumn(f"has_{name}", F.col(f"n_{name}") > 0)
        )
    return out
