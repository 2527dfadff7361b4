"""Two device streams on one clock: gap filling, drift, windows, validity.

Frames come as (session_id, stream, frame, ts_ms, value) with stream 'eeg' or
'fnirs' and ``frame`` a dense 0-based number per session and stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import attach, points_in_intervals
from ..functions.lineage import cut
from ..functions.ordered import first_k, over_frames, over_slices

S = ["session_id"]
OPTICAL = ("fnirs_ms", "is_actual", "fnirs_value")


@dataclass(frozen=True)
class Timing:
    """Timing parameters; the defaults are those of the recording devices."""

    period: float = 210.0  # ideal optical frame period, ms
    eeg_per_window: int = 7
    chunk: int = 20  # frames used for offsets and the tail check
    density: float = 0.8  # share of real frames a good tail needs
    slice_ms: float = 6 * 3_600_000.0  # time per slice of ordered work
    frame_slice: int = 1_000_000  # frames per slice of ordered work

    @property
    def tolerance(self) -> float:
        return self.period / 1.9


def of(frames: DataFrame, stream: str) -> DataFrame:
    return frames.where(F.col("stream") == stream)


def overlap(frames: DataFrame) -> DataFrame:
    """Common time span of both streams per session; no row without overlap."""
    at = lambda s, f: f(F.when(F.col("stream") == s, F.col("ts_ms")))
    spans = frames.groupBy(*S).agg(
        at("eeg", F.min).alias("e0"), at("eeg", F.max).alias("e1"), at("fnirs", F.min).alias("f0"), at("fnirs", F.max).alias("f1")
    )
    return (
        spans.where("e0 IS NOT NULL AND f0 IS NOT NULL")
        .select(*S, F.greatest("e0", "f0").alias("from_ms"), F.least("e1", "f1").alias("to_ms"))
        .where("from_ms < to_ms")
    )


def overlap_frames(frames: DataFrame) -> DataFrame:
    """The overlap with the first and last frame number of each stream inside it."""
    inside = attach(frames, overlap(frames), S).where("ts_ms BETWEEN from_ms AND to_ms")
    pick = lambda s, f: f(F.when(F.col("stream") == s, F.col("frame")))
    return inside.groupBy(*S, "from_ms", "to_ms").agg(
        pick("eeg", F.min).alias("eeg_first"),
        pick("eeg", F.max).alias("eeg_last"),
        pick("fnirs", F.min).alias("fnirs_first"),
        pick("fnirs", F.max).alias("fnirs_last"),
    )


def repair_zero_times(frames: DataFrame, t: Timing) -> DataFrame:
    """Replace zero timestamps of one stream.

    A zero takes the previous time plus one period while that stays below the
    next real time p < n, and then moves halfway to n each time.  In a run of
    zeros after p, with m the number of whole periods that fit before n, the
    j-th zero is therefore p + j*period for j <= m and n - (n - q) / 2^(j-m)
    with q = p + m*period afterwards.  A zero in the very first row takes the
    next time minus one period if that is positive.  Other zeros stay.
    """
    real = F.when(F.col("ts_ms") != 0, F.col("ts_ms").cast("double"))
    marked = frames.withColumn("__real", real).withColumn("__rf", F.when(real.isNotNull(), F.col("frame")))
    known = over_slices(
        marked,
        S,
        ["frame"],
        t.frame_slice,
        fills={"__p": "__real", "__pf": "__rf"},
        backfills={"__n": "__real", "__nf": "__rf"},
    )
    p, n, period = F.col("__p"), F.col("__n"), F.lit(float(t.period))
    j = (F.col("frame") - F.col("__pf")).cast("double")
    m = F.ceil((n - p) / period) - 1
    q = p + m * period
    run = (
        F.when(n.isNull(), p + j * period)
        .when(p >= n, F.lit(0.0))
        .when(j <= m, p + j * period)
        .otherwise(n - (n - q) / F.pow(F.lit(2.0), j - m))
    )
    first = F.when((F.col("frame") == 0) & (F.col("__nf") == 1) & (n - period > 0), n - period).otherwise(F.lit(0.0))
    fixed = F.when(F.col("__real").isNotNull(), F.col("__real")).when(p.isNull(), first).otherwise(run)
    return known.withColumn("ts_ms", fixed).drop("__real", "__rf", "__p", "__pf", "__n", "__nf")


def gap_fill(frames: DataFrame, t: Timing, zero_unknown: bool = False) -> DataFrame:
    """Fill gaps of one stream with zero placeholders at the ideal period.

    A gap of n periods (rounded half to even) gets n-1 placeholders.  Adds
    ``is_actual`` and ``idx``, the dense number after filling.  Times may be
    relative and begin at 0; with ``zero_unknown``, for times since the epoch, 0
    is a missing time and no gap begins or ends there.
    """
    nxt = over_slices(frames, S, ["ts_ms", "frame"], t.slice_ms, leads={"__next": "ts_ms"})
    known = (F.col("ts_ms") > 0) & (F.col("__next") > 0) if zero_unknown else F.lit(True)
    steps = F.when(known, F.rint((F.col("__next") - F.col("ts_ms")) / F.lit(float(t.period))).cast("long"))
    n = F.greatest(F.lit(1).cast("long"), F.coalesce(steps, F.lit(1).cast("long")))
    filled = (
        expand(nxt, n, "k")
        .select(
            *S,
            "frame",
            "k",
            (F.col("ts_ms") + F.col("k") * F.lit(float(t.period))).alias("ts_ms"),
            (F.col("k") == 0).alias("is_actual"),
            F.when(F.col("k") == 0, F.col("value")).otherwise(F.lit(0.0)).alias("value"),
        )
    )
    ranked = over_slices(filled, S, ["ts_ms", "frame", "k"], t.slice_ms, rank="rn")
    return ranked.withColumn("idx", F.col("rn") - 1).drop("rn")


def truncate(filled: DataFrame, t: Timing) -> DataFrame:
    """Cut a stream after the last frame whose trailing chunk is dense enough."""
    c = t.chunk
    flagged = filled.withColumn("__a", F.col("is_actual").cast("int"))
    dense = over_frames(
        flagged.select(*S, "idx", "__a"), S, "idx", c - 1, 0, max(t.frame_slice, 10 * c), {"__s": lambda w: F.sum("__a").over(w)}
    )
    good = (F.col("idx") >= c - 1) & (F.col("__s") / F.lit(c) >= F.lit(t.density))
    ends = dense.groupBy(*S).agg(F.max(F.when(good, F.col("idx"))).alias("__end"))
    return attach(filled, ends, S).where("__end IS NULL OR idx <= __end").drop("__end")


def drift(processed: DataFrame, t: Timing) -> DataFrame:
    """Mean early and late offset from the ideal grid, and the drift between them."""
    period = F.lit(float(t.period))
    few = Window.partitionBy(*S).orderBy("r")  # holds at most ``chunk`` rows
    offset = F.col("ts_ms") - F.first("ts_ms").over(few) - (F.col("r") - 1) * period
    early = (
        first_k(processed.where("is_actual"), S, ["idx"], t.chunk, "r")
        .withColumn("o", offset)
        .groupBy(*S)
        .agg(F.avg("o").alias("early_ms"), F.min_by("ts_ms", "idx").alias("first_ms"))
    )
    last = first_k(processed, S, [F.col("idx").desc()], t.chunk, "back").withColumn("r", F.lit(t.chunk + 1) - F.col("back"))
    late = (
        last.withColumn("o", offset)
        .groupBy(*S)
        .agg(F.avg("o").alias("late_ms"), F.count(F.lit(1)).alias("n"), F.max_by("ts_ms", "idx").alias("last_ms"))
    )
    late_ms = F.when(F.col("n") >= t.chunk, F.col("late_ms")).otherwise(F.col("early_ms"))
    span = F.col("last_ms") - F.col("first_ms")
    return (
        early.join(late, S)
        .withColumn("late_ms", late_ms)
        .withColumn(
            "drift_ms_per_s",
            F.when(span > period, (F.col("late_ms") - F.col("early_ms")) / span * 1000.0).otherwise(F.lit(0.0)),
        )
        .withColumn("start_ms", F.col("first_ms") - F.col("early_ms"))
        .select(*S, "early_ms", "late_ms", "drift_ms_per_s", "first_ms", "last_ms", "start_ms")
    )


def align_start(frames: DataFrame, bounds: DataFrame, offsets: DataFrame, t: Timing) -> DataFrame:
    """First and last EEG frame to use: from the projected start to the optical end."""
    eeg = of(frames, "eeg").select(*S, "frame", "ts_ms")
    known = bounds.join(offsets, S).select(*S, "eeg_first", "eeg_last", "last_ms", "start_ms")
    known = known.where(F.col("eeg_last") - F.col("eeg_first") + 1 >= t.eeg_per_window)
    with_end = (
        attach(eeg, known, S)
        .groupBy(*S, "eeg_first", "eeg_last", "start_ms")
        .agg(F.max(F.when(F.col("ts_ms") <= F.col("last_ms"), F.col("frame"))).alias("__end"))
    )
    usable = F.coalesce(F.col("__end") - F.col("eeg_first") + 1 >= t.eeg_per_window, F.lit(False))
    ends = with_end.withColumn("last_frame", F.when(usable, F.least("__end", "eeg_last")).otherwise(F.col("eeg_last")))
    inside = (F.col("ts_ms") >= F.col("start_ms")) & F.col("frame").between(F.col("eeg_first"), F.col("last_frame"))
    return (
        attach(eeg, ends.select(*S, "eeg_first", "last_frame", "start_ms"), S)
        .where(inside)
        .groupBy(*S, "last_frame", "start_ms")
        .agg(F.min("frame").alias("first_frame"))
        .select(*S, "first_frame", "last_frame", "start_ms")
    )


def eeg_chunks(frames: DataFrame, starts: DataFrame, t: Timing) -> DataFrame:
    """Complete chunks of ``eeg_per_window`` frames from the aligned start."""
    n = t.eeg_per_window
    return (
        attach(of(frames, "eeg").select(*S, "frame", "ts_ms", "value"), starts, S)
        .where("frame BETWEEN first_frame AND last_frame")
        .groupBy(*S, F.floor((F.col("frame") - F.col("first_frame")) / n).cast("long").alias("window_idx"), "start_ms")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("frame").alias("eeg_frame"),
            F.min_by("ts_ms", "frame").alias("eeg_ms"),
            F.max_by("ts_ms", "frame").alias("eeg_last_ms"),
            F.avg("value").alias("eeg_value"),
        )
        .where(F.col("n") == n)
        .drop("n")
    )


def chunk_pairs(frames: DataFrame, processed: DataFrame, starts: DataFrame, t: Timing) -> DataFrame:
    """Pair the w-th EEG chunk with the w-th optical frame until either ends."""
    optical = processed.select(
        *S, F.col("idx").alias("window_idx"), F.col("ts_ms").alias("fnirs_ms"), "is_actual", F.col("value").alias("fnirs_value")
    )
    return (
        eeg_chunks(frames, starts, t)
        .join(optical, [*S, "window_idx"])
        .withColumn("ideal_ms", F.col("start_ms") + F.col("window_idx") * F.lit(float(t.period)))
        .drop("start_ms")
    )


def clock_range(frames: DataFrame, t: Timing) -> DataFrame:
    """Start and number of slots of the master clock per session."""
    last = F.col("ts_ms") + F.when(F.col("stream") == "eeg", F.lit(t.period / t.eeg_per_window)).otherwise(F.lit(float(t.period)))
    return (
        frames.groupBy(*S)
        .agg(F.min(F.when(F.col("ts_ms") > 0, F.col("ts_ms"))).cast("double").alias("t0"), F.max(last).alias("t1"))
        .select(*S, "t0", F.ceil((F.col("t1") - F.col("t0")) / F.lit(float(t.period))).cast("long").alias("n_slots"))
        .where("n_slots > 0")
    )


EXPAND = 10_000  # rows that one row may become at a time


def expand(df: DataFrame, n: Column, name: str) -> DataFrame:
    """Repeat each row with the numbers 0 to n - 1: first blocks of numbers, dealt to tasks, then the numbers."""
    zero = F.lit(0).cast("long")
    blocks = df.withColumn("__n", n).withColumn("__block", F.explode(F.sequence(zero, F.floor((F.col("__n") - 1) / EXPAND).cast("long"))))
    long = F.col("__n") > EXPAND
    # a stated number of partitions, as adaptive execution would merge these few small rows
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.where(~long).unionByName(blocks.where(long).repartition(tasks, "__block", "session_id"))
    first = F.col("__block") * EXPAND
    last = F.least(first + EXPAND, F.col("__n")) - 1
    return spread.withColumn(name, F.explode(F.sequence(first, last))).drop("__n", "__block")


def clock(frames: DataFrame, t: Timing) -> DataFrame:
    """One row per session and slot of the master clock."""
    return _ticks(clock_range(frames, t), t)


def _ticks(span: DataFrame, t: Timing) -> DataFrame:
    return (
        expand(span, F.col("n_slots"), "slot")
        .select(*S, "slot", (F.col("t0") + F.col("slot") * F.lit(float(t.period))).alias("time_ms"))
    )


def slot_of(key: Column, t0: Column, n: Column, period: float) -> Column:
    """Nearest slot, the lower one at equal distance, within the clock."""
    near = F.ceil((key - t0) / F.lit(float(period)) - F.lit(0.5)).cast("long")
    return F.least(F.greatest(near, F.lit(0).cast("long")), n - 1)


def to_slots(windows: DataFrame, frames: DataFrame, t: Timing, key: str = "ideal_ms") -> DataFrame:
    """All slots of the clock, with the window that falls on each."""
    span = cut(clock_range(frames, t))
    placed = (
        attach(windows, span, S)
        .withColumn("slot", slot_of(F.col(key), F.col("t0"), F.col("n_slots"), t.period))
        .where(F.abs(F.col("t0") + F.col("slot") * F.lit(float(t.period)) - F.col(key)) <= F.lit(t.tolerance))
    )
    # Of several windows on one slot the later one counts; an optical placeholder never replaces a frame.
    order = lambda c: F.when(F.col("is_actual"), F.col("window_idx")) if c in OPTICAL else F.col("window_idx")
    carried = [c for c in windows.columns if c not in (*S, key)]
    one = placed.groupBy(*S, "slot").agg(*[F.max_by(c, order(c)).alias(c) for c in carried])
    return _ticks(span, t).join(cut(one), [*S, "slot"], "left")


def masked(slots: DataFrame) -> DataFrame:
    """Validity flags per slot and stream; values of invalid slots are zero."""
    eeg = F.col("eeg_ms").isNotNull() if "eeg_ms" in slots.columns else F.lit(False)
    optical = F.col("fnirs_ms").isNotNull() & F.col("is_actual") if "fnirs_ms" in slots.columns else F.lit(False)
    null = F.lit(None).cast("double")
    col = lambda c: F.col(c) if c in slots.columns else null
    return (
        slots.withColumn("eeg_valid", F.coalesce(eeg, F.lit(False)))
        .withColumn("fnirs_valid", F.coalesce(optical, F.lit(False)))
        .select(
            *S,
            "slot",
            "time_ms",
            "eeg_valid",
            "fnirs_valid",
            F.when(F.col("eeg_valid"), col("eeg_ms")).cast("double").alias("real_eeg_ms"),
            F.when(F.col("eeg_valid"), col("eeg_last_ms")).cast("double").alias("eeg_last_ms"),
            F.when(F.col("fnirs_valid"), col("fnirs_ms")).cast("double").alias("real_fnirs_ms"),
            F.when(F.col("eeg_valid"), col("eeg_value")).otherwise(F.lit(0.0)).alias("eeg_value"),
            F.when(F.col("fnirs_valid"), col("fnirs_value")).otherwise(F.lit(0.0)).alias("fnirs_value"),
        )
    )


def processed_fnirs(frames: DataFrame, t: Timing) -> DataFrame:
    """Optical frames inside the overlap, gap-filled and truncated."""
    inside = attach(of(frames, "fnirs"), cut(overlap(frames)), S).where("ts_ms BETWEEN from_ms AND to_ms").drop("from_ms", "to_ms")
    return truncate(cut(gap_fill(inside, t, zero_unknown=True)), t)


def two_stream_windows(frames: DataFrame, t: Timing) -> DataFrame:
    """Master-clock slots of sessions that have both streams.

    Tables of one row per session are written: all steps are dealt by session, so
    they would otherwise run, with their sorts and tables in memory, in one stage.
    """
    frames = cut(frames)
    processed = cut(processed_fnirs(frames, t))
    bounds, offsets = cut(overlap_frames(frames)), cut(drift(processed, t))
    starts = cut(align_start(frames, bounds, offsets, t))
    both = frames.join(starts.select(*S), S, "left_semi")
    return masked(to_slots(chunk_pairs(frames, processed, starts, t), both, t))


def eeg_only_windows(frames: DataFrame, t: Timing) -> DataFrame:
    """Master-clock slots from EEG frames alone, anchored on the first frame."""
    eeg = of(frames, "eeg")
    starts = (
        eeg.groupBy(*S)
        .agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"), F.min("ts_ms").cast("double").alias("start_ms"))
        .where(F.col("last_frame") - F.col("first_frame") + 1 >= t.eeg_per_window)
    )
    chunks = eeg_chunks(frames, starts, t).withColumn(
        "ideal_ms", F.col("start_ms") + F.col("window_idx") * F.lit(float(t.period))
    )
    return masked(to_slots(chunks.drop("start_ms"), eeg.join(starts.select(*S), S, "left_semi"), t))


def fnirs_only_windows(frames: DataFrame, t: Timing) -> DataFrame:
    """Master-clock slots from optical frames alone, after repair and filling."""
    optical = cut(repair_zero_times(of(frames, "fnirs"), t))
    processed = cut(truncate(cut(gap_fill(optical, t, zero_unknown=True)), t))
    offsets = drift(processed, t).select(*S, "start_ms")
    windows = attach(
        processed.select(*S, F.col("idx").alias("window_idx"), F.col("ts_ms").alias("fnirs_ms"), "is_actual", F.col("value").alias("fnirs_value")),
        offsets,
        S,
    ).withColumn("ideal_ms", F.col("start_ms") + F.col("window_idx") * F.lit(float(t.period)))
    return masked(to_slots(windows.drop("start_ms"), optical, t))


def route(sessions: DataFrame, frames: DataFrame) -> DataFrame:
    """Which windowing path a session takes."""
    has = lambda s: F.max((F.col("stream") == s).cast("int"))
    seen = frames.groupBy(*S).agg(has("eeg").alias("e"), has("fnirs").alias("f"))
    path = (
        F.when((F.col("e") == 1) & (F.col("f") == 1), "both")
        .when(F.col("e") == 1, "eeg_only")
        .when(F.col("f") == 1, "fnirs_only")
        .otherwise("skipped_no_data_for_windowing")
    )
    return sessions.select(*S).distinct().join(seen, S, "left").select(*S, path.alias("route"))


def all_windows(sessions: DataFrame, frames: DataFrame, t: Timing) -> DataFrame:
    """Windows of every session along its own path."""
    frames = cut(frames)
    routed = cut(route(sessions, frames))
    pick = lambda r: frames.join(routed.where(F.col("route") == r).select(*S), S, "left_semi")
    return (
        two_stream_windows(pick("both"), t)
        .withColumn("route", F.lit("both"))
        .unionByName(eeg_only_windows(pick("eeg_only"), t).withColumn("route", F.lit("eeg_only")))
        .unionByName(fnirs_only_windows(pick("fnirs_only"), t).withColumn("route", F.lit("fnirs_only")))
    )


def valid_span(slots: DataFrame) -> DataFrame:
    """First valid slot and end (exclusive) per stream and for both; -1 if none."""
    span = []
    for name, ok in (
        ("eeg", F.col("eeg_valid")),
        ("fnirs", F.col("fnirs_valid")),
        ("both", F.col("eeg_valid") & F.col("fnirs_valid")),
    ):
        span.append(F.coalesce(F.min(F.when(ok, F.col("slot"))), F.lit(-1)).cast("long").alias(f"{name}_start"))
        span.append(F.coalesce(F.max(F.when(ok, F.col("slot"))) + 1, F.lit(-1)).cast("long").alias(f"{name}_end"))
    return slots.groupBy(*S).agg(*span)


def joint_windows(slots: DataFrame) -> DataFrame:
    """Slots of the span in which both streams are valid, numbered from 0."""
    span = valid_span(slots).select(*S, "both_start", "both_end")
    return (
        attach(slots, span, S)
        .where("slot >= both_start AND slot < both_end")
        .withColumn("dataset_idx", F.col("slot") - F.col("both_start"))
        .drop("both_start", "both_end")
    )


def trim_stats(slots: DataFrame, frames: DataFrame, t: Timing) -> DataFrame:
    """Percent of each stream outside its valid span, and percent missing inside."""
    step = F.lit(t.period / t.eeg_per_window)
    period = F.lit(float(t.period))
    at = lambda s, f: f(F.when(F.col("stream") == s, F.col("ts_ms")))
    raw = frames.groupBy(*S).agg(
        (at("eeg", F.max) + step - at("eeg", F.min)).alias("eeg_all"), (at("fnirs", F.max) + period - at("fnirs", F.min)).alias("fnirs_all")
    )
    spans = valid_span(slots)
    cover = slots.groupBy(*S).agg(
        (F.max_by("eeg_last_ms", F.when(F.col("eeg_valid"), F.col("slot"))) + step - F.min("real_eeg_ms")).alias("eeg_got"),
        (F.max_by("real_fnirs_ms", F.when(F.col("fnirs_valid"), F.col("slot"))) + period - F.min("real_fnirs_ms")).alias("fnirs_got"),
        F.count_if("fnirs_valid").alias("n_fnirs"),
    )
    clamp = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(100.0))
    trimmed = lambda s: F.coalesce(clamp((1.0 - F.col(f"{s}_got") / F.col(f"{s}_all")) * 100.0), F.lit(100.0))
    width = F.col("fnirs_end") - F.col("fnirs_start")
    missing = F.when(width > 0, clamp((width - F.col("n_fnirs")) / width * 100.0)).otherwise(F.lit(0.0))
    return (
        spans.join(cover, S)
        .join(raw, S)
        .select(
            *S,
            trimmed("eeg").alias("percent_eeg_trimmed"),
            trimmed("fnirs").alias("percent_fnirs_trimmed"),
            missing.alias("percent_fnirs_missing"),
        )
    )


def window_arrays(frames: DataFrame, per_window: int) -> DataFrame:
    """(frame, channel, samples[]) to one array per window and channel.

    A group holds exactly ``per_window`` frames; incomplete windows drop out.
    """
    parts = F.sort_array(F.collect_list(F.struct("frame", "samples")))
    return (
        frames.groupBy(*S, "channel", F.floor(F.col("frame") / per_window).cast("long").alias("window_idx"))
        .agg(parts.alias("parts"))
        .where(F.size("parts") == per_window)
        .withColumn("samples", F.flatten(F.transform("parts", lambda p: p["samples"])))
        .drop("parts")
    )


def log_windows(windows: DataFrame, values: str = "samples") -> DataFrame:
    """Natural logarithm of array values; NaN where the value is not positive."""
    log = lambda x: F.when(x > 0, F.ln(x)).otherwise(F.lit(float("nan")))
    return windows.withColumn(values, F.transform(values, log))


def window_count(n: Column, size: int, stride: int) -> Column:
    return F.greatest(F.floor((n - size) / stride) + 1, F.lit(0))


def slide(samples: DataFrame, keys: list[str], size: int, stride: int) -> DataFrame:
    """Copy each sample (dense ``sample`` number) to the sliding windows it is in.

    Windows that run past the end of their key are left out.
    """
    n = samples.groupBy(*keys).agg((F.max("sample") + 1).alias("__n"))
    s = F.col("sample")
    first = F.greatest(F.lit(0).cast("long"), F.ceil((s - size + 1) / F.lit(stride)).cast("long"))
    last = F.least(F.floor(s / F.lit(stride)).cast("long"), window_count(F.col("__n"), size, stride).cast("long") - 1)
    return (
        attach(samples, n, keys)
        .withColumn("__last", last)
        .withColumn("__first", first)
        .where("__last >= __first")
        .withColumn("window", F.explode(F.sequence("__first", "__last")))
        .drop("__n", "__first", "__last")
    )


def common_windows(slid: list[tuple[DataFrame, str]], session: str = "session_id") -> DataFrame:
    """Windows of several modalities, cut to the smallest count in the session."""
    union = None
    for df, name in slid:
        part = df.withColumn("modality", F.lit(name))
        union = part if union is None else union.unionByName(part)
    counts = union.groupBy(session, "modality").agg((F.max("window") + 1).alias("n"))
    least = counts.groupBy(session).agg(F.min("n").alias("__n"), F.count(F.lit(1)).alias("__m")).where(F.col("__m") == len(slid))
    return attach(union, least.drop("__m"), [session]).where("window < __n").drop("__n")


def window_events(windows: DataFrame, events: DataFrame, descriptions: dict[str, str], width: float) -> DataFrame:
    """Events with ``start <= t < end`` of each window, relative time, description."""
    pairs = points_in_intervals(events, windows, S, "client_ms", "start_ms", "end_ms", width, open_end=True)
    words = F.create_map(*[F.lit(x) for kv in descriptions.items() for x in kv])
    return pairs.withColumn("relative_s", (F.col("client_ms") - F.col("start_ms")) / 1000.0).withColumn(
        "description", F.coalesce(F.try_element_at(words, F.col("kind")), F.lit("unknown"))
    )


def epochs(
    signal: DataFrame, markers: DataFrame, tmin: float, tmax: float, baseline: tuple[float, float] | None, width: float
) -> DataFrame:
    """Signal around markers in [tmin, tmax] ms, minus the mean of the baseline.

    ``signal`` has session_id, ts_ms, value; ``markers`` session_id, marker,
    marker_ms.  Signal needed only for the baseline is cut off again.
    """
    lo, hi = (min(tmin, baseline[0]), max(tmax, baseline[1])) if baseline else (tmin, tmax)
    ranges = markers.withColumn("__a", F.col("marker_ms") + lo).withColumn("__b", F.col("marker_ms") + hi)
    cutout = (
        points_in_intervals(signal, ranges, S, "ts_ms", "__a", "__b", width)
        .withColumn("offset_ms", F.col("ts_ms") - F.col("marker_ms"))
        .drop("__a", "__b")
    )
    if baseline:
        one_epoch = Window.partitionBy(*S, "marker")  # as long as [lo, hi]
        base = F.avg(F.when(F.col("offset_ms").between(*baseline), F.col("value"))).over(one_epoch)
        cutout = cutout.withColumn("value", F.col("value") - F.coalesce(base, F.lit(0.0)))
    return cutout.where(F.col("offset_ms").between(tmin, tmax))


def match_all(channels: DataFrame, strategy: str = "intersect", shift: float = -0.5) -> DataFrame:
    """Channels usable for all datasets and the lowest sampling rate.

    ``channels`` has dataset, channel, rate.
    """
    pairs = channels.select("dataset", "channel").distinct()
    n_all = channels.agg(F.count_distinct("dataset").alias("n")).scalar()
    rate = channels.agg((F.min("rate") + F.lit(shift)).alias("r")).scalar()
    per = pairs.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))
    if strategy == "intersect":
        per = per.where(F.col("n") == n_all)
    return per.select("channel", rate.alias("rate"))
