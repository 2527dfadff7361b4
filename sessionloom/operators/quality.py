"""Signal quality of channels.

Samples come as (session_id, channel, sample, x) with a dense 0-based sample
number per session and channel.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.joins import attach, points_in_intervals
from ..functions.lineage import cut
from ..functions.ordered import over_frames, over_slices
from ..functions.quantiles import exact_positions, exact_quantiles, magnitude
from .align import window_count

S = ["session_id"]
K = ["session_id", "channel"]
#: Segments of a session that one task numbers.
SEGMENTS = 4096


def spread(x: str = "x") -> Column:
    return F.max(x) - F.min(x)


def channel_stats(samples: DataFrame) -> DataFrame:
    return samples.groupBy(*K).agg(F.stddev_pop("x").alias("std"), spread().alias("range"))


def window_ranges(samples: DataFrame, size: int, step: int) -> DataFrame:
    """Range of each sliding window that ends inside its channel.

    Starts and ends of all windows cut a step in two panes.  Extremes are taken
    once per pane, combined before the shuffle; only panes, not samples, are
    copied to the windows they are in.
    """
    whole, rest = divmod(size, step)
    s = F.col("sample")
    at = [F.floor(s / F.lit(step)).cast("long").alias("__step"), (F.pmod(s, F.lit(step)) >= rest).cast("long").alias("__part")]
    panes = samples.groupBy(*K, *at).agg(F.min("x").alias("__lo"), F.max("x").alias("__hi"))
    n = samples.groupBy(*K).agg((F.max("sample") + 1).alias("__n"))
    first = F.greatest(F.lit(0).cast("long"), F.col("__step") - whole + F.col("__part"))
    last = F.least(F.col("__step"), window_count(F.col("__n"), size, step).cast("long") - 1)
    return (
        attach(panes, n, K)
        .withColumn("__first", first)
        .withColumn("__last", last)
        .where("__last >= __first")
        .withColumn("window", F.explode(F.sequence("__first", "__last")))
        .groupBy(*K, "window")
        .agg((F.max("__hi") - F.min("__lo")).alias("range"))
    )


def sliding_range(samples: DataFrame, size: int = 2500, step: int | None = None) -> DataFrame:
    """Range in sliding windows, at the centre sample of each."""
    step = step or size // 5
    return window_ranges(samples, size, step).select(*K, (F.col("window") * step + size // 2).alias("centre"), "range")


def tumbling(samples: DataFrame, size: int) -> Column:
    return F.floor(F.col("sample") / size).cast("long")


def flatline_percent(samples: DataFrame, size: int = 2500, threshold: float = 0.005) -> DataFrame:
    """Percent of complete tumbling windows with a range up to the threshold."""
    per = (
        samples.groupBy(*K, tumbling(samples, size).alias("window"))
        .agg(F.count(F.lit(1)).alias("n"), spread().alias("r"))
        .where(F.col("n") == size)
    )
    return per.groupBy(*K).agg((F.avg((F.col("r") <= threshold).cast("double")) * 100.0).alias("flat_percent"))


def segment_ranges(samples: DataFrame, size: int, step: int) -> DataFrame:
    """Median over channels of the range in each overlapping segment of a session; as many values as a device has channels."""
    per = window_ranges(samples, size, step).where(~F.isnan("range"))
    return per.groupBy(*S, "window").agg(F.median("range").alias("range"))


def lowest_segments(segments: DataFrame, ratio: float) -> DataFrame:
    """The share ``1 - ratio`` of a session's segments with the lowest ranges, earlier ones first, and their number ``__n``.

    Segments are numbered in slices of nearly one range; those of a flat signal
    (range 0) in slices of their place.
    """
    flat = F.floor(F.col("window") / F.lit(SEGMENTS)) - F.lit(1 << 40)
    slices = F.when(F.col("range") == 0, flat).otherwise(magnitude(F.col("range"), 4096))
    n = segments.groupBy(*S).agg(F.count(F.lit(1)).alias("__n"))
    numbered = over_slices(segments.withColumn("__slice", slices), S, ["__slice", "range", "window"], 1, rank="__r")
    keep = F.greatest(F.lit(1), F.floor(F.col("__n") * F.lit(1 - ratio) + F.lit(1e-9)))
    return attach(numbered, n, S).where(F.col("__r") <= keep).select(*S, "window", "__n")


def reject_segments(samples: DataFrame, rate: float, duration: float = 5.0, overlap: float = 0.5, ratio: float = 0.5) -> DataFrame:
    """Keep the samples of the segments with the lowest ranges.

    A session passes unchanged when it is shorter than a second, has fewer than
    two segments, or would keep less than two seconds.
    """
    size = int(duration * rate)
    step = int((duration - 2 * overlap) * rate)
    step = step if step > 0 else size // 4
    start = F.col("window") * step
    lowest = lowest_segments(cut(segment_ranges(samples, size, step)), ratio)
    chosen = cut(lowest.select(*S, "window", "__n", start.alias("__a"), (start + size - 1).alias("__b")))
    # Samples kept: a segment adds what the one before it does not cover.
    kept = (
        over_slices(chosen, S, ["window"], SEGMENTS, lags={"__before": "__b"})
        .withColumn("__new", F.col("__b") - F.greatest(F.col("__a") - 1, F.coalesce("__before", F.lit(-1))))
        .groupBy(*S)
        .agg(F.sum("__new").alias("__kept"), F.max("__n").alias("__segments"))
    )
    length = samples.groupBy(*S).agg((F.max("sample") + 1).alias("__len"))
    shorter = (
        length.join(kept, S)
        .where((F.col("__len") >= rate) & (F.col("__segments") >= 2) & (F.col("__kept") < F.col("__len")) & (F.col("__kept") >= rate * 2))
        .select(*S)
    )
    spans = chosen.join(shorter, S, "left_semi").drop("window", "__n")
    inside = points_in_intervals(samples, spans, S, "sample", "__a", "__b", max(size, 1), "left_semi")
    return inside.unionByName(samples.join(shorter, S, "left_anti"))


def clip(samples: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Clip each channel to its quantiles; ``clipped`` marks changed samples."""
    q = exact_quantiles(samples, K, "x", [low, high], ["__lo", "__hi"])
    joined = attach(samples, q, K)
    return (
        joined.withColumn("clipped", (F.col("x") < F.col("__lo")) | (F.col("x") > F.col("__hi")))
        .withColumn("x", F.least(F.greatest("x", "__lo"), "__hi"))
        .drop("__lo", "__hi")
    )


def clipped_percent(clipped: DataFrame) -> DataFrame:
    return clipped.groupBy(*K).agg((F.avg(F.col("clipped").cast("double")) * 100.0).alias("clipped_percent"))


def zscore(samples: DataFrame) -> DataFrame:
    """Standardise each channel; a constant channel is only centred."""
    m = samples.groupBy(*K).agg(F.avg("x").alias("__m"), F.stddev_pop("x").alias("__s"))
    centred = F.col("x") - F.col("__m")
    return attach(samples, m, K).withColumn("x", F.when(F.col("__s") > 0, centred / F.col("__s")).otherwise(centred)).drop("__m", "__s")


def log_offset(samples: DataFrame) -> DataFrame:
    """Logarithm after shifting the whole recording above zero where needed."""
    low = samples.groupBy(*S).agg(F.min("x").alias("__min"))
    shift = F.when(F.col("__min") <= 0, F.abs("__min") + F.lit(1e-6)).otherwise(F.lit(0.0))
    return attach(samples, low, S).withColumn("x", F.ln(F.col("x") + shift)).drop("__min")


def trimmed_std(samples: DataFrame, trim: float = 0.05) -> DataFrame:
    """Population std per channel without the lowest and highest ``trim`` share.

    The borders are exact order statistics; of values equal to a border only
    the untrimmed ones count.
    """
    cut = lambda n: F.floor(n * F.lit(trim) + F.lit(1e-9))
    borders = exact_positions(samples, K, "x", [cut, lambda n: n - 1 - cut(n)], ["__lo", "__hi"])
    x, lo, hi = F.col("x"), F.col("__lo"), F.col("__hi")
    mid = (x > lo) & (x < hi)
    y = F.when(mid, x - lo)  # shifted, so squares do not cancel
    per = (
        attach(samples, borders, K)
        .groupBy(*K, "__lo", "__hi")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(x <= lo).alias("nl"),
            F.count_if(x >= hi).alias("nh"),
            F.coalesce(F.sum(y), F.lit(0.0)).alias("s1"),
            F.coalesce(F.sum(y * y), F.lit(0.0)).alias("s2"),
        )
    )
    k = cut(F.col("n"))
    kept = F.col("n") - 2 * k
    top = F.col("nh") - k
    gap = hi - lo
    mean = (F.col("s1") + top * gap) / kept
    var = (F.col("s2") + top * gap * gap) / kept - mean * mean
    std = F.when(lo == hi, F.lit(0.0)).otherwise(F.sqrt(F.greatest(var, F.lit(0.0))))
    return per.select(*K, std.alias("std"))


def bad_mask(
    samples: DataFrame, n_std: float = 7.0, most_range: float = 2000.0, window: int = 50, kernel: int = 50, block: int = 100_000
) -> DataFrame:
    """Bad flag per session and sample, over all channels, widened by the kernel.

    A sample is bad when it is beyond ``n_std`` trimmed stds, or lies in a
    window (half overlapping) with too large a range.
    """
    half = window // 2
    std = trimmed_std(samples).withColumnRenamed("std", "__std")
    whole = samples.groupBy(*K).agg(spread().alias("__range"), (F.max("sample") + 1).alias("__n"))
    known = attach(samples.select(*K, "sample", "x"), std.join(whole, K), K)
    loud = known.withColumn("bad", F.abs("x") > F.lit(n_std) * F.col("__std"))
    # windows start at 0, half, 2*half, ... below n - window; a sample is in at most three of them
    w = F.floor(F.col("sample") / half).cast("long")
    spots = known.where(F.col("__range") > most_range).withColumn("w", F.explode(F.array(*[w - i for i in range(-(-window // half))])))
    starts = F.col("w") * half
    in_window = (F.col("w") >= 0) & (starts < F.col("__n") - window) & (F.col("sample") < starts + window)
    wide = spots.where(in_window).groupBy(*K, "w").agg(spread().alias("r")).where(F.col("r") > most_range)
    jumps = wide.select(*S, F.explode(F.sequence(F.col("w") * half, F.col("w") * half + window - 1)).alias("sample"), F.lit(True).alias("bad"))
    per = (
        loud.select(*S, "sample", "bad").unionByName(jumps.select(*S, F.col("sample").cast("long").alias("sample"), "bad"))
        .groupBy(*S, "sample")
        .agg(F.max("bad").alias("bad"))
    )
    before = kernel // 2
    return over_frames(per, S, "sample", before, kernel - 1 - before, block, {"wide": lambda win: F.max("bad").over(win)}).select(
        *S, "sample", F.col("wide").alias("bad")
    )


def _listed(samples: DataFrame, channels: DataFrame | None) -> DataFrame:
    return samples if channels is None else samples.join(channels.select("channel").distinct(), "channel", "left_semi")


def channels_clipped(samples: DataFrame, least: float = 0.5, flat: float = 0.1, n_std: float = 5.0, channels: DataFrame | None = None) -> DataFrame:
    """Active channels by the std after clipping; all channels of a session if none is active.

    ``channels`` (column channel) restricts which are looked at.
    """
    samples = _listed(samples, channels)
    m = samples.groupBy(*K).agg(F.avg("x").alias("__m"), F.stddev_pop("x").alias("__s"))
    lo, hi = F.col("__m") - n_std * F.col("__s"), F.col("__m") + n_std * F.col("__s")
    per = (
        attach(samples, m, K)
        .groupBy(*K)
        .agg(F.stddev_pop(F.least(F.greatest(F.col("x"), lo), hi)).alias("std"))
        .withColumn("active", (F.col("std") > least) & (F.col("std") >= flat))
    )
    any_active = per.groupBy(*S).agg(F.max("active").alias("__any"))
    return per.join(any_active, S).select(*K, "std", (F.col("active") | ~F.col("__any")).alias("chosen"))


def channel_status(
    samples: DataFrame, mask: DataFrame, least: float = 0.05, most: float = 1000.0, good_share: float = 0.3,
    channels: DataFrame | None = None,
) -> DataFrame:
    """Status and reason per channel from its good samples; ``channels`` restricts which are looked at."""
    joined = _listed(samples, channels).join(mask, [*S, "sample"])
    good = F.when(~F.col("bad"), F.col("x"))
    per = joined.groupBy(*K).agg(
        F.count(F.lit(1)).alias("n"), F.count(good).alias("n_good"), F.stddev_pop(good).alias("s"), F.avg(good).alias("mean")
    )
    few = F.col("n_good") < F.col("n") * good_share
    reason = (
        F.when(few, "too many artifacts")
        .when(F.col("s") < least, "flat signal")
        .when(F.col("s") > most, "extreme artifacts")
        .otherwise("")
    )
    return per.withColumn("reason", reason).select(
        *K, F.when(~few, F.col("s")).alias("std"), F.when(F.col("reason") == "", "good").otherwise("bad").alias("status"), "reason"
    )


_PAIR = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("session_id", "a", "b", "n")] + [T.StructField(c, T.DoubleType()) for c in ("sa", "sb", "saa", "sbb", "sab")]
)


def _by_channel(table: pa.Table, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Channels, and their values side by side: a row per sample, the mean of rows that repeat, NaN without one."""
    table = table.select(["sample", "channel", value]).drop_null()
    x = np.asarray(table.column(value).combine_chunks(), dtype="float64")
    known = ~np.isnan(x)
    samples, row = np.unique(np.asarray(table.column("sample").combine_chunks())[known], return_inverse=True)
    channels, col = np.unique(np.asarray(table.column("channel").combine_chunks())[known], return_inverse=True)
    at = row * len(channels) + col
    n = np.bincount(at, minlength=len(samples) * len(channels))
    sums = np.bincount(at, weights=x[known], minlength=len(n))
    with np.errstate(invalid="ignore"):
        return channels, (sums / n).reshape(len(samples), len(channels))


def _as_table(columns: dict, schema: T.StructType, session) -> pa.Table:
    arrow = to_arrow_schema(schema)
    n = len(next(iter(columns.values())))
    return pa.table([pa.array([session] * n if f.name == "session_id" else columns[f.name], f.type) for f in arrow], schema=arrow)


def _moments(table: pa.Table) -> pa.Table:
    """Sums for all channel pairs of one stretch of samples."""
    ch, x = _by_channel(table, "y")
    ok = ~np.isnan(x)
    z = np.where(ok, x, 0.0)
    m = ok.astype(float)
    n, sab = m.T @ m, z.T @ z
    sa, saa = z.T @ m, (z * z).T @ m
    i, j = np.triu_indices(x.shape[1], 1)
    sums = {"a": ch[i], "b": ch[j], "n": n[i, j].astype("int64"), "sa": sa[i, j], "sb": sa[j, i], "saa": saa[i, j], "sbb": saa[j, i], "sab": sab[i, j]}
    return _as_table(sums, _PAIR, table.column("session_id")[0].as_py())


def correlations(samples: DataFrame, block: int = 50_000) -> DataFrame:
    """Correlation of every two channels of a session.

    A device has a few dozen channels.  Stretches of ``block`` samples are
    reduced to one row of sums per pair in parallel, and only those rows are
    added up, so a long session never sits in one task.
    """
    centre = samples.groupBy(*K).agg(F.avg("x").alias("__m"))  # centred sums do not cancel
    parts = (
        attach(samples.select(*K, "sample", "x"), centre, K)
        .select(*K, "sample", (F.col("x") - F.col("__m")).alias("y"), F.floor(F.col("sample") / block).alias("block"))
        .groupBy(*S, "block")
        .applyInArrow(_moments, _PAIR)
    )
    t = parts.groupBy(*S, "a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    n = F.col("n")
    cov = F.col("sab") - F.col("sa") * F.col("sb") / n
    va, vb = F.col("saa") - F.pow("sa", F.lit(2.0)) / n, F.col("sbb") - F.pow("sb", F.lit(2.0)) / n
    return t.select(*S, "a", "b", F.when((va > 0) & (vb > 0), cov / F.sqrt(va * vb)).alias("corr"))


def correlated_pairs(corr: DataFrame, above: float = 0.95) -> DataFrame:
    return corr.where(F.abs("corr") > above)


def without_duplicates(channels: DataFrame, corr: DataFrame, above: float = 0.98) -> DataFrame:
    """Channels without the later one of each nearly identical pair."""
    later = corr.where(F.abs("corr") > above).select(*S, F.col("b").alias("channel")).distinct()
    return channels.join(later, K, "left_anti")


_JOINT = T.StructType(
    [T.StructField(c, T.IntegerType() if c in ("i", "j") else T.LongType()) for c in ("session_id", "a", "b", "i", "j", "n")]
)


def _joint_counts(table: pa.Table) -> pa.Table:
    """Joint histogram of all channel pairs of one stretch of samples."""
    ch, x = _by_channel(table, "bin")
    out: dict[str, list] = {c: [] for c in ("a", "b", "i", "j", "n")}
    for p in range(len(ch)):
        for q in range(p + 1, len(ch)):
            ok = ~(np.isnan(x[:, p]) | np.isnan(x[:, q]))
            code, n = np.unique(x[ok, p].astype("int64") * 100_000 + x[ok, q].astype("int64"), return_counts=True)
            for c, v in zip(out, (np.full(len(n), ch[p]), np.full(len(n), ch[q]), code // 100_000, code % 100_000, n), strict=True):
                out[c].append(v)
    columns = {c: np.concatenate(v) if v else [] for c, v in out.items()}
    return _as_table(columns, _JOINT, table.column("session_id")[0].as_py())


def mutual_information(samples: DataFrame, bins: int = 8, block: int = 50_000) -> DataFrame:
    """Histogram estimate, in nats, for every two channels of a session."""
    ends = samples.groupBy(*K).agg(F.min("x").alias("__lo"), F.max("x").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    bin_of = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("__lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    parts = (
        attach(samples.select(*K, "sample", "x"), ends, K)
        .select(*K, "sample", bin_of.alias("bin"), F.floor(F.col("sample") / block).alias("block"))
        .groupBy(*S, "block")
        .applyInArrow(_joint_counts, _JOINT)
    )
    joint = parts.groupBy(*S, "a", "b", "i", "j").agg(F.sum("n").alias("n"))
    pair = Window.partitionBy(*S, "a", "b")  # at most bins x bins rows
    total, pa, pb = F.sum("n").over(pair), F.sum("n").over(pair.partitionBy(*S, "a", "b", "i")), F.sum("n").over(pair.partitionBy(*S, "a", "b", "j"))
    term = F.col("n") / F.col("t") * F.ln(F.col("n") * F.col("t") / (F.col("pa") * F.col("pb")))
    return (
        joint.withColumn("t", total)
        .withColumn("pa", pa)
        .withColumn("pb", pb)
        .groupBy(*S, "a", "b")
        .agg(F.sum(term).alias("mi"))
    )


def equal_segments(samples: DataFrame, n: int) -> DataFrame:
    """Add ``segment``: n equal stretches per channel, the rest goes to the last."""
    length = samples.groupBy(*K).agg((F.max("sample") + 1).alias("__n"))
    size = F.greatest(F.floor(F.col("__n") / n), F.lit(1))
    seg = F.least(F.floor(F.col("sample") / size), F.lit(n - 1)).cast("int")
    return attach(samples, length, K).withColumn("segment", seg).drop("__n")


def stability(samples: DataFrame, mean_limit: float = 10.0, std_limit: float = 5.0) -> DataFrame:
    """Mean absolute change of mean and std over thirds of each channel."""
    per = equal_segments(samples, 3).groupBy(*K, "segment").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    w = Window.partitionBy(*K).orderBy("segment")  # three rows
    steps = per.select(*K, F.abs(F.col("m") - F.lag("m").over(w)).alias("dm"), F.abs(F.col("s") - F.lag("s").over(w)).alias("ds"))
    return (
        steps.groupBy(*K)
        .agg(F.avg("dm").alias("mean_change"), F.avg("ds").alias("std_change"))
        .withColumn("unstable_mean", F.col("mean_change") > mean_limit)
        .withColumn("unstable_std", F.col("std_change") > std_limit)
    )


def window_metrics(samples: DataFrame, size: int) -> DataFrame:
    """Mean, std and excess kurtosis of complete tumbling windows."""
    return (
        samples.groupBy(*K, tumbling(samples, size).alias("window"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.kurtosis("x").alias("kurtosis"))
        .where(F.col("n") == size)
        .drop("n")
    )


def pick_channels(stats: DataFrame, n: int = 6) -> DataFrame:
    """Half of the channels by highest std, then around the median, the rest lowest.

    ``stats`` has one row per channel; a device has a few dozen.
    """
    w = Window.partitionBy(*S)
    r = F.row_number().over(w.orderBy("std", "channel")) - 1
    size = F.count(F.lit(1)).over(w)
    high = -(-n // 2)
    ranked = stats.withColumn("r", r).withColumn("size", size)
    mid = F.floor(F.col("size") / 2)
    chosen = high + 2 * (n // 4)
    return ranked.where(
        (F.col("r") >= F.col("size") - high)
        | ((F.col("r") >= mid - n // 4) & (F.col("r") < mid + n // 4))
        | (F.col("r") < max(n - chosen, 0))
    ).select(*S, "channel", "std")


# A published rational approximation of the inverse normal
# distribution, relative error below 1.2e-9: numerators and denominators of its
# middle part (in powers of q^2) and of its tails, highest power first.
MIDDLE = (
    [-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239],
    [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0],
)
TAIL = (
    [-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783],
    [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0],
)
TAIL_BELOW = 0.02425


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile as column arithmetic."""

    def poly(coefficients: list[float], x: Column) -> Column:
        out = F.lit(coefficients[0])
        for c in coefficients[1:]:
            out = out * x + F.lit(c)
        return out

    q = p - 0.5
    middle = poly(MIDDLE[0], q * q) * q / poly(MIDDLE[1], q * q)
    near = F.least(p, 1.0 - p)
    t = F.sqrt(-2.0 * F.ln(near))
    tail = poly(TAIL[0], t) / poly(TAIL[1], t)
    return F.when(near >= TAIL_BELOW, middle).when(p < 0.5, tail).otherwise(-tail)


def normal_quantiles(samples: DataFrame, value_slice: float) -> DataFrame:
    """Ordered values of each channel with the normal quantile of their rank.

    Equal values are counted first: values are ranked by the counts before
    them, in slices, and a value's samples follow each other in sample order
    through the places 0, 1, ... of stretches of samples.  Plotting positions
    are (i - 0.3175) / (n + 0.365), with 0.5^(1/n) at the ends.
    """
    rows = samples.select(*K, "sample", "x")
    n = rows.groupBy(*K).agg(F.count(F.lit(1)).alias("n"))
    counted = rows.groupBy(*K, "x").agg(F.count(F.lit(1)).alias("__c"))
    upto = over_slices(counted, K, ["x"], value_slice, sums={"__to": "__c"})
    single = upto.select(*K, "x", (F.col("__to") - F.col("__c")).alias("__before"), "__c")
    among = over_slices(rows, [*K, "x"], ["sample"], 1_000_000, rank="__place")
    ranked = among.join(single, [*K, "x"]).withColumn("rank", (F.col("__before") + F.col("__place")).cast("long"))
    i, c = F.col("rank"), F.col("n")
    top = F.pow(F.lit(0.5), 1.0 / c)
    p = F.when(i == 1, 1.0 - top).when(i == c, top).otherwise((i - 0.3175) / (c + 0.365))
    return attach(ranked.select(*K, "rank", "x"), n, K).select(*K, "rank", "x", inverse_normal(p).alias("normal"))


def exclude(samples: DataFrame, channels: list[int], zero: bool = False) -> DataFrame:
    """Drop the listed channels, or set them to zero."""
    listed = F.col("channel").isin(channels)
    if zero:
        return samples.withColumn("x", F.when(listed, F.lit(0.0)).otherwise(F.col("x")))
    return samples.where(~listed)


def finite_check(samples: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """NaN and infinite samples per session, over the active channels."""
    rows = samples if active is None else attach(samples, active.select(*K), K)
    return rows.groupBy(*S).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.isnan("x")).alias("n_nan"), F.count_if(F.abs("x") == float("inf")).alias("n_inf")
    )


