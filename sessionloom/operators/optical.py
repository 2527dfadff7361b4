"""Optical channels: the index dimension, distances, coverage and value checks.

Cells come as (file_id, frame, channel, value); -inf marks an unused channel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.joins import attach, with_row
from ..functions.ordered import first_k
from ..functions.quantiles import exact_quantiles

FILE = ["file_id"]

# Sizes of the mixed-radix channel index, slowest digit first.
WAVELENGTHS, MOMENTS, MODULES, SOURCES, DETECTORS = 2, 3, 48, 3, 6
N_CHANNELS = WAVELENGTHS * MOMENTS * MODULES * SOURCES * MODULES * DETECTORS
PAIRS = MODULES * SOURCES * MODULES * DETECTORS  # channels of one wavelength and moment
WAVE_NAMES = ["Red", "IR"]
MOMENT_NAMES = ["Zeroth", "First", "Second"]

NEG_INF = float("-inf")


def encode(wave: Column, moment: Column, src_mod: Column, src: Column, det_mod: Column, det: Column) -> Column:
    """Channel number of 0-based wavelength and moment and 1-based modules and ids."""
    source = (src_mod - 1) * SOURCES + (src - 1)
    detector = (det_mod - 1) * DETECTORS + (det - 1)
    return ((wave * MOMENTS + moment) * (MODULES * SOURCES) + source) * (MODULES * DETECTORS) + detector


def decode(df: DataFrame, channel: str = "channel") -> DataFrame:
    """Add the six digits of a channel number; null outside the index."""
    c = F.when((F.col(channel) >= 0) & (F.col(channel) < N_CHANNELS), F.col(channel).cast("long"))
    div = lambda x, n: F.floor(x / F.lit(n)).cast("int")
    return df.withColumns(
        {
            "det_id": (c % DETECTORS + 1).cast("int"),
            "det_mod": div(c, DETECTORS) % MODULES + 1,
            "src_id": div(c, DETECTORS * MODULES) % SOURCES + 1,
            "src_mod": div(c, DETECTORS * MODULES * SOURCES) % MODULES + 1,
            "moment": div(c, PAIRS) % MOMENTS,
            "wave": div(c, PAIRS * MOMENTS),
        }
    )


def pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index + 1)


def with_name(df: DataFrame) -> DataFrame:
    """Add the name of a decoded channel, such as W0(Red)_M0(Zeroth)_S1_1_D1_1."""
    name = F.format_string(
        "W%d(%s)_M%d(%s)_S%d_%d_D%d_%d",
        "wave",
        pick(WAVE_NAMES, F.col("wave")),
        "moment",
        pick(MOMENT_NAMES, F.col("moment")),
        "src_mod",
        "src_id",
        "det_mod",
        "det_id",
    )
    return df.withColumn("name", name)


def channels(spark: SparkSession) -> DataFrame:
    """The whole channel dimension with names."""
    return with_name(decode(spark.range(N_CHANNELS).withColumnRenamed("id", "channel")))


def valid_channels(dimension: DataFrame, modules: DataFrame) -> DataFrame:
    """Channels whose source and detector modules are both present (column ``mod``)."""
    mods = F.broadcast(modules.where(F.col("mod").between(1, MODULES)).select("mod").distinct())  # at most 48 rows
    src = dimension.join(mods.withColumnRenamed("mod", "src_mod"), "src_mod", "left_semi")
    return src.join(mods.withColumnRenamed("mod", "det_mod"), "det_mod", "left_semi")


def by_category(valid: DataFrame) -> DataFrame:
    """Channel counts per wavelength, moment, and both; -1 stands for all."""
    cube = valid.groupBy("wave", "moment").agg(
        F.count(F.lit(1)).alias("n"), F.min("channel").alias("first_channel"), F.max("channel").alias("last_channel")
    )
    roll = lambda keys: cube.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("first_channel").alias("first_channel"), F.max("last_channel").alias("last_channel")
    )
    allm, allw = F.lit(-1).alias("moment"), F.lit(-1).alias("wave")
    tail = ["n", "first_channel", "last_channel"]
    return (
        cube.select("wave", "moment", *tail)
        .unionByName(roll(["wave"]).select("wave", allm, *tail))
        .unionByName(roll(["moment"]).select(allw, "moment", *tail))
    )


def distances(decoded: DataFrame, layout: DataFrame) -> DataFrame:
    """Source-detector distance; infinite when a position is unknown.

    ``layout`` has kind, mod, part, x, y, z: at most 48 modules with 3 sources
    and 6 detectors, so both position tables fit any broadcast.
    """
    def place(kind: str, most: int, m: str, i: str, p: str) -> DataFrame:
        inside = (F.col("kind") == kind) & F.col("mod").between(1, MODULES) & F.col("part").between(1, most)
        one = layout.where(inside).groupBy(F.col("mod").alias(m), F.col("part").alias(i))
        return F.broadcast(one.agg(*[F.min(c).alias(p + c) for c in "xyz"]))  # at most 48 x 6 rows

    far = F.sqrt(sum(F.pow(F.col(f"s{c}") - F.col(f"d{c}"), F.lit(2.0)) for c in "xyz"))
    return (
        decoded.join(place("source", SOURCES, "src_mod", "src_id", "s"), ["src_mod", "src_id"], "left")
        .join(place("detector", DETECTORS, "det_mod", "det_id", "d"), ["det_mod", "det_id"], "left")
        .withColumn("distance", F.coalesce(far, F.lit(float("inf"))))
        .drop("sx", "sy", "sz", "dx", "dy", "dz")
    )


def feasible(
    with_distance: DataFrame,
    modules: DataFrame | None = None,
    longest: float = 60.0,
    shortest: float | None = None,
    same_module: bool | None = None,
) -> DataFrame:
    """Channels within a distance, optionally of present modules only."""
    out = with_distance if modules is None else valid_channels(with_distance, modules)
    out = out.where(F.col("distance") <= longest)
    if shortest is not None:
        out = out.where(F.col("distance") >= shortest)
    if same_module is not None:
        same = F.col("src_mod") == F.col("det_mod")
        out = out.where(same if same_module else ~same)
    return out


# Distance thresholds and ranges of the profile.
THRESHOLDS = [1, 2, 3, 4, 5, 10, 15, 20, 30, 40, 50]
RANGES = [(0, 1), (1, 3), (3, 5), (5, 10), (10, 20), (20, 30), (30, 50), (50, math.inf)]


def distance_profile(with_distance: DataFrame) -> DataFrame:
    """Channels below each threshold and inside each range, as count and percent."""
    d = F.col("distance")
    counted = with_distance.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(d < t).alias(f"below_{t}") for t in THRESHOLDS],
        *[F.count_if((d >= lo) if hi == math.inf else (d >= lo) & (d < hi)).alias(f"in_{lo}") for lo, hi in RANGES],
    )
    rows = [F.struct(F.lit("below").alias("kind"), F.lit(float(t)).alias("bound"), F.col(f"below_{t}").alias("n")) for t in THRESHOLDS]
    rows += [F.struct(F.lit("range_from").alias("kind"), F.lit(float(lo)).alias("bound"), F.col(f"in_{lo}").alias("n")) for lo, _ in RANGES]
    return (
        counted.select("total", F.explode(F.array(*rows)).alias("r"))
        .select("r.*", (F.col("r.n") / F.nullif(F.col("total"), F.lit(0)) * 100.0).alias("percent"))
    )


def same_module_distances(with_distance: DataFrame) -> DataFrame:
    return (
        with_distance.where("src_mod = det_mod")
        .groupBy("src_id", "det_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("distance").alias("min_distance"),
            F.max("distance").alias("max_distance"),
            F.avg("distance").alias("mean_distance"),
        )
    )


def _known(kept: DataFrame) -> DataFrame:
    """Distinct channel numbers of the dimension, so at most 248,832 rows."""
    return kept.where(F.col("channel").between(0, N_CHANNELS - 1)).select("channel").distinct()


def prune(cells: DataFrame, kept: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Cells of the kept channels; all cells of a file whose channels end before the first kept one.

    ``kept`` is a subset of the channel dimension.
    """
    known = _known(kept)
    lowest = known.agg(F.min("channel").alias("m")).scalar()
    top = cells.groupBy(*keys).agg(F.max("channel").alias("__top"))
    flagged = cells.join(F.broadcast(known.withColumn("__keep", F.lit(True))), "channel", "left")
    flagged = attach(flagged, top, keys).withColumn("__lowest", lowest)
    return flagged.where("__keep OR __lowest IS NULL OR __lowest > __top").select(*cells.columns)


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def validity(cells: DataFrame, kept: DataFrame, keys: list[str] = FILE, first_frames: int | None = None) -> DataFrame:
    """Per file: valid channels among the kept and the other ones.

    A kept channel without cells is not valid, but counts for the percent.
    ``first_frames`` restricts the look to the first frames if it is given.
    """
    seen = cells if first_frames is None else cells.where(F.col("frame") < first_frames)
    per = seen.groupBy(*keys, "channel").agg(F.max(finite(F.col("value")).cast("int")).alias("valid"))
    inside = F.broadcast(_known(kept).withColumn("__kept", F.lit(1)))
    n = F.lit(_known(kept).agg(F.count(F.lit(1)).alias("n")).scalar())
    j = per.join(inside, "channel", "left")
    return (
        j.groupBy(*keys)
        .agg(
            F.count_if((F.col("__kept") == 1) & (F.col("valid") == 1)).alias("included_valid"),
            F.count_if(F.col("__kept").isNull() & (F.col("valid") == 1)).alias("excluded_valid"),
        )
        .withColumn("included_invalid", n - F.col("included_valid"))
        .withColumn("valid_percent", F.col("included_valid") / F.nullif(n, F.lit(0)) * 100.0)
    )


def describe(decoded_cells: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Per file: statistics of the logarithm of positive values per moment and wavelength."""
    keys = [*keys, "moment", "wave"]
    v = F.col("value")
    # ln(inf) is infinite and left out like NaN; infinities count as data points
    logged = decoded_cells.select(*keys, F.when((v > 0) & finite(v), F.ln(v)).alias("x"))
    stats = logged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.count("x").alias("n"),
        F.count_if(F.col("x") != 0).alias("n_nonzero"),
        F.min("x").alias("min"),
        F.avg("x").alias("mean"),
        F.max("x").alias("max"),
        F.stddev_pop("x").alias("std"),
    )
    q = exact_quantiles(logged, keys, "x", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    return (
        stats.join(q, keys, "left")
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .withColumn("finite_nonzero_percent", F.col("n_nonzero") / F.col("n_points") * 100.0)
    )


def per_channel_flags(cells: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Per channel of a file: was a value other than -inf ever seen, was -inf ever seen."""
    gone = F.col("value") == NEG_INF
    return cells.groupBy(*keys, "channel").agg(
        F.max((~gone).cast("int")).alias("ever_valid"), F.max(gone.cast("int")).alias("ever_inf")
    )


def ever_valid(cells: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Per file: ever-valid and always -inf channels and valid source-detector pairs.

    A channel of the dimension without any cell counts as always -inf.
    """
    seen = F.col("ever_valid") == 1
    return per_channel_flags(cells, keys).groupBy(*keys).agg(
        F.count_if(seen).alias("ever_valid_channels"),
        (F.lit(N_CHANNELS) - F.count_if(seen)).alias("always_inf_channels"),
        F.count_distinct(F.when(seen, F.col("channel") % PAIRS)).alias("valid_pairs"),
    )


def module_pairs(cells: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Ever-valid channels per file, source module and detector module; sets hold ids 1..6."""
    ids = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return (
        decode(per_channel_flags(cells, keys).where("ever_valid = 1"))
        .groupBy(*keys, "src_mod", "det_mod")
        .agg(
            F.count(F.lit(1)).alias("n_channels"),
            ids("src_id").alias("source_ids"),
            ids("det_id").alias("detector_ids"),
            F.count_distinct("src_id", "det_id").alias("n_pairs"),
        )
    )


def evenly_spaced(cells: DataFrame, n: int, frame: str = "frame", keys: list[str] = FILE) -> DataFrame:
    """Cells of ``n`` evenly spaced frames out of 0..last of their file, decided row by row."""
    last = cells.groupBy(*keys).agg(F.max(frame).cast("double").alias("__last"))
    f = F.col(frame)
    # frame i*step (rounded down), i = 0..n-1; all frames when there are at most n
    step = F.greatest(F.lit(1.0), F.col("__last") / F.lit(float(max(n - 1, 1))))
    i = F.floor(f / step)
    hit = lambda k: (F.floor(k * step) == f) & (k <= n - 1)
    few = F.col("__last") + 1 <= n
    return attach(cells, last, keys).where(few | hit(i) | hit(i + 1)).select(*cells.columns)


def random_frames(cells: DataFrame, n: int, seed: int, frame: str = "frame", keys: list[str] = FILE) -> DataFrame:
    """Frame numbers of a reproducible random sample of each file."""
    key = F.md5(F.concat_ws("-", F.col(frame).cast("string"), F.lit(str(seed))))
    return first_k(cells.select(*keys, frame).distinct(), keys, [key, frame], n, "__rank").drop("__rank")


def transitions(cells: DataFrame, n_frames: int, keys: list[str] = FILE) -> DataFrame:
    """Channels of a file that are valid in some of its sampled frames and -inf in others.

    The frame lists hold at most ``n_frames`` numbers.
    """
    gone = F.col("value") == NEG_INF
    frames = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("frame")))), ",")
    per = evenly_spaced(cells, n_frames, keys=keys).groupBy(*keys, "channel").agg(
        frames(~gone).alias("valid_frames"), frames(gone).alias("inf_frames")
    )
    return with_name(decode(per.where("valid_frames <> '' AND inf_frames <> ''")))


def transitioning_pairs(cells: DataFrame, n_frames: int, keys: list[str] = FILE) -> DataFrame:
    """Source-detector pairs of a file seen both valid and -inf in its sampled frames."""
    gone = F.col("value") == NEG_INF
    return (
        evenly_spaced(cells, n_frames, keys=keys)
        .groupBy(*keys, (F.col("channel") % PAIRS).alias("pair"))
        .agg(
            F.count_distinct(F.when(~gone, F.col("frame"))).alias("n_valid_frames"),
            F.count_distinct(F.when(gone, F.col("frame"))).alias("n_inf_frames"),
        )
        .where("n_valid_frames > 0 AND n_inf_frames > 0")
    )


def pair_consistency(cells: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Per file: pairs whose six channels are all, partly or never valid.

    Channels and pairs without cells count as -inf.
    """
    each = WAVELENGTHS * MOMENTS
    pairs = (
        per_channel_flags(cells, keys)
        .groupBy(*keys, (F.col("channel") % PAIRS).alias("pair"))
        .agg(F.sum("ever_valid").alias("v"))
    )
    return (
        pairs.groupBy(*keys)
        .agg(
            F.count_if(F.col("v") == each).alias("fully_valid"),
            F.count_if((F.col("v") > 0) & (F.col("v") < each)).alias("partly_valid"),
        )
        .withColumn("fully_invalid", F.lit(PAIRS) - F.col("fully_valid") - F.col("partly_valid"))
    )


def mixed_pairs(cells: DataFrame, k: int = 10, keys: list[str] = FILE) -> DataFrame:
    """The first ``k`` (frame, pair) of each file with valid and -inf channels at once."""
    gone = F.col("value") == NEG_INF
    mixed = (
        cells.groupBy(*keys, "frame", (F.col("channel") % PAIRS).alias("pair"))
        .agg(F.count_if(~gone).alias("n_valid"), F.count_if(gone).alias("n_inf"))
        .where("n_valid > 0 AND n_inf > 0")
    )
    return first_k(mixed, keys, ["frame", "pair"], k, "__rank").drop("__rank")


def value_stats(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Shares of infinite, NaN, zero and non-zero values; statistics of finite ones."""
    v = F.col("value")
    share = lambda c: F.count_if(c) / F.count(F.lit(1)) * 100.0
    ok = cells.withColumn("x", F.when(finite(v), v))
    stats = ok.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        share(v == NEG_INF).alias("neg_inf_percent"),
        share(v == float("inf")).alias("pos_inf_percent"),
        share(F.isnan(v)).alias("nan_percent"),
        share(v == 0).alias("zero_percent"),
        share(F.col("x").isNotNull() & (F.col("x") != 0)).alias("nonzero_percent"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("std"),
    )
    median = exact_quantiles(ok, keys, "x", [0.5], ["median"])
    return stats.join(median, keys, "left") if keys else with_row(stats, median)


def file_coverage(cells: DataFrame) -> DataFrame:
    """Per file: channels without any -inf, and their percent of those seen."""
    per = cells.groupBy("file_id", "channel").agg(F.max((F.col("value") == NEG_INF).cast("int")).alias("inf"))
    return (
        per.groupBy("file_id")
        .agg(F.count(F.lit(1)).alias("n_channels"), F.sum("inf").alias("inf_channels"))
        .withColumn("valid_channels", F.col("n_channels") - F.col("inf_channels"))
        .withColumn("valid_percent", F.col("valid_channels") / F.col("n_channels") * 100.0)
    )


def corpus_summary(coverage: DataFrame) -> DataFrame:
    """Mean valid percent, best and worst file (lowest id on ties)."""
    rank = F.struct("valid_percent", (-F.col("file_id")).alias("o"))
    low = F.struct("valid_percent", "file_id")
    return coverage.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.avg("valid_percent").alias("mean_valid_percent"),
        F.max_by("file_id", rank).alias("best_file"),
        F.max("valid_percent").alias("best_percent"),
        F.min_by("file_id", low).alias("worst_file"),
        F.min("valid_percent").alias("worst_percent"),
    )


def map_channels(measurements: DataFrame) -> DataFrame:
    """Measurement list with wavelength and moment names, group and position."""
    return decode(measurements).select(
        *measurements.columns,
        pick(WAVE_NAMES, F.col("wave")).alias("wavelength"),
        pick(MOMENT_NAMES, F.col("moment")).alias("moment_name"),
        (F.col("wave") + 1).alias("wavelength_index"),
        (F.col("moment") + 1).alias("data_type_index"),
        F.col("src_mod").alias("source_group"),
        F.col("src_id").alias("source_position"),
        F.col("det_mod").alias("detector_group"),
        F.col("det_id").alias("detector_position"),
    )


def filter_channels(mapped: DataFrame, **allowed: list) -> DataFrame:
    """Rows whose columns are all among the allowed values; an empty list allows all."""
    for column, values in allowed.items():
        if values:
            mapped = mapped.where(F.col(column).isin(values))
    return mapped


def valid_above(cells: DataFrame, least: float = 0.0, keys: list[str] = FILE) -> DataFrame:
    """Channels of each file with a finite value above ``least``."""
    return (
        cells.groupBy(*keys, "channel")
        .agg(F.max(F.when(finite(F.col("value")), F.col("value"))).alias("top"))
        .where(F.col("top") > least)
        .select(*keys, "channel")
    )


def infinite_cells(cells: DataFrame, k: int = 20, keys: list[str] = FILE) -> DataFrame:
    """The first ``k`` infinite cells of each file in (frame, channel) order; smaller values first on ties."""
    found = cells.where(F.abs("value") == float("inf"))
    return first_k(found, keys, ["frame", "channel", "value"], k, "__rank").drop("__rank")


def inf_by_frame_channel(cells: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """-inf cells per file, frame and channel, and whether all cells there are -inf."""
    gone = F.col("value") == NEG_INF
    return (
        cells.groupBy(*keys, "frame", "channel")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(gone).alias("n_inf"))
        .where("n_inf > 0")
        .withColumn("fully_inf", F.col("n") == F.col("n_inf"))
    )


# Percentiles of the audit.
LADDER = [0, 0.1, 1, 5, 10, 25, 50, 75, 90, 95, 99, 99.9, 100]


def value_audit(cells: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Per file: counts of troublesome values, and channels with any and with only such values."""
    v = F.col("value")
    kinds = {
        "nan": F.isnan(v),
        "inf": F.abs(v) == float("inf"),
        "zero": v == 0,
        "negative": (v < 0) & (v != NEG_INF),
    }
    per = cells.groupBy(*keys, "channel").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in kinds.items()]
    )
    return per.groupBy(*keys).agg(
        F.sum("n").alias("total"),
        *[F.sum(k).alias(f"n_{k}") for k in kinds],
        *[F.count_if(F.col(k) > 0).alias(f"channels_with_{k}") for k in kinds],
        *[F.count_if(F.col(k) == F.col("n")).alias(f"channels_all_{k}") for k in kinds],
    )


def value_ladder(cells: DataFrame, keys: list[str] = FILE) -> DataFrame:
    """Percentiles of the positive finite values of each file."""
    v = F.col("value")
    names = [f"p{i}" for i in range(len(LADDER))]
    q = exact_quantiles(cells.where(finite(v) & (v > 0)), keys, "value", [p / 100.0 for p in LADDER], names)
    rows = [F.struct(F.lit(float(p)).alias("percentile"), F.col(n).alias("value")) for p, n in zip(LADDER, names)]
    return q.select(*keys, F.explode(F.array(*rows)).alias("r")).select(*keys, "r.*")


# --- sensor positions -----------------------------------------------------


def nearest_within(a: DataFrame, b: DataFrame, tolerance: float) -> DataFrame:
    """The nearest point of ``b`` (id, x, y, z) for each point of ``a``, if closer than ``tolerance``.

    Space is cut into cubes of the tolerance, so only points of the 27 cubes
    around a point are compared.  Equal positions of ``b`` are merged first:
    the lowest id stands for them.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(tolerance)).cast("long")
    around = lambda c: F.explode(F.array(cell(c) - 1, cell(c), cell(c) + 1))
    places = b.groupBy("x", "y", "z").agg(F.min("id").alias("b_id"))
    b_cells = places.select(
        "b_id", F.col("x").alias("bx"), F.col("y").alias("by"), F.col("z").alias("bz"), cell("x").alias("cx"), cell("y").alias("cy"), cell("z").alias("cz")
    )
    spread = a.withColumn("cx", around("x")).withColumn("cy", around("y")).withColumn("cz", around("z"))
    d = F.sqrt(F.pow(F.col("x") - F.col("bx"), 2.0) + F.pow(F.col("y") - F.col("by"), 2.0) + F.pow(F.col("z") - F.col("bz"), 2.0))
    return (
        spread.join(b_cells, ["cx", "cy", "cz"])
        .withColumn("distance", d)
        .where(F.col("distance") < tolerance)
        .groupBy(*[c for c in a.columns])
        .agg(F.min(F.struct("distance", "b_id")).alias("m"))
        .select(*a.columns, F.col("m.b_id").alias("nearest_id"), F.col("m.distance").alias("distance"))
    )


def compare_positions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positions by id: matched with differences, extra in ``a``, missing in ``a``."""
    p = a.select("id", *[F.col(c).alias(f"a{c}") for c in "xyz"], F.lit(1).alias("in_a"))
    q = b.select("id", *[F.col(c).alias(f"b{c}") for c in "xyz"], F.lit(1).alias("in_b"))
    d = {f"d{c}": F.col(f"a{c}") - F.col(f"b{c}") for c in "xyz"}
    status = (
        F.when(F.col("in_b").isNull(), "extra").when(F.col("in_a").isNull(), "missing").otherwise("matched")
    )
    return (
        p.join(q, "id", "full_outer")
        .withColumns(d)
        .withColumn("distance", F.sqrt(sum(F.pow(F.col(f"d{c}"), F.lit(2.0)) for c in "xyz")))
        .withColumn("status", status)
        .select("id", "status", "dx", "dy", "dz", "distance")
    )


def comparison_summary(compared: DataFrame) -> DataFrame:
    one = lambda s: F.count_if(F.col("status") == s)
    return compared.agg(
        one("matched").alias("matched"),
        one("missing").alias("missing"),
        one("extra").alias("extra"),
        F.max("distance").alias("max_distance"),
        F.min("distance").alias("min_distance"),
        F.avg("distance").alias("avg_distance"),
    )


def matched_detectors(layout: DataFrame, sensors: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Layout detectors with a flag whether a sensor stands at their place."""
    det = layout.where("kind = 'detector'").select("mod", F.col("part").alias("pos"), "x", "y", "z")
    hit = nearest_within(det, sensors.select(F.col("sensor").alias("id"), "x", "y", "z"), tolerance)
    return det.join(hit.select("mod", "pos", F.lit(True).alias("matched")), ["mod", "pos"], "left").withColumn(
        "matched", F.coalesce("matched", F.lit(False))
    )


def module_coverage(layout: DataFrame, sensors: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Matched detectors per module, percent, and the positions present."""
    present = F.array_join(F.sort_array(F.collect_set(F.when(F.col("matched"), F.col("pos")))), ",")
    return (
        matched_detectors(layout, sensors, tolerance)
        .groupBy("mod")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("matched").alias("n_matched"), present.alias("positions"))
        .withColumn("percent", F.col("n_matched") / F.col("total") * 100.0)
    )


def position_frequency(layout: DataFrame, sensors: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """How often each detector position is present, in percent of covered modules."""
    m = matched_detectors(layout, sensors, tolerance).where("matched")
    covered = m.agg(F.count_distinct("mod").alias("n_modules"))
    return with_row(m.groupBy("pos").agg(F.count(F.lit(1)).alias("n")), covered).select(
        "pos", "n", (F.col("n") / F.col("n_modules") * 100.0).alias("percent")
    )


def module_geometry(layout: DataFrame, position: int = 7) -> DataFrame:
    """Centroid of each module, distance of a position from it and its rank.

    A module has at most nine positions.
    """
    w = Window.partitionBy("mod")
    with_c = layout.select("mod", "pos", "x", "y", "z", *[F.avg(c).over(w).alias(f"c{c}") for c in "xyz"])
    dist = with_c.withColumn("distance", F.sqrt(sum(F.pow(F.col(c) - F.col(f"c{c}"), F.lit(2.0)) for c in "xyz")))
    ranked = dist.withColumn("rank", F.row_number().over(w.orderBy("distance", "pos")))
    return ranked.where(F.col("pos") == position).select("mod", "cx", "cy", "cz", "distance", "rank")


# Axis conventions as (name, order of axes, signs after reordering).
AXIS_CONVENTIONS = [
    ("Identity", "xyz", (1, 1, 1)),
    ("Negate X", "xyz", (-1, 1, 1)),
    ("Negate Y", "xyz", (1, -1, 1)),
    ("Negate Z", "xyz", (1, 1, -1)),
    ("Negate X,Y", "xyz", (-1, -1, 1)),
    ("Negate X,Z", "xyz", (-1, 1, -1)),
    ("Negate Y,Z", "xyz", (1, -1, -1)),
    ("Negate X,Y,Z", "xyz", (-1, -1, -1)),
    ("Swap X,Y", "yxz", (1, 1, 1)),
    ("Swap X,Z", "zyx", (1, 1, 1)),
    ("Swap Y,Z", "xzy", (1, 1, 1)),
    ("Swap X,Y Negate X", "yxz", (-1, 1, 1)),
    ("Swap X,Y Negate Y", "yxz", (1, -1, 1)),
    ("Swap X,Z Negate X", "zyx", (-1, 1, 1)),
    ("Swap X,Z Negate Z", "zyx", (1, 1, -1)),
]


def axis_costs(sensors: DataFrame, layout: DataFrame) -> DataFrame:
    """Total distance to the nearest layout position under each axis convention.

    The layout is one array value (a scalar subquery) that every sensor is
    compared with; it describes one device and does not grow with the sensors.
    """
    places = layout.agg(F.collect_list(F.struct("x", "y", "z")).alias("p")).scalar()

    def nearest(order: str, signs: tuple[int, ...]) -> Column:
        turned = [F.col(c) * F.lit(float(s)) for c, s in zip(order, signs)]
        far = lambda p: F.sqrt(sum(F.pow(t - p[c], F.lit(2.0)) for t, c in zip(turned, "xyz")))
        return F.array_min(F.transform("__places", far))

    costs = F.array(*[nearest(order, signs) for _, order, signs in AXIS_CONVENTIONS])
    names = F.array(*[F.lit(n) for n, _, _ in AXIS_CONVENTIONS])
    return (
        sensors.withColumn("__places", places)
        .select(F.posexplode(costs).alias("ord", "d"))
        .groupBy("ord", F.get(names, F.col("ord")).alias("name"))
        .agg(F.sum("d").alias("cost"))
    )


def best_axes(sensors: DataFrame, layout: DataFrame) -> DataFrame:
    costs = axis_costs(sensors, layout)
    return costs.agg(F.min_by("name", F.struct("cost", "ord")).alias("name"), F.min("cost").alias("cost"))


def inventory(measurements: DataFrame) -> DataFrame:
    """Channels, source-detector pairs and wavelengths per file and data type."""
    return (
        decode(measurements)
        .groupBy("file_id", "data_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("src_mod", "src_id", "det_mod", "det_id").alias("n_pairs"),
            F.count_distinct("wave").alias("n_wavelengths"),
        )
    )
