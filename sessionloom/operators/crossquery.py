"""Queries over elements, windows and tokens of all sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import first_containing, points_in_intervals, with_row
from ..functions.ordered import first_k, over_slices

# Label maps in match order, and the label of a map without 'unknown'.
EYE_LABELS = {"close": 0, "open": 1, "intro": 2, "unknown": 3}
BREATH_LABELS = {"hold": 0, "normal": 1, "intro": 2, "unknown": 3}
NO_LABEL = 100

ELEMENT_COLUMNS = ["session_id", "element_id", "task_type", "ordinal", "start_ms", "end_ms"]


def all_elements(elements: DataFrame) -> DataFrame:
    return elements.select(*ELEMENT_COLUMNS)


def filter_elements(elements: DataFrame, **equals) -> DataFrame:
    """Rows equal in all given columns; an unknown column selects nothing."""
    for name, value in equals.items():
        elements = elements.where(F.col(name) == F.lit(value) if name in elements.columns else F.lit(False))
    return elements


def lang_tokens(groups: dict[str, DataFrame]) -> DataFrame:
    """Tokens of all groups in one table with the group name."""
    parts = None
    for name, df in groups.items():
        part = df.withColumn("grp", F.lit(name))
        parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
    return parts


def min_duration(elements: DataFrame, seconds: float) -> DataFrame:
    return elements.where(F.col("end_ms") - F.col("start_ms") >= F.lit(seconds * 1000))


def middle(elements: DataFrame, part: float) -> DataFrame:
    """Add the bounds of the middle ``part`` (0 < part <= 1) of each element."""
    if not 0 < part <= 1:
        raise ValueError("part must be in (0, 1]")
    margin = F.lit((1.0 - part) / 2.0) * (F.col("end_ms") - F.col("start_ms"))
    if part == 1:
        margin = F.lit(0.0)
    return elements.withColumn("mid_start", F.col("start_ms") + margin).withColumn("mid_end", F.col("end_ms") - margin)


def in_range(windows: DataFrame, ranges: DataFrame, start: str, end: str, width: float) -> DataFrame:
    """All (range, window) pairs with the window time inside the closed range."""
    return points_in_intervals(windows, ranges, ["session_id"], "time_ms", start, end, width)


def hits(windows: DataFrame, ranges: DataFrame, start: str, end: str, width: float) -> DataFrame:
    """Windows inside at least one range, each once."""
    return points_in_intervals(windows, ranges.select("session_id", start, end), ["session_id"], "time_ms", start, end, width, "left_semi")


def element_at(points: DataFrame, elements: DataFrame, width: float, point: str = "time_ms", ids: list[str] | None = None) -> DataFrame:
    """The first element (in element order) around each point, as struct ``hit``."""
    return first_containing(
        points,
        elements.select(
            "session_id", "ordinal", "element_id", "task_type", F.col("start_ms").alias("e_start"), F.col("end_ms").alias("e_end")
        ),
        ["session_id"],
        point,
        "e_start",
        "e_end",
        ["ordinal"],
        ["element_id", "task_type"],
        width,
        ids or [point],
    )


def label_of(text: Column, label_map: dict[str, int]) -> Column:
    """Value of the first pattern, in map order, that the text contains."""
    chain = None
    for pattern, value in label_map.items():
        found = text.contains(pattern)
        chain = F.when(found, value) if chain is None else chain.when(found, value)
    missing = F.lit(label_map.get("unknown", NO_LABEL))
    return missing if chain is None else chain.otherwise(missing)


def labels(
    windows: DataFrame, elements: DataFrame, label_map: dict[str, int], width: float, label_field: str = "element_id"
) -> DataFrame:
    """Windows with the label and id of the first element around them."""
    found = element_at(windows, elements, width)
    return (
        found.withColumn("label", label_of(F.coalesce(F.col(f"hit.{label_field}"), F.lit("")), label_map))
        .withColumn("element_id", F.col("hit.element_id"))
        .drop("hit")
    )


def gather(windows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Every column of the chosen windows; arrays are read only for them."""
    return windows.join(chosen.select("session_id", "time_ms"), ["session_id", "time_ms"], "left_semi")


def labelled_windows(
    elements: DataFrame,
    windows: DataFrame,
    equals: dict,
    label_map: dict[str, int],
    width: float,
    seconds: float = 0.0,
    part: float = 1.0,
    label_field: str = "element_id",
) -> DataFrame:
    """Windows in (the middle of) matching elements, with label and element."""
    chosen = min_duration(filter_elements(elements, **equals), seconds)
    bounds = middle(chosen, part)
    found = hits(windows, bounds, "mid_start", "mid_end", width)
    return labels(found, chosen, label_map, width, label_field)


def eye_neural(elements: DataFrame, windows: DataFrame, width: float, label_map: dict[str, int] | None = None) -> DataFrame:
    return labelled_windows(elements, windows, {"task_type": "eye"}, label_map or EYE_LABELS, width)


def eye_good(
    elements: DataFrame, windows: DataFrame, width: float, seconds: float = 10.0, part: float = 0.5, label_map: dict[str, int] | None = None
) -> DataFrame:
    return labelled_windows(elements, windows, {"task_type": "eye"}, label_map or EYE_LABELS, width, seconds, part)


def breath_good(
    elements: DataFrame, windows: DataFrame, width: float, seconds: float = 10.0, part: float = 0.5, label_map: dict[str, int] | None = None
) -> DataFrame:
    return labelled_windows(elements, windows, {"task_type": "breath"}, label_map or BREATH_LABELS, width, seconds, part)


def neuro_lang(
    tokens: DataFrame, elements: DataFrame, windows: DataFrame, width: float, pre_seconds: float = 10.0
) -> DataFrame:
    """(token, window) pairs: windows from ``pre_seconds`` before a token to its end.

    A token outside every element, or without a window, drops out.
    """
    placed = (
        element_at(tokens, elements, width, "start_ms", ["idx"])
        .where("hit IS NOT NULL")
        .withColumn("element_id", F.col("hit.element_id"))
        .withColumn("from_ms", F.greatest(F.lit(0), F.col("start_ms") - F.lit(int(pre_seconds * 1000))))
        .drop("hit")
    )
    return points_in_intervals(windows.select("session_id", "time_ms"), placed, ["session_id"], "time_ms", "from_ms", "end_ms", width)


def token_window_map(pairs: DataFrame, width: float) -> DataFrame:
    """Pairs with dense 0-based token and window numbers per session."""
    toks = over_slices(pairs.select("session_id", "start_ms", "idx").distinct(), ["session_id"], ["start_ms", "idx"], width, rank="__t")
    wins = over_slices(pairs.select("session_id", "time_ms").distinct(), ["session_id"], ["time_ms"], width, rank="__w")
    return (
        pairs.select("session_id", "start_ms", "idx", "time_ms")
        .join(toks, ["session_id", "start_ms", "idx"])
        .join(wins, ["session_id", "time_ms"])
        .select("session_id", "idx", "time_ms", (F.col("__t") - 1).alias("token_idx"), (F.col("__w") - 1).alias("window_idx"))
    )


def label_name(label: Column, label_map: dict[str, int]) -> Column:
    chain = None
    for name, value in label_map.items():
        hit = label == value
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    other = F.concat(F.lit("label_"), label.cast("string"))
    return other if chain is None else chain.otherwise(other)


def label_counts(labelled: DataFrame, label_map: dict[str, int]) -> DataFrame:
    """Windows and distinct elements per label."""
    return (
        labelled.groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n_windows"),
            F.count_distinct("session_id", "element_id").alias("n_elements"),
        )
        .withColumn("label_name", label_name(F.col("label"), label_map))
    )


def breakdown(labelled: DataFrame, examples: int = 5) -> DataFrame:
    """Per label: windows, percent, first and last time, a few element ids."""
    stats = labelled.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.min("time_ms").alias("first_ms"), F.max("time_ms").alias("last_ms")
    )
    total = stats.agg(F.sum("n").alias("total"))
    first_ids = (
        labelled.select("label", "element_id")
        .distinct()
        .withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("element_id")))
        .where(F.col("r") <= examples)
        .groupBy("label")
        .agg(F.array_join(F.sort_array(F.collect_list("element_id")), ",").alias("examples"))
    )
    return (
        with_row(stats, total)
        .withColumn("percent", F.col("n") * 100.0 / F.col("total"))
        .drop("total")
        .join(first_ids, "label")
    )


def sanity(windows: DataFrame, modalities: list[str], label: str = "label") -> DataFrame:
    """A result in one row: sessions, windows, share of the commonest label, and per modality windows, sessions and shapes.

    The shapes of an array column are its distinct lengths; a plain column has none.
    """
    out = [F.count_distinct("session_id").alias("n_sessions"), F.count(F.lit(1)).alias("n_windows")]
    arrays = {f.name for f in windows.schema.fields if f.dataType.typeName() == "array"}
    for m in modalities:
        there = F.col(m).isNotNull()
        out += [F.count_if(there).alias(f"with_{m}"), F.count_distinct(F.when(there, F.col("session_id"))).alias(f"sessions_{m}")]
        if m in arrays:
            out.append(F.array_join(F.sort_array(F.collect_set(F.when(there, F.size(m)))), ",").alias(f"shapes_{m}"))
    most = windows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("top"), F.sum("n").alias("all"))
    share = most.select((F.col("top") * 100.0 / F.col("all")).alias("p")).scalar()
    return windows.agg(*out).withColumn("top_label_percent", share)


def inspect_pairs(pairs: DataFrame) -> DataFrame:
    """Token, window and mapping counts per session."""
    return pairs.groupBy("session_id").agg(
        F.count_distinct("idx").alias("n_tokens"),
        F.count_distinct("time_ms").alias("n_windows"),
        F.count(F.lit(1)).alias("n_pairs"),
    )


def sample_pairs(pairs: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` pairs of each session in token, window order."""
    return first_k(pairs, ["session_id"], ["start_ms", "idx", "time_ms"], n, "__rank").drop("__rank")
