"""Event log to tasks, elements and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import attach, first_containing
from ..functions.lineage import cut
from ..functions.ordered import over_slices

# Configuration defaults and completion states.
DEFAULT_AUDIO_MODE = "text_only"
DEFAULT_INPUT_MODALITY = "text"
COMPLETED = "completed"
SKIPPED_BEFORE_START = "skipped_before_start"
SKIPPED_PARTLY = "partially_completed_then_skipped"
NO_RESPONSE_LIMIT = -1

_CONFIG = "STRUCT<count: INT, allow_repeats: BOOLEAN, with_interruptions: BOOLEAN, audio_mode: STRING, input_modality: STRING, response_time_seconds: INT>"
TASK_PAYLOAD = f"task_id STRING, task_type STRING, config {_CONFIG}"
ELEMENT_PAYLOAD = (
    "element_id STRING, input_modality STRING, element_content STRUCT<element_id: STRING, element_type: STRING, title: STRING, "
    "is_instruction: BOOLEAN, audio_mode: STRING, with_interruptions: BOOLEAN, response_time_seconds: INT, "
    f"task_metadata: STRUCT<task_id: STRING, task_type: STRING, current_count: INT, max_count: INT, config: {_CONFIG}>>"
)


def truthy(c: Column, blank) -> Column:
    """Null where the value counts as missing ('' or 0)."""
    return F.when(c != F.lit(blank), c)


def events_of(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("kind") == kind)


def pair_by_key(starts: DataFrame, ends: DataFrame, keys: list[str], ordinal: str, cols: list[str]) -> DataFrame:
    """Start and end events with the same business key.

    Of several rows with one key the last counts; ``ordinal`` is the position
    of the first start, which fixes the output order.  Unmatched keys drop out.
    """
    last = lambda c: F.max_by(c, ordinal)
    s = starts.groupBy(*keys).agg(F.min(ordinal).alias("ordinal"), *[last(c).alias(f"start_{c}") for c in cols])
    e = ends.groupBy(*keys).agg(*[last(c).alias(f"end_{c}") for c in cols])
    return s.join(e, keys)


def sided(events: DataFrame, start: str, end: str) -> DataFrame:
    """Start and end events with a column ``side``, from one look at the events; one kind may be both."""
    side = F.array_compact(F.array(F.when(F.col("kind") == start, F.lit("start")), F.when(F.col("kind") == end, F.lit("end"))))
    return events.where(F.col("kind").isin(start, end)).withColumn("side", F.explode(side))


def pair_sides(
    rows: DataFrame,
    keys: list[str],
    ts: str,
    ordinal: str,
    cols: list[str],
    width: float,
    ordinal_width: float,
    mode: str = "auto",
) -> DataFrame:
    """Pair the n-th start with the n-th end of a key; ``side`` tells which a row is.

    Where a key has as many starts as ends, n counts in source order and every
    pair stays; otherwise n counts by time and an end before its start drops
    the pair.  ``mode`` 'positional' or 'ranked' keeps only the keys of that
    case.  Starts and ends are counted, numbered and joined as one table.
    """
    rows = cut(rows.select(*keys, "side", ordinal, *[c for c in cols if c != ordinal]))
    starts, ends = F.count_if(F.col("side") == "start"), F.count_if(F.col("side") == "end")
    counts = rows.groupBy(*keys).agg(starts.alias("__s"), ends.alias("__e")).where("__s > 0 AND __e > 0")
    counts = counts.select(*keys, (F.col("__s") == F.col("__e")).alias("positional"))
    if mode != "auto":
        counts = counts.where(F.col("positional") == F.lit(mode == "positional"))
    by = F.when(F.col("positional"), F.col(ordinal) * F.lit(float(width) / ordinal_width)).otherwise(F.col(ts))
    ranked = over_slices(
        attach(rows, counts, keys).withColumn("__by", by.cast("double")), [*keys, "side"], ["__by", ordinal], width, rank="n"
    )
    of = lambda side: [F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{c}") for c in cols]
    both = [F.count_if(F.col("side") == side).alias(f"__{side}") for side in ("start", "end")]
    pairs = ranked.groupBy(*keys, "n", "positional").agg(*of("start"), *of("end"), *both).where("__start = 1 AND __end = 1")
    kept = F.col("positional") | (F.col(f"end_{ts}") >= F.col(f"start_{ts}"))
    return pairs.where(kept).drop("__start", "__end")


def pair_events(
    starts: DataFrame, ends: DataFrame, keys: list[str], ts: str, ordinal: str, cols: list[str], width: float, ordinal_width: float,
    mode: str = "auto",
) -> DataFrame:
    """``pair_sides`` of two tables."""
    need = [*keys, *dict.fromkeys([ordinal, *cols])]
    rows = starts.select(*need, F.lit("start").alias("side")).unionByName(ends.select(*need, F.lit("end").alias("side")))
    return pair_sides(rows, keys, ts, ordinal, cols, width, ordinal_width, mode)


def tasks(pairs: DataFrame) -> DataFrame:
    """Task table from paired start/end events with JSON payloads.

    Expects session_id, n (pair order), start_event_id, start_client_ms,
    end_client_ms, start_payload.  A blank task id drops out; of several pairs
    with one id the last counts and keeps the place of the first.
    """
    p = F.from_json("start_payload", TASK_PAYLOAD)
    rows = pairs.withColumn("p", p).where(truthy(F.col("p.task_id"), "").isNotNull())
    c = F.col("p.config")
    row = F.struct(
        F.coalesce(F.col("p.task_type"), F.lit("")).alias("task_type"),
        F.col("start_client_ms").alias("start_ms"),
        F.col("end_client_ms").alias("end_ms"),
        F.lit(COMPLETED).alias("completion_status"),
        F.coalesce(c["count"], F.lit(0)).alias("count"),
        F.coalesce(c["allow_repeats"], F.lit(False)).alias("allow_repeats"),
        F.coalesce(c["with_interruptions"], F.lit(False)).alias("with_interruptions"),
        F.coalesce(truthy(c["audio_mode"], ""), F.lit(DEFAULT_AUDIO_MODE)).alias("audio_mode"),
        F.coalesce(truthy(c["input_modality"], ""), F.lit(DEFAULT_INPUT_MODALITY)).alias("input_modality"),
        F.lit(False).alias("skipped"),
        F.lit(0).cast("long").alias("skip_ms"),
        F.lit("").alias("skip_event_id"),
    )
    return (
        rows.groupBy("session_id", F.col("p.task_id").alias("task_id"))
        .agg(F.min("n").alias("ordinal"), F.max_by(row, "n").alias("t"))
        .select("session_id", "task_id", "ordinal", "t.*")
        .withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))
    )


def skip_targets(task_rows: DataFrame, skips: DataFrame, width: float) -> DataFrame:
    """The task each skip event hits: the first one running, else the next to start.

    ``skips`` has session_id, event_id, client_ms.
    """
    running = first_containing(
        skips, task_rows, ["session_id"], "client_ms", "start_ms", "end_ms", ["ordinal"], ["task_id"], width, ["event_id"]
    )
    # Tasks that start at the very moment of a skip do not count as next, so they sort before it.
    nxt = F.struct("task_id", "start_ms")
    line = (
        task_rows.select("session_id", F.col("start_ms").alias("t"), F.lit(0).alias("side"), F.col("ordinal").alias("o"), nxt.alias("nxt"))
        .unionByName(
            skips.select("session_id", F.col("client_ms").alias("t"), F.lit(1).alias("side"), F.col("event_id").alias("o")),
            allowMissingColumns=True,
        )
    )
    coming = (
        over_slices(line, ["session_id"], ["t", "side", "o"], width, backfills={"coming": "nxt"})
        .where("side = 1")
        .select("session_id", F.col("o").alias("event_id"), "coming")
    )
    start = F.coalesce(F.col("hit.start_ms"), F.col("coming.start_ms"))
    return (
        running.join(coming, ["session_id", "event_id"])
        .select(
            "session_id",
            "event_id",
            "client_ms",
            F.coalesce(F.col("hit.task_id"), F.col("coming.task_id")).alias("task_id"),
            F.when(F.col("client_ms") <= start, F.lit(SKIPPED_BEFORE_START)).otherwise(F.lit(SKIPPED_PARTLY)).alias("status"),
        )
        .where("task_id IS NOT NULL")
    )


def attribute_skips(task_rows: DataFrame, skips: DataFrame, width: float) -> DataFrame:
    """Task table with skip information; the last skip of a task counts."""
    task_rows = cut(task_rows)
    last = (
        skip_targets(task_rows, skips, width)
        .groupBy("session_id", "task_id")
        .agg(F.max_by(F.struct("event_id", "client_ms", "status"), "event_id").alias("s"))
    )
    hit = F.col("s").isNotNull()
    return (
        task_rows.join(last, ["session_id", "task_id"], "left")
        .withColumn("completion_status", F.when(hit, F.col("s.status")).otherwise(F.col("completion_status")))
        .withColumn("skipped", hit)
        .withColumn("skip_ms", F.when(hit, F.col("s.client_ms")).otherwise(F.col("skip_ms")))
        .withColumn("skip_event_id", F.when(hit, F.col("s.event_id").cast("string")).otherwise(F.col("skip_event_id")))
        .drop("s")
    )


def elements(pairs: DataFrame) -> DataFrame:
    """Element table from sent/replied pairs with JSON payloads.

    Expects session_id, ordinal, start_event_id, start_client_ms,
    end_client_ms, start_payload, end_payload.
    """
    s = F.from_json("start_payload", ELEMENT_PAYLOAD)
    r = F.from_json("end_payload", ELEMENT_PAYLOAD)
    e, m = F.col("s.element_content"), F.col("s.element_content.task_metadata")
    limit = F.coalesce(
        truthy(e["response_time_seconds"], 0), truthy(m["config"]["response_time_seconds"], 0), F.lit(NO_RESPONSE_LIMIT)
    )
    return pairs.withColumn("s", s).withColumn("r", r).select(
        "session_id",
        F.coalesce(truthy(F.col("s.element_id"), ""), e["element_id"], F.col("start_event_id").cast("string")).alias("element_id"),
        "ordinal",
        F.coalesce(e["element_type"], F.lit("")).alias("element_type"),
        F.coalesce(e["title"], F.lit("")).alias("title"),
        F.coalesce(e["is_instruction"], F.lit(False)).alias("is_instruction"),
        F.coalesce(m["task_id"], F.lit("")).alias("task_id"),
        F.coalesce(m["task_type"], F.lit("")).alias("task_type"),
        F.coalesce(m["current_count"], F.lit(0)).alias("sequence_idx"),
        F.coalesce(m["max_count"], F.lit(0)).alias("max_count"),
        F.col("start_client_ms").alias("start_ms"),
        F.col("end_client_ms").alias("end_ms"),
        (F.col("end_client_ms") - F.col("start_client_ms")).alias("duration_ms"),
        F.coalesce(truthy(e["audio_mode"], ""), F.lit(DEFAULT_AUDIO_MODE)).alias("audio_mode"),
        F.coalesce(e["with_interruptions"], F.lit(False)).alias("with_interruptions"),
        F.coalesce(F.col("r.input_modality"), F.lit("")).alias("input_modality"),
        limit.alias("response_time_seconds"),
    )


def with_task_type(element_rows: DataFrame, task_rows: DataFrame) -> DataFrame:
    """Element rows with the type of their task where it is known."""
    known = task_rows.select("session_id", "task_id", F.col("task_type").alias("known_type"))
    return (
        element_rows.join(known, ["session_id", "task_id"], "left")
        .withColumn("task_type", F.coalesce("known_type", "task_type"))
        .drop("known_type")
    )


def with_element_count(task_rows: DataFrame, element_rows: DataFrame) -> DataFrame:
    n = element_rows.groupBy("session_id", "task_id").agg(F.count(F.lit(1)).alias("element_count"))
    return task_rows.join(n, ["session_id", "task_id"], "left").withColumn(
        "element_count", F.coalesce("element_count", F.lit(0).cast("long"))
    )


def segments(events: DataFrame, kinds: dict[str, tuple[str, str]], width: float, ordinal_width: float) -> DataFrame:
    """One table of recording, thinking and pause segments; ``kinds`` maps type to (start, stop) kinds."""
    roles = F.lit(None)
    for kind in sorted({k for pair in kinds.values() for k in pair}):
        mine = [(name, side) for name, pair in kinds.items() for side, k in zip(("start", "end"), pair) if k == kind]
        these = F.array(*[F.struct(F.lit(n).alias("segment_type"), F.lit(side).alias("side")) for n, side in mine])
        roles = F.when(F.col("kind") == kind, these).otherwise(roles)
    rows = events.withColumn("__role", F.explode(roles)).select("*", "__role.segment_type", "__role.side")
    pairs = pair_sides(rows, ["session_id", "segment_type"], "client_ms", "event_id", ["event_id", "client_ms"], width, ordinal_width)
    return pairs.select(
        "session_id",
        F.col("start_event_id").alias("segment_id"),
        "segment_type",
        F.col("n").alias("type_index"),
        F.col("start_client_ms").alias("start_ms"),
        F.col("end_client_ms").alias("end_ms"),
        (F.col("end_client_ms") - F.col("start_client_ms")).alias("duration_ms"),
        F.col("end_event_id").alias("end_event_id"),
    )


def contain(segment_rows: DataFrame, element_rows: DataFrame, width: float) -> DataFrame:
    """The first element around each segment start and the start relative to it."""
    segment_rows, element_rows = cut(segment_rows), cut(element_rows)
    found = first_containing(
        segment_rows,
        element_rows.select("session_id", "ordinal", "element_id", F.col("start_ms").alias("e_start"), F.col("end_ms").alias("e_end")),
        ["session_id"],
        "start_ms",
        "e_start",
        "e_end",
        ["ordinal"],
        ["element_id"],
        width,
        ["segment_type", "segment_id"],
    )
    return (
        found.withColumn("containing_element_id", F.coalesce(F.col("hit.element_id"), F.lit("")))
        .withColumn(
            "element_relative_start",
            F.coalesce((F.col("start_ms") - F.col("hit.e_start")).cast("double"), F.lit(0.0)),
        )
        .drop("hit")
    )


def fill_missing(df: DataFrame) -> DataFrame:
    """Type-dependent values for missing ones: '', 0, 0.0, false."""
    blank = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            blank[f.name] = ""
        elif isinstance(f.dataType, T.BooleanType):
            blank[f.name] = False
        elif isinstance(f.dataType, T.NumericType):
            blank[f.name] = 0
    return df.na.fill(blank)


def relative_times(rows: DataFrame, events: DataFrame, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Times relative to the session start.

    ``fraction_*_raw`` divides milliseconds by the seconds of a day, as earlier
    stores do; ``fraction_start`` is the true share of the session.
    """
    span = events.groupBy("session_id").agg(F.min("client_ms").alias("__t0"), F.max("client_ms").alias("__t1"))
    day = F.lit(86400.0)
    return (
        attach(rows, span, ["session_id"])
        .withColumn("relative_start_ms", F.col(start) - F.col("__t0"))
        .withColumn("fraction_start_raw", (F.col(start) - F.col("__t0")) / day)
        .withColumn("fraction_end_raw", (F.col(end) - F.col("__t0")) / day)
        .withColumn("fraction_start", F.try_divide(F.col(start) - F.col("__t0"), F.col("__t1") - F.col("__t0")))
        .drop("__t0", "__t1")
    )
