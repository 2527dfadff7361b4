"""Which sessions are worth keeping: data rate, duration, corpus hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes by data rate in KB/s.
NEITHER, FNIRS_ONLY, BOTH = "neither", "fnirs only", "both (fnirs+eeg)"
FNIRS_RATE, BOTH_RATE = 70, 200
CLASSES = [NEITHER, FNIRS_ONLY, BOTH]


def data_rate(size_bytes: Column, duration_ms: Column) -> Column:
    """KB per second; 0 without a duration."""
    return F.when(duration_ms > 0, (size_bytes / 1024.0) / (duration_ms / 1000.0)).otherwise(F.lit(0.0))


def rate_class(rate: Column) -> Column:
    return F.when(rate < FNIRS_RATE, NEITHER).when(rate < BOTH_RATE, FNIRS_ONLY).otherwise(BOTH)


def clean_duration(events: DataFrame, ordinal: str) -> DataFrame:
    """Client time of the first and the last event in file order."""
    return events.groupBy("session_id").agg(F.min_by("client_ms", ordinal).alias("first_ms"), F.max_by("client_ms", ordinal).alias("last_ms"))


def clean_ms() -> Column:
    """Last minus first; 0 when either is missing or zero."""
    known = (F.col("first_ms") != 0) & (F.col("last_ms") != 0)
    return F.when(known, F.col("last_ms") - F.col("first_ms")).otherwise(F.lit(0))


def qualify(sessions: DataFrame, min_seconds: float, min_class: str) -> DataFrame:
    """Qualification with all failed reasons, from first_ms, last_ms, size_bytes."""
    rate = data_rate(F.col("size_bytes"), F.col("clean_ms"))
    kind = F.when(F.col("clean_ms") > 0, rate_class(F.col("data_rate"))).otherwise(F.lit(NEITHER))
    good = CLASSES[CLASSES.index(min_class) :]
    reasons = F.array_compact(
        F.array(
            F.when(F.col("clean_ms") / 1000.0 < min_seconds, "too_short"), F.when(~F.col("class").isin(good), "class_too_low")
        )
    )
    return (
        sessions.withColumn("clean_ms", clean_ms())
        .withColumn("data_rate", rate)
        .withColumn("class", kind)
        .withColumn("reasons", F.array_join(reasons, ","))
        .withColumn("qualifies", F.col("reasons") == "")
    )


def session_minutes(sessions: DataFrame, least: float = 10.0) -> DataFrame:
    """Counted minutes per session: the clean duration if long enough, else the file span."""
    clean = F.col("clean_ms") / 60_000.0
    span = F.col("file_ms") / 60_000.0
    clean_class = F.when(F.col("clean_ms") > 0, rate_class(data_rate(F.col("size_bytes"), F.col("clean_ms"))))
    return (
        sessions.withColumn("clean_ms", clean_ms())
        .withColumn("class", F.coalesce(clean_class, rate_class(data_rate(F.col("size_bytes"), F.col("file_ms")))))
        .withColumn("minutes", F.when((F.col("clean_ms") > 0) & (clean > least), clean).when(span > least, span))
        .withColumn("clean_minutes", clean)
        .where("minutes IS NOT NULL")
    )


def corpus_hours(minutes: DataFrame) -> DataFrame:
    """Total hours and minutes by class; 'both' also counts as optical."""
    is_both = F.col("class") == BOTH
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("clean_minutes"))), F.lit(0.0))
    return minutes.agg(
        F.count(F.lit(1)).alias("n_sessions"),
        (F.sum("minutes") / 60.0).alias("hours"),
        part(is_both).alias("both_minutes"),
        part(is_both | (F.col("class") == FNIRS_ONLY)).alias("fnirs_minutes"),
        part(is_both).alias("eeg_minutes"),
    )


def class_counts(minutes: DataFrame) -> DataFrame:
    return minutes.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("minutes").alias("minutes"))
