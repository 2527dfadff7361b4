"""Session catalogue from file listings, and the processing ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import over_slices

# Name patterns and the timestamp of names without one.
SESSION_PATTERN = r"(.+_\d{8}_\d{6})(?:_[^/]*)?(?:\.zarr|\.h5)?$"
STAMP_PATTERN = r"(\d{8})_(\d{6})"
FILE_STAMP_PATTERN = r"_(\d{13})\.h5$"
NO_STAMP = "00000000000000"
MB = 1024 * 1024
SECONDS_PER_MB = 10


def session_of(path: Column) -> Column:
    """Session id from the last part of a path."""
    base = F.regexp_replace(F.regexp_extract(F.regexp_replace(path, "/+$", ""), r"([^/]*)$", 1), r"\.h5$", "")
    found = F.regexp_extract(base, SESSION_PATTERN, 1)
    return F.when(found != "", found).otherwise(base)


def stamp_of(name: Column) -> Column:
    """Fourteen-digit timestamp in a name, or zeros."""
    day, time = F.regexp_extract(name, STAMP_PATTERN, 1), F.regexp_extract(name, STAMP_PATTERN, 2)
    return F.when(day != "", F.concat(day, time)).otherwise(F.lit(NO_STAMP))


def list_sessions(files: DataFrame, prefix: str) -> DataFrame:
    """Distinct sessions under a prefix: folders, and files directly below it."""
    rest = F.substring("path", len(prefix) + 1, 1 << 20)
    item = F.regexp_extract(rest, r"^([^/]+)", 1)
    direct = ~rest.contains("/")
    return (
        files.where(F.col("path").startswith(prefix))
        .where(~direct | item.endswith(".h5"))
        .select(session_of(item).alias("session_id"))
        .distinct()
    )


def catalog(files: DataFrame) -> DataFrame:
    """One row per session: files, size, duration and where the duration comes from.

    ``files`` has session_id, path, size_bytes and optionally meta_duration_s.
    A stored duration counts first, then the span of the file timestamps when
    there are at least two, else ten seconds per megabyte of the first file.
    """
    if "meta_duration_s" not in files.columns:
        files = files.withColumn("meta_duration_s", F.lit(None).cast("double"))
    stamp = F.regexp_extract("path", FILE_STAMP_PATTERN, 1)
    ms = F.when(stamp != "", stamp.cast("long"))
    per = (
        files.withColumn("__ms", ms)
        .groupBy("session_id")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("size_bytes").alias("size_bytes"),
            F.max("meta_duration_s").alias("__meta"),
            F.count("__ms").alias("__n"),
            F.min("__ms").alias("__first"),
            F.max("__ms").alias("__last"),
            F.min_by("size_bytes", F.struct("path", "size_bytes")).alias("__one"),
        )
    )
    guess = F.col("__one") / F.lit(float(MB)) * SECONDS_PER_MB * 1000.0
    duration = (
        F.when(F.col("__meta").isNotNull(), F.col("__meta") * 1000.0)
        .when(F.col("__n") >= 2, (F.col("__last") - F.col("__first")).cast("double"))
        .otherwise(guess)
    )
    source = F.when(F.col("__meta").isNotNull(), "metadata").when(F.col("__n") >= 2, "timestamps").otherwise("estimated")
    return per.select(
        "session_id", "n_files", "size_bytes", duration.alias("duration_ms"), source.alias("duration_source"), stamp_of(F.col("session_id")).alias("stamp")
    )


def filter_catalog(
    sessions: DataFrame,
    name: str | None = None,
    since: str | None = None,
    min_mb: float | None = None,
    max_mb: float | None = None,
    min_minutes: float | None = None,
) -> DataFrame:
    """Sessions that meet all given limits (sizes inclusive), newest first."""
    out = sessions
    if name:
        out = out.where(F.col("session_id").contains(name))
    if since:
        out = out.where(F.col("stamp") >= F.rpad(F.lit(since), 14, "0"))
    if min_mb is not None:
        out = out.where(F.col("size_bytes") >= min_mb * MB)
    if max_mb is not None:
        out = out.where(F.col("size_bytes") <= max_mb * MB)
    if min_minutes is not None:
        out = out.where(F.col("duration_ms") >= min_minutes * 60_000)
    return out.orderBy(F.col("stamp").desc(), F.col("session_id").desc())


def latest(sessions: DataFrame, name: str) -> DataFrame:
    """The newest session with the text in its name."""
    return filter_catalog(sessions, name=name).limit(1)


def in_every_store(stores: list[DataFrame]) -> DataFrame:
    """Sessions that occur in all of the stores."""
    return reduce(lambda a, b: a.intersect(b), [s.select("session_id") for s in stores])


# --- ledger -------------------------------------------------------------------

LEDGER_KEY = ["data_id", "transform_id"]


def latest_rows(ledger: DataFrame) -> DataFrame:
    """The last row written for each item and transform."""
    rest = [c for c in ledger.columns if c not in LEDGER_KEY]
    return ledger.groupBy(*LEDGER_KEY).agg(F.max_by(F.struct(*rest), F.struct("ts_ms", "seq")).alias("r")).select(*LEDGER_KEY, "r.*")


def record(ledger: DataFrame, new: DataFrame) -> DataFrame:
    """Current state after appending rows; the last write of a key wins."""
    return latest_rows(ledger.unionByName(new))


def with_status(ledger: DataFrame, transform: str, status: str) -> DataFrame:
    """Items whose last row of a transform has the status."""
    return (
        latest_rows(ledger.where(F.col("transform_id") == transform)).where(F.col("status") == status).select("data_id")
    )


def select_work(
    items: DataFrame,
    ledger: DataFrame,
    transform: str,
    include_skipped: bool = False,
    include_processed: bool = False,
    skipped_only: bool = False,
    max_items: int = 0,
) -> DataFrame:
    """Items to process next.

    By default those without a success or skip; ``include_skipped`` tries
    skipped ones again, ``include_processed`` takes all, ``skipped_only`` only
    skipped ones.  ``max_items`` takes that many in id order.
    """
    state = latest_rows(ledger.where(F.col("transform_id") == transform))
    done = ["success"] if include_skipped else ["success", "skipped"]
    if skipped_only:
        out = items.join(state.where("status = 'skipped'").select("data_id"), "data_id", "left_semi")
    elif include_processed:
        out = items
    else:
        out = items.join(state.where(F.col("status").isin(done)).select("data_id"), "data_id", "left_anti")
    return out.orderBy("data_id").limit(max_items) if max_items > 0 else out


def run_stats(results: DataFrame) -> DataFrame:
    one = lambda s: F.count_if(F.col("status") == s).alias(s)
    return results.agg(F.count(F.lit(1)).alias("processed"), one("success"), one("failed"), one("skipped"))


def reset(ledger: DataFrame, transform: str) -> tuple[DataFrame, DataFrame]:
    """The ledger without one transform, and the number of rows dropped."""
    mine = F.col("transform_id") == transform
    return ledger.where(~mine), ledger.where(mine).agg(F.count(F.lit(1)).alias("n_deleted"))


def batches(windows: DataFrame, order: str, width: float, per_batch: int = 1000, subject: str = "session_id") -> DataFrame:
    """Number the windows of a subject and put ``per_batch`` of them into each batch."""
    ranked = over_slices(windows, [subject], [order], width, rank="__r")
    return ranked.withColumn("batch", F.floor((F.col("__r") - 1) / per_batch).cast("long")).drop("__r")


def batch_index(batched: DataFrame, order: str, subject: str = "session_id") -> DataFrame:
    return batched.groupBy(subject, "batch").agg(
        F.count(F.lit(1)).alias("n_windows"), F.min(order).alias("first"), F.max(order).alias("last")
    )


