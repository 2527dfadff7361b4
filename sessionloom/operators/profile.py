"""Timestamp quality and table profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import attach
from ..functions.ordered import first_k, over_slices
from ..functions.quantiles import exact_median


def rates(rows: DataFrame, keys: list[str], ts: str = "ts_ms") -> DataFrame:
    """First, last, duration, count and rate; no rate without a duration."""
    seconds = (F.col("last_ms") - F.col("first_ms")) / 1000.0
    return (
        rows.groupBy(*keys)
        .agg(F.min(ts).alias("first_ms"), F.max(ts).alias("last_ms"), F.count(F.lit(1)).alias("n"))
        .withColumn("duration_s", seconds)
        .withColumn("rate", F.col("n") / F.nullif(F.col("duration_s"), F.lit(0.0)))
    )


def event_times(events: DataFrame, keys: list[str]) -> DataFrame:
    """Client times above zero of each kind that has any, else its server times."""
    any_client = events.groupBy(*keys).agg(F.max((F.col("client_ms") > 0).cast("int")).alias("__c"))
    joined = attach(events, any_client, keys)
    return (
        joined.where((F.col("__c") == 0) | (F.col("client_ms") > 0))
        .withColumn("ts_ms", F.when(F.col("__c") == 1, F.col("client_ms")).otherwise(F.col("server_ms")))
        .drop("__c")
    )


def frame_gaps(rows: DataFrame, keys: list[str], order: list[str], width: float, ts: str = "ts_ms") -> DataFrame:
    """Difference of each row to the one before it in its key."""
    prev = over_slices(rows, keys, order, width, lags={"__prev": ts})
    return prev.withColumn("gap", (F.col(ts) - F.col("__prev")).cast("double")).drop("__prev").where("gap IS NOT NULL")


def gap_stats(gaps: DataFrame, keys: list[str]) -> DataFrame:
    stats = gaps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_gaps"),
        F.min("gap").alias("min_gap"),
        F.max("gap").alias("max_gap"),
        F.avg("gap").alias("mean_gap"),
        F.stddev_pop("gap").alias("std_gap"),
        F.sum("gap").alias("session_ms"),
    )
    median = exact_median(gaps, keys, "gap", "median_gap")
    return stats.join(median, keys).withColumn("hz", F.try_divide(F.lit(1000.0), F.col("mean_gap")))


def gap_outliers(gaps: DataFrame, keys: list[str], order: list[str], n_std: float = 3.0, top: int = 10) -> DataFrame:
    """The ``top`` gaps of each key farthest from its median, beyond ``n_std`` stds; ties by ``order``."""
    stats = gap_stats(gaps, keys).select(*keys, "median_gap", "std_gap")
    far = F.abs(F.col("gap") - F.col("median_gap"))
    found = attach(gaps, stats, keys).withColumn("deviation", far).where(F.col("deviation") > n_std * F.col("std_gap"))
    return first_k(found, keys, [F.col("deviation").desc(), *order], top, "__rank").drop("__rank")


def common_gaps(gaps: DataFrame, keys: list[str], digits: int = 2, top: int = 10) -> DataFrame:
    """The ``top`` most common rounded gaps of each key with their percent."""
    per = gaps.groupBy(*keys, F.bround("gap", digits).alias("gap")).agg(F.count(F.lit(1)).alias("n"))
    total = per.groupBy(*keys).agg(F.sum("n").alias("total"))
    best = first_k(per, keys, [F.col("n").desc(), "gap"], top, "__rank").drop("__rank")
    return best.join(total, keys).withColumn("percent", F.col("n") * 100.0 / F.col("total")).drop("total")


def offsets(rows: DataFrame, modality: str, keys: list[str], ts: str = "ts_ms", offset: str = "offset_ms") -> DataFrame:
    """Offset statistics per key and modality, and its start relative to the key's earliest one."""
    per = rows.groupBy(*keys, modality).agg(
        F.min(offset).alias("min_offset"),
        F.max(offset).alias("max_offset"),
        F.avg(offset).alias("mean_offset"),
        F.stddev_pop(offset).alias("std_offset"),
        F.min(ts).alias("__start"),
    )
    first = per.groupBy(*keys).agg(F.min("__start").alias("__first"))
    return per.join(first, keys).withColumn("start_s", (F.col("__start") - F.col("__first")) / 1000.0).drop("__start", "__first")


def inventory(tables: dict[str, DataFrame], modalities: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows, columns and numeric columns of each table, and whether it carries a modality."""
    parts = []
    for name, df in tables.items():
        fields = df.schema.fields
        row = [
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(len(fields)).alias("n_columns"),
            F.lit(sum(isinstance(f.dataType, T.NumericType) for f in fields)).alias("n_numeric"),
        ]
        row += [F.lit(name in members).alias(f"has_{m}") for m, members in (modalities or {}).items()]
        parts.append(df.agg(*row))
    return reduce(DataFrame.unionByName, parts)


def columns_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def profile(df: DataFrame, sample: float | None = None, seed: int = 42) -> DataFrame:
    """Min, max, mean, std, zeros and NaN of every numeric column, in one pass."""
    rows = df.sample(fraction=sample, seed=seed) if sample else df
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    x = lambda c: F.col(c).cast("double")
    facts: list[Column] = []
    for i, c in enumerate(names):
        facts += [
            F.min(x(c)).alias(f"a{i}"),
            F.max(x(c)).alias(f"b{i}"),
            F.avg(x(c)).alias(f"c{i}"),
            F.stddev_pop(x(c)).alias(f"d{i}"),
            F.max(x(c) == 0).alias(f"e{i}"),
            F.max(F.isnan(x(c))).alias(f"f{i}"),
        ]
    cols = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"a{i}").alias("min"),
            F.col(f"b{i}").alias("max"),
            F.col(f"c{i}").alias("mean"),
            F.col(f"d{i}").alias("std"),
            F.col(f"e{i}").alias("has_zeros"),
            F.col(f"f{i}").alias("has_nan"),
        )
        for i, c in enumerate(names)
    ]
    return rows.agg(*facts).select(F.explode(F.array(*cols)).alias("r")).select("r.*")
