"""Incremental intake of new event files.

A stage of the batch pipeline lists its inputs and skips those it has seen.
For event files the file source keeps that list itself: each run takes the
files that are new since the last one and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.events import EVENT_SCHEMA


def new_events(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(path)


def ingest(spark: SparkSession, source: str, target: str, state: str) -> StreamingQuery:
    """Append all event files not taken in before to the events table, then stop."""
    rows = new_events(spark, source).withColumn("day", F.to_date(F.timestamp_millis(F.col("client_ms").cast("long"))))
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", state)
        .partitionBy("day")
        .trigger(availableNow=True)
        .start(target)
    )
