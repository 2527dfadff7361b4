"""Event logs and file listings as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "session_id STRING, kind STRING, ordinal LONG, event_id STRING, server_ms DOUBLE, client_ms DOUBLE, payload STRING"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event log in JSON lines; the payload stays text."""
    return spark.read.schema(EVENT_SCHEMA).json(path)


def parse_payload(events: DataFrame, schema: str, payload: str = "payload") -> DataFrame:
    """Add the parsed payload as ``data``; text that is not JSON stays in ``raw``."""
    parsed = F.from_json(payload, schema)
    good = F.try_parse_json(payload).isNotNull()
    return events.withColumn("data", F.when(good, parsed)).withColumn("raw", F.when(~good, F.col(payload)))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of all files below a folder; their content is not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    )
    return files.select("path", F.col("length").alias("size_bytes"), F.unix_millis("modificationTime").alias("ts_ms"))
