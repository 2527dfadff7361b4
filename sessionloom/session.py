"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All of these are runtime SQL settings, so they can be set on a session that
# somebody else has built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot key is split even if that costs a shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole texts go to Python: a batch is held several times over, on both sides
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


# Spark adds up the bytes of an Arrow batch after every row, which takes several times as long as sending a character or a token.
BATCH_BYTES, NO_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", str(2**31 - 1)


def tune(spark: SparkSession, small_rows: bool = False) -> SparkSession:
    """``small_rows``: all rows that go to Python are small, so the number of rows alone bounds a batch."""
    conf = RUNTIME_CONF | ({BATCH_BYTES: NO_LIMIT} if small_rows else {})
    for key, value in conf.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if not small_rows and spark.conf.get(BATCH_BYTES, None) == NO_LIMIT:
        spark.conf.unset(BATCH_BYTES)
    return spark


def local_session(cpus: str | int = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return tune(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sessionloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
