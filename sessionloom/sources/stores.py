"""Result stores: per-session tables, nested trees, reports, the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..operators.catalog import reset


def save_results(df: DataFrame, path: str, spread: int = 8, rows_per_file: int = 5_000_000, whole: int = 100_000) -> None:
    """Write one partition per session; sessions already there are replaced.

    A session of up to ``whole`` rows is one file, as files, not rows, are what
    many sessions cost; a larger one goes to up to ``spread`` tasks.
    """
    df = cut(df)
    large = df.groupBy(F.col("session_id").alias("__id")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > whole)
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
    salt = F.when(F.col("__n").isNotNull(), F.pmod(F.xxhash64(*plain), F.lit(spread))).otherwise(F.lit(0))
    # a stated number of partitions, as adaptive execution would merge these few small rows
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.join(large, df["session_id"].eqNullSafe(large["__id"]), "left")
        .withColumn("__salt", salt)
        .repartition(tasks, "session_id", "__salt")
        .drop("__salt", "__id", "__n")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("session_id")
        .parquet(path)
    )


def load_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def result_attributes(df: DataFrame) -> DataFrame:
    """Root attributes of a result: sessions and rows."""
    return df.agg(F.count_distinct("session_id").alias("session_count"), F.count(F.lit(1)).alias("row_count"))


def session_index(df: DataFrame) -> DataFrame:
    return df.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_rows"))


def label_map_table(spark: SparkSession, label_map: dict[str, int]) -> DataFrame:
    """Label map with its order, to be stored next to a result."""
    rows = [(i, k, v) for i, (k, v) in enumerate(label_map.items())]
    return spark.createDataFrame(rows, "pattern_ord int, pattern string, value int")


def save_tree(df: DataFrame, path: str, groups: dict[str, list[str]]) -> None:
    """Write columns nested into groups, as one struct per group."""
    grouped = {c for cols in groups.values() for c in cols}
    flat = [c for c in df.columns if c not in grouped]
    df.select(*flat, *[F.struct(*cols).alias(g) for g, cols in groups.items()]).write.mode("overwrite").parquet(path)


def flatten_tree(df: DataFrame) -> DataFrame:
    """Bring the columns of all groups back to the top, as group_column."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            out += [F.col(f"{f.name}.{c}").alias(f"{f.name}_{c}") for c in f.dataType.names]
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def reports(per_session: DataFrame) -> DataFrame:
    """One JSON document per session from its row."""
    return per_session.select("session_id", F.to_json(F.struct(*per_session.columns)).alias("report"))


def save_reports(per_session: DataFrame, path: str) -> None:
    per_session.write.mode("overwrite").json(path)


def append_ledger(rows: DataFrame, path: str) -> None:
    """Add ledger rows; readers take the latest row of each key."""
    rows.write.mode("append").partitionBy("transform_id").parquet(path)


def reset_transform(spark: SparkSession, path: str, fresh_path: str, transform: str) -> int:
    """Write the ledger without one transform to a new place; return the rows dropped.

    The old table stays until the caller switches over, so a failed job loses nothing.
    """
    kept, dropped = reset(spark.read.parquet(path), transform)
    kept.write.mode("overwrite").partitionBy("transform_id").parquet(fresh_path)
    return dropped.first()["n_deleted"]
