"""Materialisation points for long chains of operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Numbers and times that rise from row to row become differences.
COMPACT = {"parquet.writer.version": "PARQUET_2_0", "compression": "zstd"}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables of this application.

    It lies below ``spark.checkpoint.dir``, which the cluster names.  Where that
    is unset, as in tests, the warehouse folder takes its place, so the same
    rule holds in every mode and all executors see the files.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    root = named or f"{spark.conf.get('spark.sql.warehouse.dir')}/intermediate"
    return f"{root.rstrip('/')}/{sc.applicationId}"


def cut(df: DataFrame, compact: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Several operators need their input twice (rows and per-slice totals).  A
    written table keeps a chain of them linear instead of doubling at each
    step, survives lost executors, and still allows column pruning.  ``compact``
    takes more processor time for less disk, as tables of tokens need it.
    """
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.options(**(COMPACT if compact else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove all tables that ``cut`` has written for this application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
