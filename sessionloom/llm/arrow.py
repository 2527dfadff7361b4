"""Running a function over column lists inside Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

MOST_IDS = 1 << 22  # about 32 MB of ids, the most that is sent to every executor


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def map_columns(df: DataFrame, fn: Callable[..., dict], ddl: str) -> DataFrame:
    """``fn`` gets the columns of a batch as lists and returns the lists of the new ones."""
    schema = schema_of(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(*[c.to_pylist() for c in batch.columns])
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that other columns cannot clash; null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def unused(docs: DataFrame, name: str) -> str:
    """The name, made longer until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def among(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", without: bool = False, most: int = MOST_IDS) -> DataFrame:
    """The rows whose id is in the one column of ``ids``, or ``without`` is not; null matches null.

    ``ids`` is a written table.  Up to ``most`` ids go to the executors, so that
    texts stay where they are; more are joined by a shuffle.
    """
    name = unused(docs, "__id")
    named = ids.select(F.col(ids.columns[0]).alias(name)).distinct()
    if ids.count() <= most:
        named = F.broadcast(named)
    return docs.join(named, docs[id_col].cast("long").eqNullSafe(named[name]), "left_anti" if without else "left_semi")
