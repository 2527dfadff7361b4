"""Register a query together with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from .inputs import INPUT_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def with_inputs(sql: str) -> str:
    """Put the definitions of all ``px_`` inputs the text uses in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(re.findall(r"\bpx_\w+", text))):
            visit(INPUT_SQL[name]) if name not in needed else None
            if name not in needed:
                needed.append(name)

    visit(sql)
    body = sql.strip()
    if not needed:
        return body
    ctes = ", ".join(f"{n} AS ({INPUT_SQL[n]})" for n in needed)
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(start):
            return f"{start}{ctes}, {body[len(start):]}"
    return f"WITH {ctes} {body}"


def query(name: str, sql: str | None = None, small_rows: bool = False):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark, small_rows), sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_inputs(sql)
        return run

    return register


def rounded(df: DataFrame, digits: int = 6, *cols: str) -> DataFrame:
    """Round double columns: engines add floats in different orders."""
    chosen = cols or [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    # + 0.0 turns a negative zero into zero
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in chosen})
