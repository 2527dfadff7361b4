"""Order-dependent functions that do not put a whole key into one task.

A window over ``partitionBy(session)`` sorts a session in a single task.  One
session may hold a third of all rows, so ranks, neighbours and running values
are computed per *slice* of the order column, and the few values that cross a
slice border travel in a table with one row per slice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__w_slice"


def _one_key(keys: list[str]) -> list:
    return list(keys) if keys else [F.lit(0)]


def over_slices(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    width: float,
    *,
    rank: str | None = None,
    lags: dict[str, str] | None = None,
    leads: dict[str, str] | None = None,
    sums: dict[str, str] | None = None,
    mins: dict[str, str] | None = None,
    fills: dict[str, str] | None = None,
    backfills: dict[str, str] | None = None,
) -> DataFrame:
    """Add window results over ``keys`` ordered by ``order``.

    ``order[0]`` is numeric and ``width`` is how much of it one slice spans.
    ``order`` must be unique within a key and keys must not be null.

    rank       1-based row number
    lags       {new: column} value in the previous row
    leads      {new: column} value in the next row
    sums       {new: column} running sum up to and including the row
    mins       {new: column} running minimum up to and including the row
    fills      {new: column} last non-null value at or before the row
    backfills  {new: column} first non-null value at or after the row
    """
    lags, leads, sums, mins = lags or {}, leads or {}, sums or {}, mins or {}
    fills, backfills = fills or {}, backfills or {}
    part = [*keys, SLICE]
    sliced = df.withColumn(SLICE, F.floor(F.col(order[0]) / F.lit(width)).cast("long"))
    at = F.struct(*order)

    # One row per slice: what the neighbouring slices need to know.
    facts = [F.count(F.lit(1)).alias("__w_size")]
    facts += [F.max_by(F.struct(F.col(c)), at).alias(f"__w_lag_{n}") for n, c in lags.items()]
    facts += [F.min_by(F.struct(F.col(c)), at).alias(f"__w_lead_{n}") for n, c in leads.items()]
    facts += [F.sum(c).alias(f"__w_sum_{n}") for n, c in sums.items()]
    facts += [F.min(c).alias(f"__w_min_{n}") for n, c in mins.items()]
    facts += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"__w_fill_{n}") for n, c in fills.items()]
    facts += [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"__w_back_{n}") for n, c in backfills.items()]
    slices = sliced.groupBy(*part).agg(*facts)

    up = Window.partitionBy(*_one_key(keys)).orderBy(SLICE)
    down = Window.partitionBy(*_one_key(keys)).orderBy(F.col(SLICE).desc())
    earlier = up.rowsBetween(Window.unboundedPreceding, -1)
    later = down.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.col("__w_size"), F.coalesce(F.sum("__w_size").over(earlier), F.lit(0)).alias("__w_offset")]
    carried += [F.lag(f"__w_lag_{n}").over(up).alias(f"__w_lag_{n}") for n in lags]
    carried += [F.lead(f"__w_lead_{n}").over(up).alias(f"__w_lead_{n}") for n in leads]
    carried += [F.sum(f"__w_sum_{n}").over(earlier).alias(f"__w_sum_{n}") for n in sums]
    carried += [F.min(f"__w_min_{n}").over(earlier).alias(f"__w_min_{n}") for n in mins]
    carried += [F.last(f"__w_fill_{n}", ignorenulls=True).over(earlier).alias(f"__w_fill_{n}") for n in fills]
    carried += [F.last(f"__w_back_{n}", ignorenulls=True).over(later).alias(f"__w_back_{n}") for n in backfills]
    slices = slices.select(*part, *carried)

    w = Window.partitionBy(*part).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    wd = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order])
    from_here = wd.rowsBetween(Window.unboundedPreceding, 0)
    inside = [F.row_number().over(w).alias("__w_row")]
    inside += [F.lag(c).over(w).alias(f"__w_in_lag_{n}") for n, c in lags.items()]
    inside += [F.lead(c).over(w).alias(f"__w_in_lead_{n}") for n, c in leads.items()]
    inside += [F.sum(c).over(so_far).alias(f"__w_in_sum_{n}") for n, c in sums.items()]
    inside += [F.min(c).over(so_far).alias(f"__w_in_min_{n}") for n, c in mins.items()]
    inside += [F.last(c, ignorenulls=True).over(so_far).alias(f"__w_in_fill_{n}") for n, c in fills.items()]
    inside += [F.last(c, ignorenulls=True).over(from_here).alias(f"__w_in_back_{n}") for n, c in backfills.items()]
    rows = sliced.select("*", *inside)

    joined = rows.join(slices, part)
    out: list[Column] = [F.col(c) for c in df.columns]
    if rank:
        out.append((F.col("__w_row") + F.col("__w_offset")).cast("long").alias(rank))
    for n, c in lags.items():
        out.append(F.when(F.col("__w_row") == 1, F.col(f"__w_lag_{n}")[c]).otherwise(F.col(f"__w_in_lag_{n}")).alias(n))
    for n, c in leads.items():
        last_row = F.col("__w_row") == F.col("__w_size")
        out.append(F.when(last_row, F.col(f"__w_lead_{n}")[c]).otherwise(F.col(f"__w_in_lead_{n}")).alias(n))
    for n in sums:
        out.append((F.coalesce(F.col(f"__w_sum_{n}"), F.lit(0)) + F.coalesce(F.col(f"__w_in_sum_{n}"), F.lit(0))).alias(n))
    for n in mins:
        out.append(F.least(f"__w_min_{n}", f"__w_in_min_{n}").alias(n))
    for n in fills:
        out.append(F.coalesce(F.col(f"__w_in_fill_{n}"), F.col(f"__w_fill_{n}")).alias(n))
    for n in backfills:
        out.append(F.coalesce(F.col(f"__w_in_back_{n}"), F.col(f"__w_back_{n}")).alias(n))
    return joined.select(*out)


def over_frames(
    df: DataFrame,
    keys: list[str],
    index: str,
    before: int,
    after: int,
    block: int,
    exprs: dict[str, Callable[[object], Column]],
) -> DataFrame:
    """Moving frames ``[index-before, index+after]`` over a dense integer index.

    The index is cut into blocks; rows near a border are also sent to the
    neighbouring block, and only a block's own rows are returned.
    """
    i = F.col(index)
    own = F.floor(i / F.lit(block)).cast("long")
    reach = F.sequence(
        F.floor((i - F.lit(after)) / F.lit(block)).cast("long"),
        F.floor((i + F.lit(before)) / F.lit(block)).cast("long"),
    )
    w = Window.partitionBy(*keys, "__block").orderBy(index).rangeBetween(-before, after)
    spread = df.withColumn("__own", own).withColumn("__block", F.explode(reach))
    return (
        spread.select("*", *[make(w).alias(name) for name, make in exprs.items()])
        .where(F.col("__own") == F.col("__block"))
        .drop("__own", "__block")
    )


def dealt(df: DataFrame, keys: list[str], n_rows: int, per_task: int = 500_000) -> DataFrame:
    """Rows dealt to tasks by ``keys``, about ``per_task`` of ``n_rows`` to each.

    Groups of ``keys`` that are nearly as many as rows then fill no task's memory:
    a reading task would gather those of its whole part of the file before the
    shuffle, and the session's number of tasks does not grow with the table.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-n_rows // per_task)), *keys)


def first_k(df: DataFrame, keys: list[str], order: list, k: int, rank: str) -> DataFrame:
    """The first ``k`` rows of every key with their 1-based rank.

    Spark limits each input partition to ``k`` rows per key before the shuffle,
    so a hot key sends only ``k`` rows per partition to its task.
    """
    w = Window.partitionBy(*_one_key(keys)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
