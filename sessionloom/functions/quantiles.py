"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

#: Values of one cell that are put in order in one task; larger cells are cut again.
MOST = 1 << 16
#: Cells of the first pass in each doubling of the magnitude.
PARTS = 8


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: list[float], names: list[str], bits: int = 12, most: int = MOST
) -> DataFrame:
    """One row per key with linearly interpolated quantiles, as ``percentile``."""
    at = lambda p: lambda total: (total - 1) * F.lit(float(p))
    return exact_positions(df, keys, value, [at(p) for p in probs], names, bits, most)


def magnitude(x: Column, parts: int = PARTS) -> Column:
    """A cell by sign and logarithm; cells are in the order of the values, since logarithms never fall.

    The magnitude 1 has a place so high that the least number has one above 0.
    """
    one, size = parts * 1100, F.abs(x)
    infinite = size == F.lit(float("inf"))
    place = F.floor(F.log2(F.when((size > 0) & ~infinite, size)) * parts) + one
    place = F.when(infinite, F.lit(2 * one)).otherwise(place)
    return F.when(x == 0, F.lit(0)).when(x > 0, place).otherwise(-place).cast("long")


def _between(x: Column, least: Column, last: Column, cells: int) -> Column:
    """One of ``cells`` equal steps from the least to the last value; this one has a further cell of its own."""
    return F.floor((x - least) / (last - least) * cells).cast("long")


def _ranks(positions: list[Callable[[Column], Column]], total: Column) -> Column:
    """The two 0-based ranks around each position; the result lies between them by the part ``f``."""
    return F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), rank(h).cast("long").alias("r"), (h - F.floor(h)).cast("double").alias("f"))
                for i, h in enumerate(p(total) for p in positions)
                for side, rank in enumerate((F.floor, F.ceil))
            ]
        )
    )


def _interpolated(names: list[str]) -> list[Column]:
    found = []
    for i, name in enumerate(names):
        mine = F.col("__w.i") == i
        lo, hi = (F.max(F.when(mine & (F.col("__w.side") == side), F.col("__v"))) for side in (0, 1))
        part = F.max(F.when(mine, F.col("__w.f")))
        found.append((lo + F.when(part == 0, F.lit(0.0)).otherwise((hi - lo) * part)).alias(name))
    return found


def exact_positions(
    df: DataFrame,
    keys: list[str],
    value: str,
    positions: list[Callable[[Column], Column]],
    names: list[str],
    bits: int = 12,
    most: int = MOST,
) -> DataFrame:
    """Values at given places of the sorted group, one row per key.

    A position maps the group size to a 0-based place; fractions interpolate.

    No group is sorted.  Each pass counts rows by cell, combined before the
    shuffle, and tells which cells hold the wanted ranks; only their rows go on.
    The first cells are magnitudes, later ones ``2**bits`` equal steps of a cell.
    A cell with one different value is settled whatever its size; up to ``most``
    values are put in order; larger cells are cut again, which always splits
    them, as the least and the last value part.  Null and NaN are left out, so
    are rows with a null key.
    """
    x = F.col(value).cast("double")
    there = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.col(value).isNotNull() & ~F.isnan(x))
    # written once: every pass must see the same values
    rows = cut(df.where(there).select(*keys, x.alias("__x")))
    group, digit, wanted, settled = list(keys), magnitude(F.col("__x")), None, []
    n, before, rank = F.col("__n"), F.col("__before"), F.col("__w.r")
    while True:
        placed = rows.withColumn("__cell", digit)
        cells = placed.groupBy(*group, "__cell").agg(
            F.count(F.lit(1)).alias("__n"), F.min("__x").alias("__a"), F.max("__x").alias("__b")
        )
        w = Window.partitionBy(*(group or [F.lit(0)]))
        cells = cells.withColumn("__below", F.sum("__n").over(w.orderBy("__cell")) - n)
        if wanted is None:
            cells = cells.withColumn("__total", F.sum("__n").over(w))
            cells = cells.withColumn("__before", F.col("__below")).withColumn("__w", _ranks(positions, F.col("__total"))).drop("__total")
        else:
            cells = cells.join(wanted, group).withColumn("__before", before + F.col("__below"))
        hot = cut(cells.drop("__below").where((rank >= before) & (rank < before + n)))
        settled.append(hot.where("__a = __b").select(*keys, "__w", F.col("__a").alias("__v")))
        several = hot.where("__a < __b")
        largest = several.agg(F.max("__n")).first()[0]
        if largest is None:
            break
        named = [F.col("__a").alias("__least"), F.col("__b").alias("__last")]
        inside = several.select(*group, "__cell", "__n", "__a", "__b").distinct()
        rows = cut(placed.join(inside, [*group, "__cell"]).select(*keys, *named, "__n", "__x"))
        wanted = several.select(*keys, *named, "__n", "__before", "__w")
        group = [*keys, "__least", "__last"]
        ordered = rows.where(n <= most).groupBy(*group).agg(F.sort_array(F.collect_list("__x")).alias("__s"))
        found = ordered.join(wanted, group)
        settled.append(found.select(*keys, "__w", F.col("__s")[(rank - before).cast("int")].alias("__v")))
        if largest <= most:
            break
        rows, wanted = (t.where(n > most).drop("__n") for t in (rows, wanted))
        digit = _between(F.col("__x"), F.col("__least"), F.col("__last"), 2**bits)
    return reduce(DataFrame.unionByName, settled).groupBy(*keys).agg(*_interpolated(names))


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    return exact_quantiles(df, keys, value, [0.5], [name])
