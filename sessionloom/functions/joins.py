"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lineage import cut


def attach(df: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner", salts: int = 1) -> DataFrame:
    """Join a table that has at most one row per key to a large table.

    Adaptive execution measures the partitions and splits those of a hot key of
    ``df``, so nothing is copied where no key is hot.  With ``salts`` a known
    hot key is spread by hand: the small side is copied once per salt, and the
    salt comes from the row itself, so a retried task places its rows as before.
    """
    if not keys:
        return with_row(df, per_key)
    nested = (T.ArrayType, T.MapType, T.StructType)
    spread = [f.name for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, nested)]
    if salts < 2 or not spread:
        return df.join(per_key, keys, how)
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    copies = per_key.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("__salt", salt).join(copies, [*keys, "__salt"], how).drop("__salt")


def with_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row (scalar subquery)."""
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("__row")).scalar()
    added = df.withColumn("__row", packed)
    return added.select(*df.columns, *[F.col("__row")[c].alias(c) for c in cols])


#: One level of the interval index joins 2**STEP nodes of the level below; 15 levels (shifts below 64) span all cells.
STEP = 4
#: Cells beyond are one cell at each end; the comparison with the interval itself decides there.
FAR = 2**55


def _cell(x: Column, width: float) -> Column:
    """Number of the finest cell a value lies in."""
    return F.greatest(F.lit(-FAR), F.least(F.lit(FAR), F.floor(x / F.lit(width)).cast("long")))


def _up(cell: Column, level: Column) -> Column:
    """The node of ``level`` above a finest cell."""
    return F.call_function("shiftright", cell, (level * STEP).cast("int"))


def interval_nodes(intervals: DataFrame, start: str, end: str, width: float) -> DataFrame:
    """Intervals over the nodes of a grid with levels: columns ``__level``, ``__cell``, ``__full``.

    A node of level 0 is a cell of ``width``, one of the next level 16 of them
    and so on.  An interval is cut into the coarsest nodes that it covers
    (``__full``) and the cells in which it begins and ends, so its rows grow
    with the logarithm of its length and each of its points lies in one of them.
    """
    s, e = F.col(start), F.col(end)
    a, b = F.col("__first_cell"), F.col("__last_cell")
    covers = (s <= a * F.lit(float(width))) & (a > -FAR) & (a < b)
    node = lambda level, cell, full: F.struct(
        level.cast("int").alias("level"), cell.cast("long").alias("cell"), F.lit(full).alias("full")
    )
    ends = F.when((a == b) | covers, F.array(b)).otherwise(F.array(a, b))
    lo, hi = F.when(covers, a).otherwise(a + 1), b  # cells lo, ..., hi - 1 are covered
    first = lambda level: -_up(-lo, level)  # noqa: E731  # rounded up
    last = lambda level: _up(hi, level)  # noqa: E731  # rounded down, itself not covered
    run = lambda x, y: F.when(x < y, F.sequence(x, y - 1)).otherwise(F.array().cast("array<bigint>"))

    def at(level: Column) -> Column:
        x, y = first(level), last(level)
        inner_x, inner_y = first(level + 1) * 2**STEP, last(level + 1) * 2**STEP
        cells = F.when(inner_x < inner_y, F.concat(run(x, inner_x), run(inner_y, y))).otherwise(run(x, y))
        return F.transform(cells, lambda c: node(level, c, True))

    top = F.floor(F.log2(F.greatest(F.lit(1), hi - lo)) / STEP).cast("int")
    nodes = F.concat(F.transform(ends, lambda c: node(F.lit(0), c, False)), F.flatten(F.transform(F.sequence(F.lit(0), top), at)))
    return (
        intervals.where(e >= s)
        .withColumns({"__first_cell": _cell(s, width), "__last_cell": _cell(e, width)})
        .withColumn("__node", F.explode(nodes))
        .select(
            *intervals.columns, F.col("__node.level").alias("__level"), F.col("__node.cell").alias("__cell"), F.col("__node.full").alias("__full")
        )
    )


def _levels(nodes: DataFrame) -> list[int]:
    """Levels that hold nodes, 15 at most."""
    return sorted(r[0] for r in nodes.select("__level").distinct().collect())


def _point_nodes(points: DataFrame, levels: list[int], point: str, width: float) -> DataFrame:
    """Every point once per level: only level 0 where no interval is long."""
    level = F.explode(F.array(*[F.lit(n) for n in levels])) if len(levels) > 1 else F.lit(levels[0] if levels else 0)
    return points.withColumn("__level", level).withColumn("__cell", _up(_cell(F.col(point), width), F.col("__level")))


def _outermost(nodes: DataFrame, keys: list[str], levels: list[int]) -> DataFrame:
    """The nodes without those that lie inside a covered node: none is above another."""
    place = [*keys, "__level", "__cell"]
    covered = nodes.where("__full").select(*place).distinct().withColumnsRenamed({"__level": "__above", "__cell": "__node"})
    above = F.filter(
        F.array(*[F.lit(n) for n in levels]), lambda u: (u > F.col("__level")) | ((u == F.col("__level")) & ~F.col("__full"))
    )
    inner = (
        nodes.select(*place, "__full")
        .distinct()
        .withColumn("__above", F.explode(above))
        .withColumn("__node", _up(F.col("__cell"), F.col("__above") - F.col("__level")))
    )
    hidden = inner.join(covered, [*keys, "__above", "__node"], "left_semi").select(*place, "__full").distinct()
    return nodes.join(hidden, [*place, "__full"], "left_anti")


def points_in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    point: str,
    start: str,
    end: str,
    width: float,
    how: str = "inner",
    open_end: bool = False,
) -> DataFrame:
    """Pairs with ``start <= point <= end`` (``< end`` with ``open_end``) per key.

    Intervals lie on the nodes of a grid with levels (``interval_nodes``), so
    the join key is (keys, node) instead of the key alone, each pair appears
    once, and an interval of any length is a few rows.  ``how`` is inner or
    left_semi (each point that lies in some interval, once).
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"inner or left_semi, not {how}")
    if how == "left_semi":
        intervals = intervals.select(*keys, start, end).distinct()
    iv = cut(interval_nodes(intervals, start, end, width))
    levels = _levels(iv)
    if how == "left_semi" and len(levels) > 1:
        iv = _outermost(iv, keys, levels)
    p, v = _point_nodes(points, levels, point, width).alias("p"), iv.alias("v")
    on: Column = (F.col("p.__cell") == F.col("v.__cell")) & (F.col("p.__level") == F.col("v.__level"))
    for k in keys:
        on &= F.col(f"p.{k}") == F.col(f"v.{k}")
    inside = F.col(f"p.{point}") < F.col(f"v.{end}") if open_end else F.col(f"p.{point}") <= F.col(f"v.{end}")
    on &= (F.col(f"p.{point}") >= F.col(f"v.{start}")) & inside
    joined = p.join(v, on, how)
    kept = [F.col(f"p.{c}") for c in points.columns]
    if how == "inner":
        kept += [F.col(f"v.{c}") for c in intervals.columns if c not in keys]
    return joined.select(*kept)


def first_containing(
    points: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    point: str,
    start: str,
    end: str,
    order: list[str],
    attrs: list[str],
    width: float,
    ids: list[str],
    out: str = "hit",
) -> DataFrame:
    """For every point the first interval (by ``order``) that contains it, or null.

    An interval that covers a whole node contains every point of the node, so
    only the first such interval per node is kept.  What remains to be tried
    per point are one interval per level and the intervals that begin or end
    inside its own cell.  ``ids`` identify a point within its key.
    """
    packed = F.struct(*[F.col(c) for c in [*order, *attrs, start, end] if c not in keys])
    named = intervals.select(*keys, F.col(start).alias("__s"), F.col(end).alias("__e"), packed.alias("__iv"))
    nodes = cut(interval_nodes(named, "__s", "__e", width))
    place = [*keys, "__level", "__cell"]
    full = nodes.where("__full").groupBy(*place).agg(F.min_by(F.struct("__s", "__e", "__iv"), "__iv").alias("__r"))
    tried = nodes.where("NOT __full").select(*place, "__s", "__e", "__iv").unionByName(full.select(*place, "__r.*"))

    rest = [c for c in ids if c not in keys]
    near = _point_nodes(points.select(*keys, *rest, F.col(point).alias("__p")), _levels(nodes), "__p", width)
    on: Column = (F.col("a.__cell") == F.col("b.__cell")) & (F.col("a.__level") == F.col("b.__level"))
    for k in keys:
        on &= F.col(f"a.{k}") == F.col(f"b.{k}")
    on &= (F.col("a.__p") >= F.col("b.__s")) & (F.col("a.__p") <= F.col("b.__e"))
    hits = near.alias("a").join(tried.alias("b"), on).groupBy(*[F.col(f"a.{c}").alias(c) for c in [*keys, *rest]])
    return points.join(hits.agg(F.min("b.__iv").alias(out)), [*keys, *rest], "left")
