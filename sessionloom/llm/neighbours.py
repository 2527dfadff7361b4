"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are projected to a few dimensions by Gaussian (2-stable) directions:
the squared projected distance over the squared true distance follows a
chi-square law.  Projected neighbours are taken in order from a kd-tree and
verified on the original vectors, until the law says that a vector nearer than
the k-th best so far would, with the wanted probability, have been met.

Largest inner product becomes nearest distance by one more coordinate: with M
the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q M / |q|, 0).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.lineage import cut
from ..functions.ordered import first_k
from .arrow import schema_of

DIMENSIONS = 8  # even, for the closed form of the law
SURE = 0.985  # probability of the stopping test
LEAF = 128
CELL_ROWS = 8192
SAMPLE = 1 << 16
MOST_CELLS = 1 << 12
LARGEST = 1e140  # norms beyond, or below 1 / LARGEST, are not projected: their squares leave the doubles
BLOCK = 2048


def chi_square(x: float, m: int = DIMENSIONS) -> float:
    """P(chi-square with an even number m of degrees <= x)."""
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def quantile(p: float, m: int = DIMENSIONS) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, m) < p else (lo, mid)
    return hi


def directions(width: int, m: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(width).normal(size=(width + 1, m))


def project(x: np.ndarray, top: float, query: bool) -> np.ndarray:
    """Projections of rows, as data or as queries."""
    norms = np.sqrt((x * x).sum(axis=1))
    if query:
        full = np.column_stack((x * (top / norms)[:, None], np.zeros(len(x))))
    else:
        full = np.column_stack((x, np.sqrt(np.maximum(top * top - norms * norms, 0))))
    return np.einsum("ij,jk->ik", full, directions(x.shape[1]))


def kd_leaves(points: np.ndarray, leaf: int, most: int = 1 << 30) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, low, high) of kd-tree leaves; each split halves the widest side."""
    m = points.shape[1]
    todo = [(np.arange(len(points)), np.full(m, -np.inf), np.full(m, np.inf))]
    done = []
    while todo:
        rows, low, high = todo.pop(0)
        p = points[rows]
        if len(rows) <= leaf or len(done) + len(todo) + 2 > most or (p.max(axis=0) == p.min(axis=0)).all():
            done.append((rows, low, high))
            continue
        axis = int((p.max(axis=0) - p.min(axis=0)).argmax())
        at = float(np.median(p[:, axis]))
        left = p[:, axis] < at
        if not left.any():  # more than half are equal to the smallest
            at = float(p[:, axis][p[:, axis] > at].min())
            left = p[:, axis] < at
        a, b = high.copy(), low.copy()
        a[axis] = b[axis] = at
        todo += [(rows[left], low, a), (rows[~left], b, high)]
    return done


def gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    off = np.maximum(np.maximum(low[None] - points[:, None], points[:, None] - high[None]), 0)
    return (off * off).sum(axis=2)


def search_cell(
    ids: np.ndarray, x: np.ndarray, q: np.ndarray, bounds: np.ndarray, k: int, top: float, limit: float
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Best ``k`` (ids, inner products) per query among the rows of one cell.

    ``bounds`` are inner products that k vectors elsewhere already reach.
    """
    data, query = project(x, top, False), project(q, top, True)
    leaves = kd_leaves(data, LEAF)
    rows = [r for r, _, _ in leaves]
    low = np.array([data[r].min(axis=0) for r in rows])
    high = np.array([data[r].max(axis=0) for r in rows])
    scale = top / np.sqrt((q * q).sum(axis=1))
    lengths = (data * data).sum(axis=1)
    out = []
    for j in range(len(q)):
        far = gaps(query[j : j + 1], low, high)[0]
        order = np.argsort(far, kind="stable")
        best_rows, best = np.zeros(0, np.int64), np.zeros(0)
        own = float(query[j] @ query[j])
        seen, step = 0, 2
        while seen < len(order):
            kth = max(float(bounds[j]), float(best[k - 1]) if len(best) >= k else -np.inf)
            # squared distance that belongs to the k-th inner product; beyond reach the test holds
            reach = limit * max(2 * top * top - 2 * scale[j] * kth, 0.0) if np.isfinite(kth) else np.inf
            if far[order[seen]] > reach:
                break
            near = np.concatenate([rows[i] for i in order[seen : seen + step]])
            seen, step = seen + step, step * 2
            if np.isfinite(reach):
                near = near[lengths[near] - 2 * (data[near] @ query[j]) + own <= reach]
            score = x[near] @ q[j]
            best_rows, best = np.concatenate((best_rows, near)), np.concatenate((best, score))
            keep = np.lexsort((ids[best_rows], -best))[:k]
            best_rows, best = best_rows[keep], best[keep]
        # what is returned is added up in one order, whatever kernel has compared
        out.append((ids[best_rows], (x[best_rows] * q[j]).sum(axis=1)))
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.values if hasattr(column, "values") else pa.concat_arrays([c.values for c in column.chunks])
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def nearest(
    data: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", sure: float = SURE,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every query row, the row itself left out.

    ``is_query`` is a condition on the column ``vec_id``.  Rows without id, and
    vectors that are null, empty, zero, of another width than most, or hold
    null or non-finite components take no part.

    Equal vectors are one point with its k + 1 smallest ids, which is all that
    any result can need.  The top of the kd-tree is cut from a sample of at
    most SAMPLE points into at most MOST_CELLS cells; every vector is put into
    its cell.  A query first searches its own cell; with the k-th product from
    there it goes only to cells the stopping test cannot exclude.

    Vectors whose norm is no ordinary number (LARGEST) are compared exactly, in
    blocks: as data with all queries, as queries with all data.  A product
    beyond the doubles is infinite; infinite ones tie.
    """
    spark = data.sparkSession
    v = F.col("v")
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))
    rows = data.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size("v") > 0)).where(finite)
    rows = rows.where(F.exists("v", lambda e: e != 0)).withColumn("norm", norm)
    rows = rows.withColumn("odd", (F.col("norm") < F.lit(1 / LARGEST)) | (F.col("norm") > F.lit(LARGEST)))
    widths = rows.groupBy(F.size("v").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(~F.col("odd"), F.col("norm"))).alias("top"), F.count_if("odd").alias("n_odd")
    )
    usual = widths.orderBy(F.desc("n"), "w").first()
    out = "query_id long, rank int, vec_id long, score double"
    if usual is None:
        return spark.createDataFrame([], out)
    width, top, n, n_odd = usual["w"], usual["top"], usual["n"], usual["n_odd"]
    rows = cut(rows.where(F.size("v") == width).select("vec_id", "v", "odd", F.xxhash64("v").alias("h")))

    every = cut(
        first_k(rows, ["h", "v"], ["vec_id"], k + 1, "place")
        .groupBy("h", "v", "odd")
        .agg(F.min("vec_id").alias("point"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    asked = rows.where(is_query).select("vec_id", "h", "v")
    asked = cut(asked.join(every.select("h", "v", "point"), ["h", "v"]).select(F.col("vec_id").alias("query_id"), "point"))
    searched = asked.select("point").distinct().join(every.select("point", "v", "odd"), "point").select("point", "v", "odd")
    need = k + 1
    found = []
    if n_odd:
        searched = cut(searched)
        odd, plain = every.where("odd"), every.where("NOT odd")
        found = [compared(searched, odd, need, n, n_odd), compared(searched.where("odd"), plain, need, n_odd, n)]
    if n > n_odd:
        queries = searched.where("NOT odd").select("point", "v")
        found += _in_cells(every.where("NOT odd"), queries, n, float(top), need, sure, cell_rows)
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    best = first_k(hits, ["query"], [F.desc("score"), "point"], need, "place").drop("place")
    # Points to ids: equal vectors have equal products, ties go to the smaller id.
    ids = every.select("point", F.explode("ids").alias("vec_id"))
    listed = first_k(best.join(ids, "point"), ["query"], [F.desc("score"), "vec_id"], need, "place")
    per_query = asked.join(listed, asked["point"] == listed["query"]).where("query_id <> vec_id")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return per_query.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of all rows with one vector; only the results may leave the doubles."""
    _, a = np.frexp(np.abs(x).max(axis=1))
    _, b = np.frexp(np.abs(q).max())
    with np.errstate(over="ignore", under="ignore"):
        return np.ldexp((np.ldexp(x, -a[:, None]) * np.ldexp(q, -b)).sum(axis=1), a + b)


def compared(queries: DataFrame, points: DataFrame, need: int, n_queries: int, n_points: int) -> DataFrame:
    """query, point, score: the ``need`` best points of every query by blocks of both tables.

    The two numbers bound the rows of the tables and say how many blocks there are.
    """
    schema = schema_of("query long, point long, score double")
    arrow = to_arrow_schema(schema)
    blocks = {"i": max(1, -(-n_queries // BLOCK)), "j": max(1, -(-n_points // BLOCK))}
    own = lambda c: F.pmod(F.xxhash64("point"), F.lit(blocks[c])).cast("long").alias(c)
    each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks[c] - 1).cast("long"))).alias(c)

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        names, ids = left.column("point").to_numpy(), right.column("point").to_numpy()
        q, x = _vectors(left.column("v")), _vectors(right.column("v"))
        out = []
        for j, name in enumerate(names):
            score = products(x, q[j])
            kept = np.lexsort((ids, -score))[:need]
            out.append(pa.table([np.full(len(kept), name), ids[kept], score[kept]], schema=arrow))
        return pa.concat_tables(out)

    a = queries.select(own("i"), each("j"), "point", "v")
    b = points.select(each("i"), own("j"), "point", "v")
    return a.groupBy("i", "j").cogroup(b.groupBy("i", "j")).applyInArrow(best, schema)


def _in_cells(
    points: DataFrame, queries: DataFrame, n: int, top: float, need: int, sure: float, cell_rows: int
) -> list[DataFrame]:
    """query, point, score: what the search through the cells of the tree finds."""
    # the top of the tree
    some = points.where(F.pmod(F.xxhash64("point"), F.lit(max(1, n))) < SAMPLE).select("v").limit(SAMPLE)
    sample = _sampled(some, top)
    cells = max(1, min(MOST_CELLS, -(-n // cell_rows)))
    boxes = kd_leaves(sample, 1, cells)
    low, high = np.array([b[1] for b in boxes]), np.array([b[2] for b in boxes])

    schema = schema_of("cell int, point long, v array<double>")
    arrow = to_arrow_schema(schema)

    def place(as_query: bool):
        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                p = project(_vectors(b.column(1)), top, as_query)
                inside = np.zeros(len(p), np.int64)
                for i in range(0, len(p), 1024):
                    part = p[i : i + 1024, None]
                    inside[i : i + 1024] = ((part >= low[None]) & (part < high[None])).all(axis=2).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(inside, pa.int32()), b.column(0), b.column(1)], schema=arrow)

        return run

    placed = cut(points.select("point", "v").mapInArrow(place(False), schema))
    home = cut(queries.mapInArrow(place(True), schema))

    limit = quantile(sure)
    found_schema = schema_of("query long, point long, score double")
    found_arrow = to_arrow_schema(found_schema)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return found_arrow.empty_table()
        ids = left.column("point").to_numpy()
        x, q = _vectors(left.column("v")), _vectors(right.column("v"))
        got = search_cell(ids, x, q, right.column("bound").to_numpy(), need, top, limit)
        names = np.repeat(right.column("point").to_numpy(), [len(a) for a, _ in got])
        return pa.table([names, np.concatenate([a for a, _ in got]), np.concatenate([s for _, s in got])], schema=found_arrow)

    def visit(queries: DataFrame) -> DataFrame:
        return placed.groupBy("cell").cogroup(queries.groupBy("cell")).applyInArrow(search, found_schema)

    never = F.lit(float("-inf"))
    first = cut(visit(home.withColumn("bound", never)))
    kth = first.groupBy("query").agg(F.when(F.count(F.lit(1)) >= need, F.min("score")).otherwise(never).alias("bound"))
    bounded = home.join(kth.withColumnRenamed("query", "point"), "point", "left").withColumn("bound", F.coalesce("bound", never))

    more_schema = schema_of("cell int, point long, v array<double>, bound double")
    more_arrow = to_arrow_schema(more_schema)

    def spread(batches):
        for b in batches:
            if not b.num_rows:
                continue
            q, bound, own = _vectors(b.column(2)), b.column(3).to_numpy(), b.column(0).to_numpy()
            scale = top / np.sqrt((q * q).sum(axis=1))
            reach = limit * np.maximum(2 * top * top - 2 * scale * np.where(np.isfinite(bound), bound, 0), 0)
            reach = np.where(np.isfinite(bound), reach, np.inf)
            p = project(q, top, True)
            for i in range(0, len(p), 256):
                open_ = gaps(p[i : i + 256], low, high) <= reach[i : i + 256, None]
                open_[np.arange(len(open_)), own[i : i + 256]] = False
                r, c = np.nonzero(open_)
                if len(r):
                    t = b.take(pa.array(r + i))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), *t.columns[1:]], schema=more_arrow)

    rest = visit(bounded.select("cell", "point", "v", "bound").mapInArrow(spread, more_schema))
    return [first, rest]


def _sampled(some: DataFrame, top: float) -> np.ndarray:
    """Projections of the bounded sample, on the driver."""
    schema = schema_of("p array<double>")
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(project(_vectors(b.column(0)), top, False).tolist(), arrow.field(0).type)], schema=arrow)

    rows = some.mapInArrow(run, schema).collect()
    return np.array(sorted(r.p for r in rows)).reshape(len(rows), DIMENSIONS)
