"""Hard negatives by a vertical scan over columns of dimensions (BOND).

Vectors lie in blocks that hold one column per dimension.  An anchor reads the
columns of a block in the order of its own largest components.  What the unread
columns can still add lies between sums of their smallest and largest
contributions, so after every few columns each candidate has a lowest and a
highest possible product.  Candidates that can no longer be among the best, or
in a wanted window of products, leave the candidate bitmap; who is left after
the last column has its exact product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.lineage import cut
from ..functions.ordered import first_k
from .arrow import schema_of

LEVELS = 256  # a component x becomes floor(LEVELS * x)
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90  # per cent of the positive's product
BLOCK_ROWS = 2048
BLOCK_ANCHORS = 2048
COLUMNS_AT_ONCE = 8
_MOST = (1 << 63) - 1


def whole(vectors: list, levels: int = LEVELS) -> np.ndarray:
    """Rows of floor(levels * x) as doubles, which hold them exactly; short vectors end in zeros."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return np.floor(levels * out)


def exact(x: np.ndarray, safe: bool) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as integers of any size."""
    return x.astype(np.int64) if safe else np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def scan(columns: np.ndarray, bitmap: np.ndarray, anchor: np.ndarray, windows: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, products) that can be among the ``k`` best of a window, for all windows (lowest, highest).

    ``columns`` has a row per dimension, ``bitmap`` says which candidates count.
    """
    rows = np.flatnonzero(bitmap)
    part = np.zeros(len(rows), columns.dtype)
    if not len(rows) or not windows:
        return rows[:0], part[:0]
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[anchor[order] != 0]
    ends = anchor[order, None] * np.stack((columns[order].min(axis=1), columns[order].max(axis=1)), axis=1)
    least, most = ends.min(axis=1), ends.max(axis=1)
    none = np.zeros(1, columns.dtype)
    # what the columns from a place on can add
    least, most = (np.concatenate((np.cumsum(e[::-1])[::-1], none)) for e in (least, most))
    for at in range(0, max(len(order), 1), COLUMNS_AT_ONCE):
        some = order[at : at + COLUMNS_AT_ONCE]
        for d in some:
            part = part + anchor[d] * columns[d][rows]
        low, high = part + least[at + len(some)], part + most[at + len(some)]
        stay = np.zeros(len(rows), bool)
        for lowest, highest in windows:
            may = (high >= lowest) & (low <= highest)
            sure = low[(low >= lowest) & (high <= highest)]
            if len(sure) >= k:
                may &= high >= np.sort(sure)[-k]
            stay |= may
        if not stay.all():
            rows, part = rows[stay], part[stay]
        if not len(rows):
            break
    return rows, part


def best_of(ids: np.ndarray, products: np.ndarray, lowest, highest, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest products inside a window, ties by smaller id."""
    inside = np.flatnonzero((products >= lowest) & (products <= highest))
    order = sorted(inside.tolist(), key=lambda i: (-products[i], ids[i])) if products.dtype == object else inside[np.lexsort((ids[inside], -products[inside]))]
    return ids[order[:k]], products[order[:k]]


_BLOCK = "block int, ids binary, labels binary, narrow boolean, dims array<binary>"
_POSITIVE = "anchor_id long, positive_id long, score long"
_NEGATIVE = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _blocks(rows: DataFrame, blocks: int, levels: int) -> DataFrame:
    """One row per block: ids, labels and a binary column per dimension."""
    schema = schema_of(_BLOCK)
    arrow = to_arrow_schema(schema)

    def pack(group: pa.Table) -> pa.Table:
        ids, labels, vectors = (group.column(c).to_pylist() for c in ("vec_id", "label", "v"))
        once: dict[int, tuple] = {}
        for i, label, v in zip(ids, labels, vectors, strict=True):
            if i not in once or (label, v) < once[i]:
                once[i] = (label, v)
        ids = sorted(once)
        x = whole([once[i][1] for i in ids], levels)
        narrow = bool((np.abs(x) < 1 << 15).all())
        dims = [c.tobytes() for c in np.ascontiguousarray(x.T.astype(np.int16 if narrow else np.float64))]
        labels = np.array([once[i][0] for i in ids], np.int64).tobytes()
        values = [[group.column("block")[0].as_py()], [np.array(ids, np.int64).tobytes()], [labels], [narrow], [dims]]
        return pa.table([pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return cut(dealt.groupBy("block").applyInArrow(pack, schema))


def _search(blocks: DataFrame, anchors: DataFrame, n_blocks: int, n_parts: int, levels: int, ddl: str, ask, k: int) -> DataFrame:
    """Every block meets all anchors, in parts; ``ask`` says what one anchor wants of one block."""
    schema = schema_of(ddl)
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids, labels = (np.frombuffer(left.column(c)[0].as_py(), np.int64) for c in ("ids", "labels"))
            dims = left.column("dims")[0].as_py()
            narrow = left.column("narrow")[0].as_py()
            columns = np.array([np.frombuffer(d, np.int16 if narrow else np.float64) for d in dims]).reshape(len(dims), len(ids))
            queries = whole(right.column("v").to_pylist(), levels)[:, : len(dims)]
            queries = np.pad(queries, ((0, 0), (0, len(dims) - queries.shape[1])))
            largest = (float(np.abs(m).max(initial=0)) for m in (columns, queries))
            safe = np.prod([len(dims), *largest]) < float(1 << 61)
            columns, queries = exact(columns.astype(np.float64), safe), exact(queries, safe)
            for row, q in zip(right.drop_columns(["v"]).to_pylist(), queries, strict=True):
                out += ask(row, q, ids, labels, columns, k)
        return pa.table([pa.array(c, f.type) for c, f in zip(list(zip(*out, strict=True)) or [[]] * len(arrow), arrow, strict=True)], schema=arrow)

    part = F.pmod(F.xxhash64("anchor_id"), F.lit(n_parts)).cast("int")
    a = anchors.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    b = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    return b.groupBy("block", "part").cogroup(a.groupBy("block", "part")).applyInArrow(run, schema)


def _saturated(x) -> int:
    return int(max(-_MOST, min(_MOST, int(x))))


def _ask_positives(row, q, ids, labels, columns, k):
    rows, products = scan(columns, (labels == row["label"]) & (ids != row["anchor_id"]), q, [(-np.inf, np.inf)], k)
    got = best_of(ids[rows], products, -np.inf, np.inf, k)
    return [(row["anchor_id"], int(i), _saturated(s)) for i, s in zip(*got, strict=True)]


def window_of(positive: int, lowest: int = LOWEST, highest: int = HIGHEST) -> tuple[int, int]:
    """Whole products s with lowest * positive <= 100 * s <= highest * positive."""
    return -(-lowest * positive // 100), highest * positive // 100


def hard_negatives(
    data: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
    positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST, levels: int = LEVELS,
    block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``vec_id``, ``label`` an expression on the
    columns of ``data`` (``label`` itself if not given).  Scores are products of
    vectors of whole numbers; positives are an anchor's best rows of its label,
    negatives the best rows of other labels within per cent bounds of the
    positive's product.

    Rows with a null id, label, vector or component, or a component that is not
    finite, take no part.  Vectors of unlike length are compared as if the
    shorter ended in zeros, so empty ones score 0.  Of rows that repeat an id
    the one with the smallest label, then vector counts.  Ties go to smaller
    ids.  Products beyond 64 bits are found exactly, then shown as the largest
    64-bit number.  An empty table gives none.

    The search is quadratic by its question (a share of all rows against all
    rows); it is dealt out as block times part of the anchors, so no task holds
    more than a block of rows and one of anchors, whatever a label's share.
    """
    spark = data.sparkSession
    values = F.col(vector_col)
    finite = F.forall(values, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    given = data.select(F.col(id_col).cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"), values.alias("v"), finite.alias("ok"))
    rows = given.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND ok").drop("ok")
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, F.lit(1)))).first()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    n_blocks, n_parts = -(-n // block_rows), -(-n_anchors // block_anchors)
    blocks = _blocks(rows, n_blocks, levels)
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x"))
    anchors = cut(anchors.select(F.col("vec_id").alias("anchor_id"), "x.label", "x.v"))

    near = _search(blocks, anchors, n_blocks, n_parts, levels, _POSITIVE, _ask_positives, positives)
    near = first_k(near, ["anchor_id"], [F.desc("score"), "positive_id"], positives, "place")
    wanted = cut(near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("positives")))

    def ask_negatives(row, q, ids, labels, columns, k):
        windows = [(p, window_of(p["score"], lowest, highest)) for p in row["positives"]]
        windows = [(p, w) for p, w in windows if w[0] <= w[1]]
        found, products = scan(columns, labels != row["label"], q, [w for _, w in windows], k)
        out = []
        for p, w in windows:
            for i, s in zip(*best_of(ids[found], products, *w, k), strict=True):
                out.append((row["anchor_id"], p["positive_id"], p["score"], int(i), _saturated(s)))
        return out

    far = _search(blocks, anchors.join(wanted, "anchor_id"), n_blocks, n_parts, levels, _NEGATIVE, ask_negatives, negatives)
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = far.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
