"""Ranked search with range-maximum tables over posting lists.

Documents are searched in shards.  A shard has one posting list per term of the
questions, ordered by document, with what the term adds to each document's
score, and a sparse table that answers where the largest of any range lies.  A
question starts from the interval of all documents of the shard.  The sum of
the weighted maxima of its terms bounds every score in an interval.  Intervals
are taken best bound first, many at a time, and split at the document of their
largest single contribution, which is scored; short intervals are scored whole.
An interval whose bound is below the k-th score so far is never opened.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.lineage import cut
from .arrow import map_columns, schema_of

K = 50
SHARD_DOCS = 1 << 14
SHARD_POSTINGS = 1 << 20
LEAF = 64  # documents of an interval that are scored rather than split
AT_ONCE = 512  # intervals opened together
MOST_TERMS = 1 << 18  # of the questions of one round

# bytes of words stay, A-Z in lower case; all others part words
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and all characters beyond ASCII; only A-Z is lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


class Shard:
    """Posting lists of some documents with their range-maximum tables."""

    def __init__(self, ids: np.ndarray, length: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, n: int, total: int, n_terms: int):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.docs = ids[order], len(ids)
        m = 50 + (50 * length * n) // total
        doc = np.repeat(place, sizes)
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes))
        keys = terms * self.docs + doc
        by = np.argsort(keys, kind="stable")
        self.keys, self.doc, self.impact = keys[by], doc[by], impact[by]
        self.start = np.searchsorted(self.keys, np.arange(n_terms + 1) * self.docs)
        longest = int(np.diff(self.start).max(initial=1))
        self.table = np.empty((max(longest, 1).bit_length(), len(keys)), np.int32)
        self.table[0] = np.arange(len(keys))
        for level in range(1, len(self.table)):
            half = 1 << (level - 1)
            before = self.table[level - 1]
            a, b = before[:-half], before[half:]
            self.table[level] = before
            self.table[level, :-half] = np.where(self.impact[a] >= self.impact[b], a, b)

    def maxima(self, a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound and splitting document of intervals; ``a`` and ``b`` hold the range of each term's list."""
        held = b > a
        length = np.where(held, b - a, 1)
        level = np.frexp(length)[1] - 1
        first = np.where(held, a, 0)
        p, q = self.table[level, first], self.table[level, np.where(held, b - (1 << level), 0)]
        best = np.where(self.impact[p] >= self.impact[q], p, q)
        value = np.where(held, self.impact[best] * weights, 0)
        top = value.argmax(axis=1)
        return value.sum(axis=1), self.doc[best[np.arange(len(best)), top]]

    def whole(self, a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All documents that the ranges hold, with their scores."""
        count = (b - a).ravel()
        index = np.repeat(a.ravel() - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        score = np.zeros(self.docs, np.int64)
        np.add.at(score, self.doc[index], self.impact[index] * np.repeat(np.tile(weights, len(a)), count))
        docs = np.flatnonzero(score)
        return docs, score[docs]

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` documents (as places) of the highest scores, ties by smaller id."""
        held = (weights > 0) & (self.start[terms + 1] > self.start[terms])
        terms, weights = terms[held], weights[held]
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(terms):
            return found, scores
        a, b = self.start[terms][None], self.start[terms + 1][None]
        low, high = np.zeros(1, np.int64), np.full(1, self.docs)
        bound, split = self.maxima(a, b, weights)
        while len(bound):
            kth = scores[-1] if len(scores) >= k else 1
            open_ = np.flatnonzero(bound >= kth)
            if len(open_) > AT_ONCE:
                open_ = open_[np.argpartition(-bound[open_], AT_ONCE)[:AT_ONCE]]
            if not len(open_):
                break
            rest = np.ones(len(bound), bool)
            rest[open_] = False
            rest &= bound >= kth
            lo, hi, x, y, d = low[open_], high[open_], a[open_], b[open_], split[open_]
            short = hi - lo <= LEAF
            new = [self.whole(x[short], y[short], weights)] if short.any() else []
            lo, hi, x, y, d = lo[~short], hi[~short], x[~short], y[~short], d[~short]
            low, high, a, b, bound, split = low[rest], high[rest], a[rest], b[rest], bound[rest], split[rest]
            if len(d):
                keys = terms[None] * self.docs + d[:, None]
                at = np.searchsorted(self.keys, keys)
                has = (at < y) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys)
                new.append((d, (np.where(has, self.impact[np.where(has, at, 0)], 0) * weights).sum(axis=1)))
                lo, hi = np.concatenate((lo, d + 1)), np.concatenate((d, hi))
                x, y = np.concatenate((x, at + has)), np.concatenate((at, y))
                more, where = self.maxima(x, y, weights)
                some = more > 0
                low, high = np.concatenate((low, lo[some])), np.concatenate((high, hi[some]))
                a, b = np.concatenate((a, x[some])), np.concatenate((b, y[some]))
                bound, split = np.concatenate((bound, more[some])), np.concatenate((split, where[some]))
            found = np.concatenate([found, *[f for f, _ in new]])
            scores = np.concatenate([scores, *[s for _, s in new]])
            top = np.lexsort((found, -scores))[:k]
            found, scores = found[top], scores[top]
        return found, scores


def _postings(docs: DataFrame, index: dict[bytes, int]) -> DataFrame:
    """doc_id, n and the terms of the questions with their counts, for every document with a term."""

    def run(ids, texts):
        n, terms, tfs = [], [], []
        for text in texts:
            words = terms_of(text)
            held = sorted((index[w], c) for w, c in Counter(words).items() if w in index)
            n.append(len(words))
            terms.append([t for t, _ in held])
            tfs.append([c for _, c in held])
        return {"doc_id": ids, "n": n, "terms": terms, "tf": tfs}

    return cut(map_columns(docs, run, "doc_id long, n long, terms array<int>, tf array<int>").where("n > 0"))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(column.offsets.to_numpy())
    return sizes, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _answers(postings: DataFrame, asked: list[tuple[int, list[int]]], weight: np.ndarray, n: int, total: int, k: int, docs: int, most: int) -> DataFrame:
    """item_id, doc_id, score: the ``k`` best of every shard for every question."""
    schema = schema_of("item_id long, doc_id long, score long")
    arrow = to_arrow_schema(schema)

    def search(held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held).combine_chunks()
        ids, length = (table.column(c).to_numpy() for c in ("doc_id", "n"))
        sizes, terms = _flat(table.column("terms").chunk(0))
        _, tf = _flat(table.column("tf").chunk(0))
        shard = Shard(ids, length, sizes, terms, tf, n, total, len(weight))
        for item, wanted in asked:
            wanted = np.array(wanted, np.int64)
            found, scores = shard.best(wanted, weight[wanted], k)
            if len(found):
                columns = [pa.array(np.full(len(found), item, np.int64)), pa.array(shard.ids[found]), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches):
        held, rows, count = [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # a shard ends with its documents or its postings, whichever is full first
                sizes = np.diff(batch.column(2).offsets.to_numpy())[at:]
                fits = max(int(np.searchsorted(np.cumsum(sizes), max(most - count, 1), "right")), 1)
                take = min(fits, docs - rows, batch.num_rows - at)
                held.append(batch.slice(at, take))
                at, rows, count = at + take, rows + take, count + int(sizes[:take].sum())
                if rows >= docs or count >= most or (take == fits and at < batch.num_rows):
                    yield from search(held)
                    held, rows, count = [], 0, 0
        if held:
            yield from search(held)

    # the written lists are much smaller than the texts: dealt out so that about one shard falls to a task
    return postings.where(F.size("terms") > 0).repartition(-(-n // docs)).mapInArrow(run, schema)


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS, most_terms: int = MOST_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of the highest scores above 0 for every item.

    Weights and lengths come from all documents, scores are whole numbers, equal
    scores go by ascending id.  Null and empty texts have no terms and count
    nowhere.  Rows without id take no part; rows that repeat a document's id are
    documents of their own; rows that repeat an item's id are one item with the
    terms of all.  An empty table on either side gives none.  Only the four
    named columns are read.

    Questions go to the tasks in rounds of about ``most_terms`` terms, which
    bounds what is sent; each round reads the texts again.  A shard is what a
    task holds at once, so memory does not grow with the table.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id IS NOT NULL")
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("item_id IS NOT NULL")
    asked = map_columns(asked, lambda i, t: {"item_id": i, "terms": [sorted(set(terms_of(x))) for x in t]}, "item_id long, terms array<binary>")
    asked = cut(asked.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")))
    rounds = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // most_terms)
    parts = []
    for r in range(rounds):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r).collect()  # bounded by most_terms
        index: dict[bytes, int] = {}
        questions = [(q.item_id, [index.setdefault(bytes(t), len(index)) for t in q.terms]) for q in mine]
        postings = _postings(texts, index)
        n, total = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n:
            break
        held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
        weight = np.zeros(len(index), np.int64)
        for row in held:
            weight[row.term] = math.floor(1000 * math.log((2 * n + 2) / (2 * row.df + 1)))
        parts.append(_answers(postings, questions, weight, n, total, k, shard_docs, shard_postings))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
