"""Exact duplicates by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

import hashlib

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut
from .arrow import among, id_and_text, map_columns

BLANKS = b" \t\n\x0b\x0c\r"
PREFIX = 256


def normalised(text: str) -> bytes:
    """The text in UTF-8 without blanks; two texts are equal when these bytes are."""
    return text.encode("utf-8", "surrogatepass").translate(None, BLANKS)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SHA-256 of every normalised text: doc_id, text_sha256."""

    def run(ids, texts):
        return {"doc_id": ids, "text_sha256": [hashlib.sha256(normalised(t)).hexdigest() for t in texts]}

    return map_columns(id_and_text(docs, id_col, text_col), run, "doc_id long, text_sha256 string")


def _outlines(docs: DataFrame, prefix: int) -> DataFrame:
    def run(ids, texts):
        keys = [normalised(t) for t in texts]
        return {
            "doc_id": ids,
            "points": [len(t) for t in texts],
            "length": [len(k) for k in keys],
            "prefix": [xxhash.xxh3_64_intdigest(k[:prefix]) - (1 << 63) for k in keys],
        }

    return map_columns(docs, run, "doc_id long, points long, length long, prefix long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """Groups of texts that are equal but for blanks.

    One row per document: doc_id, keep_id, group_size, kept, copies.  Of equal
    texts the one with the most code points stays, then the smallest id.

    The first pass keeps only lengths and hashes of a prefix.  Documents that
    are alone with their length, then with their length and prefix, are done.
    Only the texts of the others are read again and hashed as a whole.

    Null text counts as empty.  ``doc_id`` names a document: rows that repeat
    an id count once, the row with the most code points stands for them, and
    ``copies`` tells how many there were (null is an id like any other).
    """
    texts = id_and_text(docs, id_col, text_col)
    outline = F.struct("points", "length", "prefix")
    first = cut(
        _outlines(texts, prefix)
        .groupBy("doc_id")
        .agg(F.max(outline).alias("o"), F.count(F.lit(1)).alias("copies"))
        .select("doc_id", "o.*", "copies")
    )
    # copies are counted before lengths meet, so a group of many copies is one row
    counted = first.groupBy("length", "prefix").agg(F.count(F.lit(1)).alias("n"))
    lengths = counted.groupBy("length").agg(F.sum("n").alias("all")).where("all > 1").select("length")
    prefixes = counted.where("n > 1").join(lengths, "length", "left_semi").select("length", "prefix")
    open_ids = cut(first.join(prefixes, ["length", "prefix"], "left_semi").select("doc_id"))
    candidates = among(texts, open_ids)

    def full(ids, texts):
        keys = [normalised(t) for t in texts]
        return {
            "doc_id": ids,
            "points": [len(t) for t in texts],
            "digest": [len(k).to_bytes(8, "big") + hashlib.sha256(k).digest() for k in keys],
        }

    hashed = (
        map_columns(candidates, full, "doc_id long, points long, digest binary")
        .groupBy("doc_id")
        .agg(F.max(F.struct("points", "digest")).alias("o"))
        .select("doc_id", "o.*")
    )
    hashed = cut(hashed)
    best = F.max_by(F.struct("doc_id"), F.struct("points", F.col("doc_id").isNotNull(), -F.col("doc_id")))
    groups = hashed.groupBy("digest").agg(best.alias("b"), F.count(F.lit(1)).alias("group_size"))
    # Only groups of two and more are looked up; a group of many copies is one row here.
    more = groups.where("group_size > 1").select("digest", F.col("b.doc_id").alias("keep_id"), "group_size")
    members = hashed.join(more, "digest").select("doc_id", "keep_id", "group_size", F.lit(True).alias("found"))
    f, m = first.select("doc_id", "copies").alias("f"), members.alias("m")
    return f.join(m, F.col("f.doc_id").eqNullSafe(F.col("m.doc_id")), "left").select(
        F.col("f.doc_id").alias("doc_id"),
        F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("f.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("f.doc_id").eqNullSafe(F.col("keep_id")) | F.col("found").isNull(), F.lit(True)).alias("kept"),
        "copies",
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; repeated rows of an id become one.

    Null and empty texts are equal, null is an id like any other, an empty table
    gives none, and other columns may have any name.
    """
    groups = cut(exact_groups(docs, id_col, text_col).where("NOT kept OR copies > 1").select("doc_id", "kept", "copies"))
    once = among(docs, groups.select("doc_id"), id_col, without=True)
    repeated = groups.where("kept AND copies > 1").select("doc_id")
    if repeated.isEmpty():
        return once
    longest = F.struct(F.length(F.coalesce(F.col(text_col), F.lit(""))), *[F.col(c) for c in docs.columns])
    again = among(docs, repeated, id_col).groupBy(F.col(id_col).alias("__key")).agg(F.max(longest).alias("__row"))
    return once.unionByName(again.select(*[F.col("__row")[c].alias(c) for c in docs.columns]))
