"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut


def _large_star(e: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on its smallest neighbour (or itself)."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # the rows with v > u are the reversed links, so only those meet the minimum
    up = e.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return up.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(e: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours hang on the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node with a link.

    ``links`` has columns u and v in any order; loops and repeats do no harm,
    rows with a null are left out.  Each round halves the distance to the root,
    is written once, and is compared with the round before by count and
    checksum; nothing is collected but those two numbers.  A node with very
    many links is a large group only in a minimum (pre-aggregated) and in a
    join that adaptive execution can split.
    """
    e = cut(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
        e = cut(_small_star(_large_star(e).distinct()).distinct())
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
