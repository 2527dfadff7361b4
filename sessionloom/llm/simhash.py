"""SimHash near duplicates by meet-in-the-middle ball hashing.

Two fingerprints within a radius have a point halfway between them.  Every
fingerprint emits all points within half the radius, the points are shuffled,
and fingerprints that meet on a point are verified.

For the odd radius 3 of 64-bit fingerprints half the radius is one and a half
bits.  The half bit is a group of 16 bits that both sides leave out: of three
differing bits at least one lies in some group; without that group two remain,
and both sides reach a common point by turning one bit.  So a fingerprint emits
4 x (1 + 48) variants instead of the 2,081 of a ball of radius 2.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.lineage import cut
from .arrow import id_and_text, map_columns, schema_of
from .components import components

SEED = 42
BITS = 64
RADIUS = 3
GROUP = 16
GROUPS = BITS // GROUP
FIELD = [((1 << GROUP) - 1) << (GROUP * g) for g in range(GROUPS)]
# What stands in the left-out bits of a variant tells which group was left out.
TAGS = [0x9E37, 0x79B9, 0x7F4A, 0x7C15]
PAIRWISE = 16  # up to this many fingerprints on a point are compared with each other


def shingles(text: str, words: int) -> list[bytes]:
    """Word shingles in UTF-8, A-Z lowered, repeats included; fewer words give one shingle, none give none."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if len(found) <= words:
        return [b" ".join(found)] if found else []
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [line[a:b] for a, b in zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]


def simhash(items: list[bytes], seed: int = SEED) -> int:
    """Bit i is set if it is set in more than half of the hashes; no items give 0."""
    if not items:
        return 0
    hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in items], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(items)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (64 bits as a long) of every whole text; null text is empty."""

    def run(ids, texts):
        return {"doc_id": ids, "fingerprint": [signed(simhash(shingles(t, words))) for t in texts]}

    return map_columns(id_and_text(docs, id_col, text_col), run, "doc_id long, fingerprint long")


def _variants() -> list[tuple[int, int]]:
    """(keep, set): a variant is (fingerprint & keep) ^ set."""
    out = []
    for g in range(GROUPS):
        keep = signed(~FIELD[g] & (1 << 64) - 1)
        tag = TAGS[g] << (GROUP * g)
        flips = [0] + [1 << i for i in range(BITS) if not FIELD[g] >> i & 1]
        out += [(keep, signed(tag ^ f)) for f in flips]
    return out


def _pairs_of_short_runs(key, fp, run, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius, each only at the one point where it is counted."""
    us, vs = [], []
    for step in range(1, longest):
        same = np.flatnonzero(run[step:] == run[:-step])
        if not len(same):
            break
        a, b = fp[same], fp[same + step]
        diff = a ^ b
        near = np.bitwise_count(diff) <= RADIUS
        a, b, diff, point = a[near], b[near], diff[near], key[same][near]
        low = np.minimum(a, b)
        counted = np.zeros(len(a), bool)
        open_ = np.ones(len(a), bool)
        for g in range(GROUPS):
            field = np.uint64(FIELD[g])
            rest = diff & ~field
            n = np.bitwise_count(rest)
            here = open_ & (n <= 2)
            lowest = np.where(n == 2, rest & (~rest + np.uint64(1)), np.uint64(0))
            middle = ((low & ~field) ^ lowest) | np.uint64(TAGS[g] << (GROUP * g))
            counted |= here & (middle == point)
            open_ &= ~here
        us.append(low[counted])
        vs.append(np.maximum(a, b)[counted])
    return us, vs


FLIPS = [
    np.array([1 << i for i in range(GROUP)], dtype=np.int64),
    np.array([1 << i | 1 << j for i in range(GROUP) for j in range(i)], dtype=np.int64),
    np.array([1 << i | 1 << j | 1 << k for i in range(GROUP) for j in range(i) for k in range(j)], dtype=np.int64),
]


def _links_of_long_run(point: int, fp: np.ndarray) -> tuple[list, list]:
    """Links that join all that is within the radius, without trying all pairs.

    All fingerprints on a point are within one bit of it outside the left-out
    group.  Those with the same value in the group are within two bits of each
    other: one represents them.  Groups that differ in one bit are within three.
    Groups that differ in two or three bits need one or two members that equal
    the point outside the group.  So looking up 696 values per group finds all.
    """
    us, vs = [], []
    for g in range(GROUPS):
        shift, field = np.uint64(GROUP * g), np.uint64(FIELD[g])
        if point >> (GROUP * g) & 0xFFFF != TAGS[g]:
            continue
        off = np.bitwise_count((fp ^ np.uint64(point)) & ~field)
        mine, off = fp[off <= 1], off[off <= 1]
        group = ((mine & field) >> shift).astype(np.int64)
        order = np.lexsort((off, group))
        mine, off, group = mine[order], off[order], group[order]
        values, first = np.unique(group, return_index=True)
        us.append(mine[first[np.searchsorted(values, group)]])
        vs.append(mine)
        some = np.full(1 << GROUP, -1, dtype=np.int64)  # a member of each group value, an exact one if there is one
        some[values] = first
        exact = np.full(1 << GROUP, -1, dtype=np.int64)
        exact[values[off[first] == 0]] = first[off[first] == 0]
        for source, target, flips in ((some, some, FLIPS[0]), (exact, some, FLIPS[1]), (exact, exact, FLIPS[2])):
            at = np.flatnonzero(source >= 0)
            for f in flips:
                hit = at[target[at ^ f] >= 0]
                us.append(mine[source[hit]])
                vs.append(mine[target[hit ^ f]])
    return us, vs


def links_of(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links between fingerprints that meet; rows are sorted by key and runs are whole."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(key)])))
    size = np.repeat(sizes, sizes)
    run = np.repeat(np.arange(len(starts)), sizes)
    short = (size > 1) & (size <= PAIRWISE)
    us, vs = _pairs_of_short_runs(key[short], fp[short], run[short], PAIRWISE)
    for s, n in zip(starts[sizes > PAIRWISE], sizes[sizes > PAIRWISE], strict=True):
        a, b = _links_of_long_run(int(key[s]), fp[s : s + n])
        us, vs = us + a, vs + b
    if not us:
        return fp[:0], fp[:0]
    u, v = np.concatenate(us), np.concatenate(vs)
    u, v = np.minimum(u, v), np.maximum(u, v)
    ok = (u != v) & (np.bitwise_count(u ^ v) <= RADIUS)
    pairs = np.unique(np.stack((u[ok], v[ok]), axis=1), axis=0) if ok.any() else np.zeros((0, 2), np.uint64)
    return pairs[:, 0], pairs[:, 1]


def whole_runs(batches, rows: int):
    """Column arrays of about ``rows`` rows from sorted batches, cut only where the first column changes."""
    held: list[tuple] = []
    count = 0

    def joined():
        return tuple(np.concatenate(c) for c in zip(*held, strict=True))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns))
        count += batch.num_rows
        if count < rows:
            continue
        columns = joined()
        changes = np.flatnonzero(columns[0][1:] != columns[0][:-1])
        if len(changes):
            at = int(changes[-1]) + 1
            yield tuple(c[:at] for c in columns)
            held, count = [tuple(c[at:] for c in columns)], len(columns[0]) - at
        else:
            held = [columns]
    if held:
        yield joined()


def fingerprint_links(prints: DataFrame, rows: int = 200_000) -> DataFrame:
    """Links u, v that connect all distinct ``fingerprint`` values within the radius."""
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("s")) for k, s in _variants()])
    points = (
        prints.select(F.col("fingerprint").alias("fp"), F.explode(table).alias("x"))
        .select(F.col("fp").bitwiseAND(F.col("x.k")).bitwiseXOR(F.col("x.s")).alias("point"), "fp")
        .repartition("point")
        .sortWithinPartitions("point")
    )
    schema = schema_of("u long, v long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        for point, fp in whole_runs(batches, rows):
            u, v = links_of(point, fp)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], schema=arrow)

    return points.mapInArrow(run, schema)


def near_groups(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id (smallest id reachable by links) of every document.

    Equal fingerprints are one node, so copies cost one row each and no pairs.
    Texts without words have fingerprint 0 and are linked like any other.  Null
    text is empty; rows that repeat an id give the same row again; a group of
    null ids only has a null component.
    """
    prints = cut(fingerprints(docs, words, id_col, text_col))
    nodes = cut(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    roots = components(fingerprint_links(nodes.select("fingerprint")))
    known = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    known = known.withColumn("root", F.coalesce("root", "fingerprint"))
    ids = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = known.join(ids, "root").select("fingerprint", "component_id")
    return prints.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")
