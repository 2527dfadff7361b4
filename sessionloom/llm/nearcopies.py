"""Near copies of documents: SimHash tables find them, word shingles decide.

One 64-bit fingerprint within three bits only finds texts that are nearly the
same.  To find what shares 0.8 of its five-word shingles, several shorter
fingerprints of the set of words are used, each with the ball of radius 2: all
points within one bit are emitted, shuffled, and texts that meet are verified.

Prints of words lose texts that differ by one passage, which moves many bits at
once.  So prints of the shingles themselves are added: each holds SYMBOLS
smallest hashes, two of which are equal with a chance of the similarity, and its
ball are all points with one of them left out.  Pairs with at most one different
symbol in a print meet, whatever form the edit has: at 0.8 that is 0.655 for one
print and 1 - 0.345 ** 8 = 0.9998 for all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.lineage import cut
from .arrow import MOST_IDS, among, id_and_text, map_columns, schema_of
from .components import components
from .simhash import shingles, whole_runs

TABLES = 5
BITS = 40
SHINGLE_TABLES = 8
SYMBOLS = 6
WORDS = 5
SIMILARITY = 0.8
ROUNDS = 1  # more leaders for documents whose points hold several groups
AT_ONCE = 1024  # documents whose points are compared before the shuffle


def table_prints(text: str) -> list[int]:
    """TABLES fingerprints of BITS bits over the different words (or the empty text as one word)."""
    words = set(text.encode("utf-8", "surrogatepass").lower().split()) or {b""}
    digests = b"".join([xxhash.xxh3_128_digest(w, 1) + xxhash.xxh3_128_digest(w, 2) for w in words])
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 32), axis=1)[:, : TABLES * BITS]
    ones = (bits.sum(axis=0, dtype=np.int64) * 2 > len(words)).reshape(TABLES, BITS)
    return (ones * (1 << np.arange(BITS, dtype=np.int64))).sum(axis=1).tolist()


SKETCH = 64  # smallest hashes that give one bit each
SIGN = 8  # longs of parities of a set of shingles
MISSED = 5e-5  # chance that a pair at the similarity has too few equal bits
_SEEDS = np.random.default_rng(11).integers(0, 1 << 63, (3, SKETCH), dtype=np.uint64)
_TAGS = np.random.default_rng(12).integers(0, 1 << 63, (SHINGLE_TABLES, SYMBOLS), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scattered over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(text: str, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles; a text without words gives one of its own."""
    return np.unique(np.array([xxhash.xxh3_64_intdigest(s) for s in shingles(text, words)] or [0], np.uint64))


def points_of(grams: np.ndarray, at_once: int = 2048) -> tuple[list[int], int]:
    """All points of the balls of SHINGLE_TABLES prints of SYMBOLS smallest hashes of the shingles, and the sketch.

    The sketch has a bit for each of SKETCH smallest hashes.  Two are equal in a
    bit with a chance of (1 + similarity) / 2.
    """
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(grams), at_once):
        hashes = (grams[None, i : i + at_once] ^ _SEEDS[0][:, None]) * (_SEEDS[1] | np.uint64(1))[:, None]
        least = np.minimum(least, hashes.min(axis=1))
    mixed = _mixed(least + _SEEDS[2])
    symbols = mixed[: SHINGLE_TABLES * SYMBOLS].reshape(SHINGLE_TABLES, SYMBOLS)
    points = _mixed(symbols.sum(axis=1, keepdims=True) - symbols + _TAGS)
    sketch = np.packbits((mixed >> np.uint64(63)).astype(np.uint8)).view(np.int64)[0]
    return points.view(np.int64).ravel().tolist(), int(sketch)


def equal_bits(similarity: float) -> int:
    """So many equal bits of two sketches a pair at the similarity has, but for a chance of MISSED."""
    p, total = (1 + similarity) / 2, 0.0
    for k in range(SKETCH + 1):
        total += math.comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
        if total > MISSED:
            return k
    return SKETCH


def parities(hashes: np.ndarray) -> np.ndarray:
    """SIGN longs whose bits tell if an odd number of the hashes falls on each."""
    odd = np.bincount(hashes.astype(np.int64) % (64 * SIGN), minlength=64 * SIGN) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_apart(similarity: float) -> float:
    """So large a share of the sizes of two sets can be in one of them alone, if they have the similarity.

    Each shingle that one of them alone holds turns one parity, so never more
    parities differ than that: a pair with more of them needs no comparison.
    """
    return (1 - similarity) / (1 + similarity)


def _can_be(a: str, b: str, similarity: float) -> Column:
    """Whether rows a and b with ``size`` and ``sign`` can have the similarity; no pair that has it is lost."""
    differ = [F.bit_count(F.col(f"{a}.sign")[i].bitwiseXOR(F.col(f"{b}.sign")[i])) for i in range(SIGN)]
    return sum(differ[1:], differ[0]) <= (F.col(f"{a}.size") + F.col(f"{b}.size")) * F.lit(most_apart(similarity)) + 1e-6


def shingle_set(text: str, words: int) -> list[int]:
    """Sorted 31-bit hashes of the different shingles."""
    return sorted({xxhash.xxh3_64_intdigest(s) >> 33 for s in shingles(text, words)})


def _prints(texts: DataFrame, words: int) -> DataFrame:
    """doc_id, digest, sketch, size and parities of the set of shingles, fingerprints of the words and points of the shingle prints."""

    def run(ids, t):
        grams = [gram_hashes(x, words) for x in t]
        digests, found = [xxhash.xxh3_128_digest(g.tobytes()) for g in grams], [points_of(g) for g in grams]
        short = [np.unique(g >> np.uint64(33)) for g in grams]  # as in ``shingle_set``
        rows = {"doc_id": ids, "digest": digests, "prints": [table_prints(x) for x in t], "others": [p for p, _ in found], "sketch": [x for _, x in found]}
        return rows | {"size": [len(g) for g in short], "sign": [parities(g).tolist() for g in short]}

    return cut(map_columns(texts, run, "doc_id long, digest binary, sketch long, size int, sign array<long>, prints array<long>, others array<long>"))


def _mixed_ids(ids: np.ndarray) -> np.ndarray:
    return _mixed(ids.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _led(point: np.ndarray, doc: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted points, their documents and the place of each row's leader (the least hash of a document)."""
    by = np.lexsort((mixed, point))
    point, doc = point[by], doc[by]
    first = np.flatnonzero(np.concatenate(([True], point[1:] != point[:-1])))
    return point, doc, np.repeat(first, np.diff(np.concatenate((first, [len(point)]))))


# kind 0: document, its leader on some point; 1: the same, but too different to be linked; 2: point, a document;
# 3: leader of some documents of a point, the leader of all of them
_MET = "a long, kind long, b long"


def _rows_of(parts: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    kinds = np.concatenate([np.full(len(p[1]), p[0], np.int64) for p in parts])
    a, b = (np.concatenate([p[i].view(np.int64) for p in parts]) for i in (1, 2))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (a, kinds, b)], schema=schema)


def _star(doc: np.ndarray, leader: np.ndarray) -> np.ndarray:
    """Every other document of a point meets its leader: once, on however many points it leads."""
    met = doc != doc[leader]
    pairs = np.stack((doc[met], doc[leader[met]]), axis=1)
    return np.unique(pairs, axis=0) if len(pairs) else pairs


def _meetings(nodes: DataFrame, similarity: float, rows: int = 200_000) -> DataFrame:
    """Rows of kind 0, 1 and 3 for all points that several documents share.

    Points of AT_ONCE documents are compared where they arise; of each only the
    leader goes on.  So a point that very many documents share is one row for
    every AT_ONCE of them, in the shuffle as in the task it lands in.
    """
    schema = schema_of(_MET)
    arrow = to_arrow_schema(schema)
    flips = np.concatenate(([0], 1 << np.arange(BITS, dtype=np.int64)))
    tags = np.arange(TABLES, dtype=np.int64) << BITS

    def near(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(i, AT_ONCE)
                ids, sketches, sizes = (part.column(c).to_numpy() for c in range(3))
                signs = part.column(3).flatten().to_numpy().reshape(len(ids), SIGN)
                prints = part.column(4).flatten().to_numpy().reshape(len(ids), TABLES)
                balls = (prints + tags)[:, :, None] ^ flips
                points = np.concatenate((balls.reshape(len(ids), -1), part.column(5).flatten().to_numpy().reshape(len(ids), -1)), axis=1)
                each = points.shape[1]
                point, place, leader = _led(points.ravel(), np.repeat(np.arange(len(ids)), each), np.repeat(_mixed_ids(ids), each))
                met = _star(place, leader)
                met = met[ids[met[:, 0]] != ids[met[:, 1]]]
                x, y = met[:, 0], met[:, 1]
                alike = np.bitwise_count((sketches[x] ^ sketches[y]).view(np.uint64)) <= SKETCH - equal_bits(similarity)
                apart = np.bitwise_count((signs[x] ^ signs[y]).view(np.uint64)).sum(axis=1)
                alike &= apart <= (sizes[x] + sizes[y]) * most_apart(similarity) + 1e-6
                once = np.concatenate(([True], point[1:] != point[:-1]))
                yield _rows_of([*[(k, ids[x[alike == (k == 0)]], ids[y[alike == (k == 0)]]) for k in (0, 1)], (2, point[once], ids[place[once]])], arrow)

    def far(batches):
        for a, kind, b in whole_runs(batches, rows):
            a, b = a.view(np.int64), b.view(np.int64)
            known = kind < 2
            found = _star(*_led(a[~known], b[~known], _mixed_ids(b[~known]))[1:])
            if known.any() or len(found):
                yield _rows_of([*[(k, a[kind == k], b[kind == k]) for k in (0, 1)], (3, found[:, 0], found[:, 1])], arrow)

    local = nodes.select("doc_id", "sketch", "size", "sign", "prints", "others").mapInArrow(near, schema)
    return cut(local.repartition("a").sortWithinPartitions("a").mapInArrow(far, schema))


def _ids_of(pairs: DataFrame) -> DataFrame:
    return cut(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct())


def _verified(pairs: DataFrame, texts: DataFrame, signs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Pairs u, v whose shingle sets have at least the Jaccard similarity.

    Sets are made and sent only for pairs whose parities allow it.
    """
    pairs = cut(pairs.where("u <> v").distinct())
    known = cut(among(signs, _ids_of(pairs)).distinct())
    of_u = pairs.join(known.withColumnRenamed("doc_id", "u"), "u").select("u", "v", F.struct("size", "sign").alias("a"))
    both = of_u.join(known.select(F.col("doc_id").alias("v"), F.struct("size", "sign").alias("b")), "v")
    pairs = cut(both.where(_can_be("a", "b", similarity)).select("u", "v").distinct())
    sets = map_columns(
        among(texts, _ids_of(pairs)),
        lambda ids, t: {"doc_id": ids, "grams": [shingle_set(x, words) for x in t]},
        "doc_id long, grams array<int>",
    )
    sets = cut(sets)
    both = (
        pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("grams").alias("gu")), "u")
        .where(F.col("gu").isNotNull())
        .join(sets.select(F.col("doc_id").alias("v"), F.col("grams").alias("gv")), "v")
        .select("u", "v", "gu", "gv")
    )
    schema = schema_of("u long, v long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                if min(len(x), len(y)) < similarity * max(len(x), len(y)):
                    keep.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= similarity * (len(x) + len(y) - common) - 1e-9)
            got = b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(got.columns, schema=arrow)

    return both.mapInArrow(run, schema)


def _pairs_of_open(open_docs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """All pairs u < v of different ``root`` that can have the similarity, with both roots and how far apart they are.

    Of two such sets, in any common order, the first ``size - similarity * size
    + 1`` shingles share one, and from the first they share on enough is left in
    both.  The order is rare first, so what all texts of a crowd hold comes last
    and its pairs are not made.
    """

    def run(ids, t):
        grams = [shingle_set(x, words) for x in t]
        return {"doc_id": ids, "grams": grams, "sign": [parities(np.array(g, np.int64)).tolist() for g in grams]}

    sets = map_columns(among(texts, open_docs.select("doc_id")), run, "doc_id long, grams array<int>, sign array<long>").join(open_docs, "doc_id")
    sets = cut(sets.withColumn("key", F.xxhash64("doc_id", "grams")))
    each = sets.select("doc_id", "key", "root", F.explode("grams").alias("gram"))
    # a shingle that one group alone holds is in the order, but makes no pair
    often = each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), (F.min("root") != F.max("root")).alias("shared"))
    order = each.join(often, "gram").groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(F.struct("n", "gram", "shared"))).alias("order"))
    of_doc = order.join(sets.select("doc_id", "key", "root", "sketch", "sign").distinct(), ["doc_id", "key"])
    first = F.size("order") - F.ceil(F.size("order") * F.lit(similarity) - 1e-9).cast("int") + 1
    heads = of_doc.select("doc_id", "root", "sketch", "sign", F.size("order").alias("size"), F.posexplode(F.slice("order", F.lit(1), first)).alias("at", "x"))
    heads = cut(heads.where("x.shared").select("doc_id", "root", "sketch", "sign", "size", (F.col("size") - F.col("at")).alias("left"), F.col("x.gram").alias("gram")))
    a, b = heads.alias("a"), heads.alias("b")
    enough = (F.col("a.size") + F.col("b.size")) * F.lit(similarity / (1 + similarity)) - 1e-9
    may = (F.col("a.doc_id") < F.col("b.doc_id")) & (F.col("a.root") != F.col("b.root")) & (F.least("a.left", "b.left") >= enough)
    may &= F.bit_count(F.col("a.sketch").bitwiseXOR(F.col("b.sketch"))) <= SKETCH - equal_bits(similarity)
    may &= _can_be("a", "b", similarity)
    apart = sum([F.bit_count(F.col("a.sign")[i].bitwiseXOR(F.col("b.sign")[i])) for i in range(SIGN)], F.lit(0))
    pairs = a.join(b, (F.col("a.gram") == F.col("b.gram")) & may)
    roots = [F.least("a.root", "b.root").alias("ru"), F.greatest("a.root", "b.root").alias("rv")]
    share = apart / (F.col("a.size") + F.col("b.size"))
    return cut(pairs.select(F.col("a.doc_id").alias("u"), F.col("b.doc_id").alias("v"), *roots, share.alias("apart")))


def _sent(small: DataFrame) -> DataFrame:
    """A written table for a join: sent to the executors where its size is bounded."""
    return F.broadcast(small) if small.count() <= MOST_IDS else small


def _open(met: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (doc_id, lead, far, root, lead_root) that belong to points whose documents are in several groups.

    The documents of a point hang on leaders, and those (``far``) on one of
    them.  So there are several groups on it only if a document and its leader
    are in two; such a leader is open, then the leader it hangs on, then the
    leaders that hang on that.  A leader stands for all its points: no row a
    point is needed.
    """
    known = _sent(roots)
    of_doc, of_lead = (known.select(F.col("node").alias(k), F.col("root").alias(r)) for k, r in (("doc_id", "root"), ("lead", "lead_root")))
    now = met.select("doc_id", "lead", "far").join(of_doc, "doc_id", "left").join(of_lead, "lead", "left")
    now = cut(now.select("doc_id", "lead", "far", F.coalesce("root", "doc_id").alias("root"), F.coalesce("lead_root", "lead").alias("lead_root")))
    far = now.where("far").select("doc_id", "lead")
    leads = cut(now.where("root <> lead_root").select("lead").distinct())
    up = far.join(_sent(leads).withColumnRenamed("lead", "doc_id"), "doc_id", "left_semi").select("lead")
    leads = cut(leads.unionByName(up).distinct())
    rows = cut(now.join(_sent(leads), "lead", "left_semi"))
    down = cut(rows.where("far").select(F.col("doc_id").alias("lead")).distinct().join(leads, "lead", "left_anti"))
    return cut(rows.unionByName(now.where("NOT far").join(_sent(down), "lead", "left_semi")))


def _more_leaders(members: DataFrame, nodes: DataFrame, k: int, similarity: float) -> DataFrame:
    """Pairs of each document of an open leader with another document of it, if that is in another group and can be linked."""
    members = cut(members.select("doc_id", "lead", "root").join(nodes.select("doc_id", "size", "sign"), "doc_id"))
    lead = cut(members.groupBy("lead").agg(F.min_by(F.struct("doc_id", "root", "size", "sign"), F.xxhash64("doc_id", F.lit(k))).alias("l")))
    m, one = members.alias("m"), _sent(lead).select("lead", "l.*").alias("l")
    led = m.join(one, (F.col("m.lead") == F.col("l.lead")) & (F.col("m.root") != F.col("l.root")) & _can_be("m", "l", similarity))
    return led.select(F.least("m.doc_id", "l.doc_id").alias("u"), F.greatest("m.doc_id", "l.doc_id").alias("v"))


def _still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose groups ``ru`` and ``rv`` are not one by now."""
    known = _sent(roots)
    now = pairs
    for r in ("ru", "rv"):
        now = now.join(known.select(F.col("node").alias(r), F.col("root").alias(f"{r}_now")), r, "left")
    return now.where(F.coalesce("ru_now", "ru") != F.coalesce("rv_now", "rv")).select("u", "v")


def _links(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("u"), F.col("root").alias("v"))


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node, root (smallest id of the group) for all documents linked to another one.

    Links are pairs that meet on a point and share ``similarity`` of their
    shingles.  Documents with the same shingles are one node.  On every point
    all are first tried against one leader, the same for most points of a group;
    leaders whose documents are then in one group are done.  Where groups stay
    apart ROUNDS more leaders are tried; then all pairs between groups that can
    have the similarity are found by their rarest shingles and their parities,
    and of two groups the nearest pair is tried before the others.  So no link is
    lost and neither a crowd of copies nor a crowd of groups costs all its pairs.
    What a document and its leader share is one row, not one for each point.

    Rows with a null id are never linked; rows that repeat an id are one
    document; null and empty texts have no shingles and link to each other.
    An empty table gives none.  Only the two named columns are read.
    """
    texts = id_and_text(docs, id_col, text_col).where("doc_id IS NOT NULL")
    prints = _prints(texts, words)
    kept = [F.first(c).alias(c) for c in ("sketch", "size", "sign", "prints", "others")]
    nodes = cut(prints.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *kept))
    signs = prints.select("doc_id", "size", "sign")
    same = prints.select("digest", F.col("doc_id").alias("u")).join(nodes.select("digest", F.col("doc_id").alias("v")), "digest").select("u", "v")
    same = cut(same.where("u <> v").distinct())
    met = _meetings(nodes, similarity)
    led = met.where("kind <> 1").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))

    def joined(known: DataFrame, pairs: DataFrame) -> DataFrame:
        return cut(components(known.unionByName(_verified(pairs, texts, signs, words, similarity))))

    roots = joined(same, led)
    members = _open(met.select(F.col("a").alias("doc_id"), F.col("b").alias("lead"), (F.col("kind") == 3).alias("far")).distinct(), roots)
    for k in range(ROUNDS):
        if members.isEmpty():
            return roots
        roots = joined(_links(roots), _more_leaders(members, nodes, k, similarity))
        members = _open(members, roots) if k + 1 < ROUNDS else members
    either = cut(members.select("doc_id").unionByName(members.select(F.col("lead").alias("doc_id"))).distinct())
    named = either.join(_sent(roots.withColumnRenamed("node", "doc_id")), "doc_id", "left").join(nodes.select("doc_id", "sketch"), "doc_id")
    open_docs = cut(named.select("doc_id", F.coalesce("root", "doc_id").alias("root"), "sketch"))
    pairs = _pairs_of_open(open_docs, texts, words, similarity)
    # one link joins two groups: the nearest pair is tried first, the others only if that was none
    nearest = pairs.groupBy("ru", "rv").agg(F.min_by(F.struct("u", "v"), F.struct("apart", "u", "v")).alias("p")).select("p.*")
    roots = joined(_links(roots), nearest)
    rest = cut(_still_apart(pairs, roots).distinct().join(nearest, ["u", "v"], "left_anti"))
    return roots if rest.isEmpty() else joined(_links(roots), rest)


def drop_near(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Nulls, repeated rows and an empty table are treated as in ``near_copies``;
    other columns may have any name.
    """
    groups = near_copies(docs, words, similarity, id_col, text_col)
    return among(docs, cut(groups.where("node <> root").select("node")), id_col, without=True)
