"""Packing token pieces into fixed sequences: cutting stock by column generation.

Documents are tokenized, cut into pieces of at most one sequence, and counted
by length class.  A linear program over packing patterns of classes is solved
by column generation: a small simplex gives prices of the classes, a knapsack
dynamic program finds the pattern that pays most, until none pays.  Patterns
are rounded down, what is left over is placed first-fit, and the ranked pieces
of each class are dealt to the places of the patterns.  The program sees the
length histogram only, whose size is fixed by the sequence length.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut
from .arrow import id_and_text, map_columns

CAPACITY = 2048
GRID = 8
END_ID = 1
CHUNKS = 300_000  # words that are remembered
LONG = 64  # characters of a word that is not


class Encoder:
    """Ids of the byte-level vocabulary, as the ``tokenizers`` library gives them.

    The same vocabulary exists as ranks for a faster library with equal results
    (tested).  A single blank between two other characters always begins a token
    of the pattern, so a text whose blanks are all of this kind is cut at them
    and the ids of a word are remembered.  The new words of a text are encoded
    in one call; each begins with the one token that begins with a blank.  Any
    other text is encoded whole, and one with the string of a special token goes
    through ``tokenizers`` itself.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str, special: str = "<|endoftext|>") -> None:
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.encode = lambda text: encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        self.blank = np.zeros(max(table.values()) + 1, bool)  # tokens that begin with a blank
        self.blank[[i for token, i in table.items() if token.startswith(b" ")]] = True
        self.vocabulary, self.special, self.whole = vocabulary, special, None
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        if self.special in text:
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.vocabulary)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        words = text.split(" ")
        if len(words) < 3:
            return self.encode(text)
        first, last, words = words[0], words[-1], words[1:-1]
        known = self.known
        if len(known) > CHUNKS:
            known.clear()
        new = list(set(words).difference(known))
        if not first or first[-1].isspace() or not last or last[0].isspace() or any(not w or w != w.strip() for w in new):
            return self.encode(text)
        if new:
            ids = self.encode(" " + " ".join(new))
            data, starts = ids.tobytes(), (4 * np.flatnonzero(self.blank[ids])).tolist()
            known.update(zip(new, [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)], strict=True))
        out = b"".join([self.encode(first).tobytes(), *map(known.__getitem__, words), self.encode(" " + last).tobytes()])
        for w in new:
            if len(w) >= LONG:
                del known[w]
        return np.frombuffer(out, dtype="<u4")


_ENCODER: dict[tuple, Encoder] = {}  # one per worker process


def encoder(files: tuple[str, str, str]) -> Encoder:
    if files not in _ENCODER:
        _ENCODER[files] = Encoder(*files)
    return _ENCODER[files]


def public_files() -> tuple[str, str, str]:
    """Vocabulary, the same as ranks, and the pattern; installed on every executor."""
    import public_tokenizers as public

    return public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN


def pieces(docs: DataFrame, files=None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece.

    A document is its ids and one end id, cut into runs of ``capacity`` and a rest.
    """

    def run(ids, texts):
        enc = encoder(tuple(files or public_files()))
        rows: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
        for doc_id, text in zip(ids, texts, strict=True):
            data = enc.ids(text).tobytes() + END_ID.to_bytes(4, "little")
            n = len(data) // 4
            for start in range(0, n, capacity):
                part = data[4 * start : 4 * (start + capacity)]
                for name, value in zip(rows, (doc_id, start, len(part) // 4, zlib.crc32(part), n), strict=True):
                    rows[name].append(value)
        return rows

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return map_columns(id_and_text(docs, id_col, text_col), run, ddl)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of classes with the highest total price.  Sizes fall."""
    value = np.zeros(room + 1)
    last = np.full(room + 1, -1)
    fit = len(sizes) - np.searchsorted(sizes[::-1], np.arange(room + 1), side="right")
    for space in range(int(sizes[-1]), room + 1):
        j = fit[space]
        gain = prices[j:] + value[space - sizes[j:]]
        k = int(gain.argmax())
        if gain[k] > value[space - 1] + 1e-12:
            value[space], last[space] = gain[k], k + j
        else:
            value[space] = value[space - 1]
    counts, space = np.zeros(len(sizes), dtype=np.int64), room
    while space > 0:
        if last[space] < 0:
            space -= 1
        else:
            counts[last[space]] += 1
            space -= int(sizes[last[space]])
    return float(value[room]), counts


def first_fit(sizes: np.ndarray, left: np.ndarray, room: int, whole: bool) -> list[tuple[int, np.ndarray]]:
    """Patterns, largest pieces first; every step uses up a class.

    ``whole`` gives (integer uses, pattern), else (the class used up, pattern).
    """
    left, out = left.copy(), []
    still = left > 0
    while still.any():
        space, counts = room, np.zeros(len(sizes), dtype=np.int64)
        for k in np.flatnonzero(still):
            n = space // int(sizes[k])
            if whole:
                n = min(n, int(left[k]))
            counts[k] = n
            space -= n * int(sizes[k])
        ratio = np.where(counts > 0, left / np.maximum(counts, 1), np.inf)
        times = int(ratio.min()) if whole else ratio.min()
        left = np.maximum(left - counts * times, 0)
        if whole:
            out.append((times, counts))
            still = left > 0
        else:
            k = int(ratio.argmin())  # one class at a time, also where several are used up
            out.append((k, counts))
            still[k] = False
    return out


def column_generation(
    sizes: np.ndarray, demand: np.ndarray, room: int, steps: int = 2000, gap: float = 5e-4
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and their fractional uses for the cutting-stock program.

    Revised simplex.  It starts from the patterns of a fractional first fit,
    each of which uses up one class, so they form a triangular basis.  It ends
    when no pattern is worth more than 1 + ``gap``: the optimum is then at most
    that factor away.  ``steps`` bounds the work; any basis is feasible, and
    rounding completes it.
    """
    n = len(sizes)
    most = room // sizes
    basis, inverse, uses = np.diag(most), np.diag(1.0 / most), demand / most

    def enter(pattern: np.ndarray, out: int | None = None) -> None:
        # Row operations only: the matrices are small, and threads of a matrix library do not pay here.
        nonlocal inverse, uses
        way = (inverse * pattern).sum(axis=1)
        if out is None:
            up = way > 1e-10
            ratio = np.where(up, uses / np.where(up, way, 1.0), np.inf)
            out = int(ratio.argmin())
        step = uses[out] / way[out]
        uses = np.maximum(uses - step * way, 0)
        uses[out] = step
        basis[:, out] = pattern
        row = inverse[out] / way[out]
        inverse = inverse - way[:, None] * row[None, :]
        inverse[out] = row

    def restart() -> None:
        nonlocal inverse, uses
        columns = basis.T.copy()
        inverse, uses = np.diag(1.0 / most), demand / most
        free = np.ones(n, bool)
        for pattern in columns:  # against rounding errors: pivot each pattern into the free row where it counts most
            way = np.abs((inverse * pattern).sum(axis=1)) * free
            free[out := int(way.argmax())] = False
            enter_at = (inverse * pattern).sum(axis=1)
            row = inverse[out] / enter_at[out]
            inverse = inverse - enter_at[:, None] * row[None, :]
            inverse[out] = row
            basis[:, out] = pattern
        uses = np.maximum((inverse * demand).sum(axis=1), 0)

    for k, pattern in first_fit(sizes, demand.astype(float), room, whole=False):
        enter(pattern, k)
    restart()
    for step in range(steps):
        prices = inverse.sum(axis=0)
        worth, pattern = best_pattern(np.maximum(prices, 0), sizes, room)
        if worth <= 1 + gap:
            break
        enter(pattern)
        if step % 200 == 199:
            restart()
    return basis.T.astype(np.int64), uses


def plan_patterns(histogram: dict[int, int], room: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {class: places}) so that every class has as many places as pieces."""
    classes = sorted((c for c, n in histogram.items() if n), reverse=True)
    if not classes:
        return []
    sizes = np.array(classes)
    left = np.array([histogram[c] for c in classes], dtype=np.int64)
    plan: list[tuple[int, np.ndarray]] = []
    for pattern, x in zip(*column_generation(sizes, left.astype(float), room), strict=True):
        times = int(x + 1e-9)
        if times and (pattern * times <= left).all():
            plan.append((times, pattern))
            left -= pattern * times
    plan += first_fit(sizes, left, room, whole=True)  # what rounding left over
    return [(t, {int(sizes[k]): int(c[k]) for k in np.flatnonzero(c)}) for t, c in plan]


def places(plan: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per class: first rank, first sequence and places a sequence of every pattern with that class."""
    out: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, pattern in plan:
        for c, n in pattern.items():
            out.setdefault(c, []).append((ranks.get(c, 0), sequence, n))
            ranks[c] = ranks.get(c, 0) + n * times
        sequence += times
    return {c: tuple(np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) for c, rows in out.items()}


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, grid: int = GRID, buckets: int = 64) -> DataFrame:
    """Add sequence_id and offset to pieces; a sequence holds at most ``capacity`` tokens.

    Lengths are rounded up to the grid for the program only; in a sequence the
    pieces follow each other without gaps.  A piece's rank in its class is its
    place within its bucket of documents plus the sizes of the buckets before,
    so no class is sorted in one task, and a repeated task gives the same ranks.
    Repeated rows of an id are pieces of their own.  An empty table gives none.
    """
    p = cut(
        cut_pieces.withColumn("class", F.ceil(F.col("length") / grid).cast("int")).withColumn(
            "bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int")
        )
    )
    sizes = p.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut(sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    # one number for each class: capacity / grid at most
    histogram = {r["class"]: r["n"] for r in sizes.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    where = places(plan_patterns(histogram, capacity // grid))

    inside = Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        p.withColumn("place", F.row_number().over(inside))
        .join(sizes.select("class", "bucket", "before"), ["class", "bucket"])
        .withColumn("rank", F.col("before") + F.col("place") - 1)
    )
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(*columns):
        rows = dict(zip([*names, "class", "rank"], columns, strict=True))
        cls, rank = np.array(rows["class"]), np.array(rows["rank"])
        sequence = np.zeros(len(cls), dtype=np.int64)
        slot = np.zeros(len(cls), dtype=np.int64)
        for c in np.unique(cls):
            first, start, each = where[int(c)]
            mine = np.flatnonzero(cls == c)
            k = np.searchsorted(first, rank[mine], side="right") - 1
            sequence[mine] = start[k] + (rank[mine] - first[k]) // each[k]
            slot[mine] = (rank[mine] - first[k]) % each[k]
        return {n: rows[n] for n in [*names, "class"]} | {"sequence_id": sequence, "slot": slot}

    ddl = ", ".join(f"{n} long" for n in names) + ", class int, sequence_id long, slot long"
    dealt = map_columns(ranked.select(*names, "class", "rank"), run, ddl)
    order = Window.partitionBy("sequence_id").orderBy(F.col("class").desc(), "slot")
    offset = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.withColumn("offset", offset).select(*names, "sequence_id", "offset")
