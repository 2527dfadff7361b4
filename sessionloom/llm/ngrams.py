"""N-gram language model in Elias-Fano tries, counted and queried by shards.

Documents are gathered into blocks.  A block sends its distinct words, then its
distinct n-grams of each order, to shards chosen by a hash of context and
successor, so no context, however frequent, lies in one task.  A shard adds the
training counts, writes its level of the trie to a memory-mapped file, and
answers the n-grams of every block from it.  A context is named by its node in
the level before, so a query of order n is one search among successors of a
node.  Text is tokenized once; only distinct n-grams and answers travel.
"""

from __future__ import annotations

import mmap
import tempfile
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.lineage import cut
from .arrow import schema_of

ORDER = 3
PRIOR = 10.0  # how many counts the lower order is worth
LEAST_CONTEXT = 2  # contexts of two and more words need this many occurrences
BLOCK_BYTES = 6 << 20
END, START = b"\n", -1
LOWEST = -9.0  # log10 of the smallest probability a code can hold
CODES = 255


# --- numbers as bytes -------------------------------------------------------


def packed(a: np.ndarray) -> bytes:
    """Integers as compressed byte planes, the lowest bytes first."""
    a = np.ascontiguousarray(a, dtype="<i8")
    width = 1
    while width < 8 and len(a) and int(a.max()) >> (8 * width):
        width += 1
    planes = a.view(np.uint8).reshape(-1, 8)[:, :width].T.copy()
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(b: bytes) -> np.ndarray:
    width = b[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def deltas(a: np.ndarray) -> bytes:
    return packed(np.diff(a, prepend=0))


# --- order ------------------------------------------------------------------


def order_of(x: np.ndarray) -> np.ndarray:
    """Stable order of non-negative integers: number and place share 63 bits where they fit, which sorts without an index."""
    bits = len(x).bit_length()
    key = x.astype(np.int64)
    if len(x) and int(key.max()) >> (63 - bits):  # a name is a shard and a place in it: leave no room between them
        low = key & 0xFFFFFFFF
        each = int(low.max()) + 1
        if (int(key.max() >> 32) + 1) * each >> (63 - bits):
            return np.argsort(x, kind="stable")
        key = (key >> 32) * each + low
    key = key << bits | np.arange(len(x))
    key.sort()
    return key & ((1 << bits) - 1)


def different(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``np.unique`` of non-negative integers: values, first place of each, and the number of each row's value."""
    order = order_of(x)
    values = x[order]
    heads = np.ones(len(x), bool)
    heads[1:] = values[1:] != values[:-1]
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(heads) - 1
    return values[heads], order[heads], back


# --- Elias-Fano -------------------------------------------------------------


class EliasFano:
    """A non-falling sequence: low bits side by side, high bits in unary.

    ``parts`` are arrays that may lie in a memory-mapped file.
    """

    def __init__(self, parts: dict[str, np.ndarray], low_bits: int, n: int) -> None:
        self.low, self.words, self.zeros, self.ones = (parts[k] for k in ("low", "words", "zeros", "ones"))
        self.low_bits, self.n = low_bits, n

    @staticmethod
    def encode(values: np.ndarray) -> tuple[dict[str, np.ndarray], int, int]:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = next(b for b in (0, 8, 16, 32, 48) if top >> b <= 2 * n + 64 or b == 48)
        kind = {0: np.uint8, 8: np.uint8, 16: np.uint16, 32: np.uint32, 48: np.uint64}[bits]
        low = (values & np.uint64((1 << bits) - 1)).astype(kind) if bits else np.zeros(0, np.uint8)
        high = (values >> np.uint64(bits)).astype(np.int64)
        size = n + (top >> bits) + 2
        unary = np.zeros(-(-size // 64) * 64, np.uint8)
        unary[high + np.arange(n)] = 1
        words = np.packbits(unary, bitorder="little").view("<u8")
        ones = np.cumsum(np.bitwise_count(words).astype(np.int64))
        zeros = np.arange(1, len(words) + 1) * 64 - ones
        return {"low": low, "words": words, "zeros": zeros, "ones": ones}, bits, n

    def _select(self, counts: np.ndarray, k: np.ndarray, bit: int) -> np.ndarray:
        """Place of the k-th (from 0) bit of a kind: its word by search, then halves of the word by their counts."""
        if 4 * len(k) > len(self.words):  # so many that all are decoded at once
            return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little") == bit)[k]
        w = np.searchsorted(counts, k, side="right")
        left = k - np.where(w > 0, counts[np.maximum(w - 1, 0)], 0)
        word = self.words[w]
        if not bit:
            word = ~word
        inside = np.zeros(len(k), np.uint64)
        for half in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(word >> inside & np.uint64((1 << half) - 1)).astype(np.int64)
            up = left >= low
            left -= np.where(up, low, 0)
            inside += np.where(up, np.uint64(half), np.uint64(0))
        return w * 64 + inside.astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places."""
        i = np.asarray(i, dtype=np.int64)
        if not len(i):
            return i
        high = self._select(self.ones, i, 1) - i
        return high << self.low_bits | self.low[i].astype(np.int64) if self.low_bits else high

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value >= x (n if there is none)."""
        x = np.asarray(x, dtype=np.int64)
        if not len(x) or not self.n:
            return np.zeros(len(x), np.int64)
        high = x >> self.low_bits
        last = int(self.zeros[-1]) - 1
        inside = high < last
        h = np.where(inside, high, 0)
        lo = np.where(h > 0, self._select(self.zeros, np.maximum(h - 1, 0), 0) - (h - 1), 0)
        hi = self._select(self.zeros, h, 0) - h
        lo, hi = np.where(inside, lo, self.n), np.where(inside, hi, self.n)
        if self.low_bits:
            want = x & ((1 << self.low_bits) - 1)
            while (open_ := lo < hi).any():
                mid = (lo + hi) // 2
                less = open_ & (self.low[np.minimum(mid, self.n - 1)].astype(np.int64) < want)
                lo, hi = np.where(less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        return lo


def mapped(parts: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays again, out of a memory-mapped file that has no name any more."""
    with tempfile.TemporaryFile() as f:
        at = []
        for p in parts:
            f.write(b"\0" * (-f.tell() % 8))
            at.append(f.tell())
            f.write(p.tobytes())
        f.write(b"\0" * 8)
        f.flush()
        whole = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    return [np.frombuffer(whole, p.dtype, len(p), a) for p, a in zip(parts, at, strict=True)]


class Level:
    """One level of the trie: contexts, monotone pointers, successors, codes, counts.

    Successors are ranks among the words of the level.  The k-th context's
    successors are stored as k * words + rank, which never falls, so that a
    search for them is relative to the context and needs one sequence.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, total: np.ndarray) -> None:
        """Sorted by (context, word), all different; ``total`` is the context's count."""
        words, _, rank = different(word)
        heads = np.ones(len(context), bool)
        heads[1:] = context[1:] != context[:-1]
        first, k = np.flatnonzero(heads), np.cumsum(heads) - 1
        contexts = context[first]
        self.base = max(1, len(words))
        # A node is its place; the running sum of counts gives each count as a difference.
        lists = [contexts - START, np.append(first, len(context)), words, k * self.base + rank, np.cumsum(np.append(0, count))]
        made = [EliasFano.encode(x) for x in lists]
        flat = mapped([p for parts, _, _ in made for p in parts.values()] + [code_of(count / np.maximum(total, 1))])
        groups = [dict(zip(made[0][0], flat[4 * i : 4 * i + 4], strict=True)) for i in range(5)]
        ef = [EliasFano(g, bits, n) for g, (_, bits, n) in zip(groups, made, strict=True)]
        self.contexts, self.pointers, self.words, self.successors, self.sums = ef
        self.codes = flat[-1]

    @staticmethod
    def _among(known: EliasFano, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, is it there) of each value."""
        once, _, back = different(values)
        place = np.minimum(known.successor(once), known.n - 1)
        return place[back], (known.get(place) == once)[back]

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place or -1, count, code) of n-grams."""
        place = np.full(len(context), -1, np.int64)
        count, code = np.zeros(len(context), np.int64), np.zeros(len(context), np.int64)
        if not self.contexts.n or not len(context):
            return place, count, code
        # contexts and words repeat: each is looked up once
        k_in, in_contexts = self._among(self.contexts, context - START)
        r_in, in_words = self._among(self.words, word)
        at = np.flatnonzero(in_contexts & in_words)
        begin, end = self.pointers.get(k_in[at]), self.pointers.get(k_in[at] + 1)
        want = k_in[at] * self.base + r_in[at]
        s = self.successors.successor(want)
        inside = (s >= begin) & (s < end)
        hit = inside & (self.successors.get(np.where(inside, s, 0)) == want)
        at, s = at[hit], s[hit]
        place[at] = s
        count[at] = self.sums.get(s + 1) - self.sums.get(s)
        code[at] = self.codes[s]
        return place, count, code


def code_of(p: np.ndarray) -> np.ndarray:
    """Relative frequencies as one byte each, even steps of their logarithm."""
    return np.clip(np.rint(np.log10(np.maximum(p, 1e-300)) / LOWEST * CODES), 0, CODES).astype(np.uint8)


def frequency(code: np.ndarray) -> np.ndarray:
    return 10.0 ** (code / CODES * LOWEST)


# --- blocks -----------------------------------------------------------------

BLOCKS = "kind int, shard int, block long, a binary, b binary, c binary, d binary"


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def row(arrow, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


def table_of(arrow, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([row(arrow, rows)] if rows else [], schema=arrow)


def _tokenize(docs: DataFrame, shards: int) -> DataFrame:
    """kind 0: a block (ids, held out, tokens per document, local word ids); kind 1: words for a shard."""
    schema = schema_of(BLOCKS)
    arrow = to_arrow_schema(schema)

    def close(block, ids, held, sizes, tokens, vocabulary):
        tokens, sizes = np.array(tokens, np.int64), np.array(sizes, np.int64)
        train = np.repeat(~np.array(held, bool), sizes)
        counts = np.bincount(tokens[train], minlength=len(vocabulary))
        words = list(vocabulary)
        home = np.array([xxhash.xxh3_64_intdigest(w) % shards for w in words])
        order = order_of(home)
        # local ids follow the shards, so that answers put one behind the other are in their order
        new = np.empty(len(words), np.int64)
        new[order] = np.arange(len(words))
        null = np.array([i is None for i in ids], np.int64)
        numbers = np.array([i or 0 for i in ids], np.int64).tobytes()
        yield (0, -1, block, numbers + null.astype(np.uint8).tobytes(), packed(np.array(held, np.int64)), packed(sizes), packed(new[tokens]))
        at = np.searchsorted(home[order], np.arange(shards + 1))
        pack = zstandard.ZstdCompressor(level=1)
        for s in range(shards):
            mine = order[at[s] : at[s + 1]]
            if len(mine):
                text = b"\t".join([words[i] for i in mine])
                yield (1, s, block, pack.compress(text), packed(counts[mine]), None, None)

    def run(batches):
        part, done = TaskContext.get().partitionId(), 0

        def fresh():
            vocabulary = defaultdict()
            vocabulary.default_factory = vocabulary.__len__  # a new word gets the next number
            return [], [], [], [], vocabulary

        ids, held, sizes, tokens, vocabulary = fresh()
        room = 0
        for b in batches:
            for doc_id, text, out in zip(*[c.to_pylist() for c in b.columns], strict=True):
                found = text.lower().split()
                ids.append(doc_id)
                held.append(out)
                sizes.append(len(found) + 1)
                tokens.extend(map(vocabulary.__getitem__, found))
                tokens.append(vocabulary[END])
                room += len(text) + 64
                if room >= BLOCK_BYTES:
                    for r in close((part << 32) + done, ids, held, sizes, tokens, vocabulary):
                        yield row(arrow, [r])
                    ids, held, sizes, tokens, vocabulary = fresh()
                    room, done = 0, done + 1
        if ids:
            for r in close((part << 32) + done, ids, held, sizes, tokens, vocabulary):
                yield row(arrow, [r])

    return docs.mapInArrow(run, schema)


class Walk:
    """The n-grams of a block as far as the answers so far tell."""

    def __init__(self, block: dict, answers: dict[int, list[dict]], known: int, train_tokens: int, train_words: int, shards: int) -> None:
        """``known`` is the highest order that has been answered."""
        n = len(block["a"]) // 9
        numbers, null = np.frombuffer(block["a"][: 8 * n], "<i8"), np.frombuffer(block["a"][8 * n :], np.uint8)
        self.ids = [None if x else i for i, x in zip(numbers.tolist(), null.tolist(), strict=True)]
        self.held, self.sizes = unpacked(block["b"]).astype(bool), unpacked(block["c"])
        self.local = unpacked(block["d"])
        self.owner = np.repeat(np.arange(n), self.sizes)
        self.train = ~self.held[self.owner]
        self.shards = shards
        first = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.place = np.arange(len(self.local)) - first[self.owner]  # in the document

        words = sorted(answers[1], key=lambda r: r["shard"])
        gid = np.concatenate([unpacked(r["a"]) | r["shard"] << 32 for r in words])
        count = np.concatenate([unpacked(r["b"]) for r in words])
        self.word, self.count = gid[self.local], count[self.local]
        self.rank = np.empty(len(gid), np.int64)
        self.rank[order_of(gid)] = np.arange(len(gid))
        self.p = (self.count + 1.0) / (train_tokens + train_words + 1.0)
        self.base = self.p.copy()
        # before the first word stands the start, as often as the end of a document
        end = self.local[self.sizes[0] - 1]
        before = np.concatenate(([0], self.word[:-1]))
        self.node = np.where(self.place == 0, START, before)
        self.total = np.where(self.place == 0, count[end], np.concatenate(([0], self.count[:-1])))
        self.level = 2
        for level in range(2, known + 1):
            self.take(answers.get(level, []))

    def asked(self, counted: bool = True) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """(tokens asked, [context, word, total, training count] per question, question of each, shard of each question).

        Questions are sorted by shard, context and word; their columns are only
        given if ``counted``.  Words and contexts without training counts need none.
        """
        least = 1 if self.level == 2 else LEAST_CONTEXT
        ok = np.flatnonzero((self.total >= least) & (self.count > 0) & (self.place >= self.level - 2))
        c, w = self.node[ok], self.word[ok]
        # one number per n-gram: rank of the context, then rank of the word (ranks follow the global numbers)
        # the contexts of the second order are words, whose ranks are known
        k = np.where(c == START, 0, self.rank[self.local[np.maximum(ok - 1, 0)]] + 1) if self.level == 2 else different(c - START)[2]
        _, first, back = different(k * len(self.rank) + self.rank[self.local[ok]])
        c, w = c[first], w[first]
        shard = (mix(c, w) % np.uint64(self.shards)).astype(np.int32)
        order = order_of(shard)
        moved = np.empty(len(order), np.int64)
        moved[order] = np.arange(len(order))
        questions = []
        if counted:
            n_train = np.bincount(back[self.train[ok]], minlength=len(first))
            questions = [c[order], w[order], self.total[ok][first][order], n_train[order]]
        return ok, questions, moved[back], shard[order]

    def take(self, answers: list[dict]) -> None:
        """Use the answers of the next level."""
        ok, _, back, _ = self.asked(counted=False)
        node, total = np.full(len(self.p), -1, np.int64), np.zeros(len(self.p), np.int64)
        if answers:
            rows = sorted(answers, key=lambda r: r["shard"])
            codes = np.concatenate([unpacked(r["c"]) for r in rows])[back]
            if rows[0]["a"] is not None:
                node[ok] = np.concatenate([unpacked(r["a"]) - 1 | r["shard"] << 32 for r in rows])[back]
                total[ok] = np.concatenate([unpacked(r["b"]) for r in rows])[back]
            f = np.where(codes > 0, frequency(codes - 1), 0.0)
            context = self.total[ok]
            self.p[ok] = (context * f + PRIOR * self.p[ok]) / (context + PRIOR)
        # words that were not asked have no count here; a known context still takes its share
        rest = np.ones(len(self.p), bool)
        rest[ok] = False
        least = 1 if self.level == 2 else LEAST_CONTEXT
        rest &= (self.total >= least) & (self.place >= self.level - 2)
        self.p[rest] *= PRIOR / (self.total[rest] + PRIOR)
        # the n-gram that ends at a token is the context of the next token
        self.node, self.total = np.concatenate(([-1], node[:-1])), np.concatenate(([0], total[:-1]))
        self.total[self.place < self.level - 1] = 0
        self.level += 1


def _by_level(table: pa.Table) -> dict[int, list[dict]]:
    out: dict[int, list[dict]] = {}
    for r in table.to_pylist():
        out.setdefault(r["kind"], []).append(r)
    return out


def _count_words(words: DataFrame) -> DataFrame:
    """Answers of kind 1 (id in the shard, training count) and one row of kind -1 per shard with its sums."""
    schema = schema_of(BLOCKS)
    arrow = to_arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        unpack = zstandard.ZstdDecompressor()
        known: dict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        ids, counts = [], []
        for r in rows:
            ids.append(np.array(list(map(known.__getitem__, unpack.decompress(r["a"]).split(b"\t"))), np.int64))
            counts.append(unpacked(r["b"]))
        total = np.bincount(np.concatenate(ids), weights=np.concatenate(counts)).astype(np.int64)
        order = np.argsort(-total, kind="stable")  # frequent words get short numbers
        new = np.empty(len(order), np.int64)
        new[order] = np.arange(len(order))
        out = [(1, r["shard"], r["block"], packed(new[i]), packed(total[i]), None, None) for r, i in zip(rows, ids, strict=True)]
        sums = np.array([total.sum(), (total > 0).sum()], np.int64).tobytes()
        return table_of(arrow, [*out, (-1, rows[0]["shard"], -1, sums, None, None, None)])

    return words.groupBy("shard").applyInArrow(run, schema)


def _questions(blocks: DataFrame, answers: DataFrame, args: tuple, level: int) -> DataFrame:
    schema = schema_of(BLOCKS)
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for block in left.to_pylist():
            walk = Walk(block, _by_level(right), level - 1, *args)
            _, (context, word, total, n_train), _, shard = walk.asked()
            at = np.searchsorted(shard, np.arange(args[2] + 1))
            for s in np.flatnonzero(np.diff(at)):
                part = slice(at[s], at[s + 1])
                c = context[part] - START
                # the total is a fact of the context: it travels with the first question of each
                heads = np.append(True, c[1:] != c[:-1])
                totals = np.where(heads, total[part], 0)
                out.append((level, int(s), block["block"], deltas(c), packed(word[part]), packed(totals), packed(n_train[part])))
        return table_of(arrow, out)

    left = blocks.groupBy("block")
    return left.cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def _answers(questions: DataFrame, last: bool) -> DataFrame:
    """Build the shard's level from the training counts and look every different question up in it."""
    schema = schema_of(BLOCKS)
    arrow = to_arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["kind", "shard", "block", "a", "b", "c", "d"]).to_pylist(), key=lambda r: r["block"])
        context, word, total, n = [], [], [], []
        for r in rows:
            c, t = np.cumsum(unpacked(r["a"])) + START, unpacked(r["c"])
            heads = np.append(True, c[1:] != c[:-1])
            context.append(c)
            word.append(unpacked(r["b"]))
            total.append(t[np.flatnonzero(heads)][np.cumsum(heads) - 1])
            n.append(unpacked(r["d"]))
        c, w, t, k = (np.concatenate(x) for x in (context, word, total, n))
        words, _, rank = different(w)
        order = order_of(different(c - START)[2] * max(1, len(words)) + rank)
        c, w, t, k = c[order], w[order], t[order], k[order]
        fresh = np.ones(len(c), bool)
        fresh[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
        back = np.empty(len(c), np.int64)
        back[order] = np.cumsum(fresh) - 1
        at = np.flatnonzero(fresh)
        c, w, t, k = c[at], w[at], t[at], np.add.reduceat(k, at) if len(at) else k
        seen = k > 0
        place, count, code = Level(c[seen], w[seen], k[seen], t[seen]).find(c, w)
        # a context of the next order needs its name and count, at the last order the code is enough
        name = np.where(count >= LEAST_CONTEXT, place + 1, 0)
        kept = np.where(name > 0, count, 0)
        code = np.where(count > 0, code + 1, 0)
        out, begin = [], 0
        for r, x in zip(rows, context, strict=True):
            mine = back[begin : begin + len(x)]
            begin += len(x)
            names, counts = (None, None) if last else (packed(name[mine]), packed(kept[mine]))
            out.append((r["kind"], r["shard"], r["block"], names, counts, packed(code[mine]), None))
        return table_of(arrow, out)

    return questions.groupBy("shard").applyInArrow(run, schema)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(blocks: DataFrame, answers: DataFrame, args: tuple, order: int) -> DataFrame:
    schema = schema_of(SCORES)
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        batches = []
        for block in left.to_pylist():
            walk = Walk(block, _by_level(right), order, *args)
            n = len(walk.ids)
            per_doc = lambda x: np.bincount(walk.owner, weights=x, minlength=n)
            columns = [
                pa.array(walk.ids, pa.int64()),
                pa.array(walk.held),
                pa.array(walk.sizes),
                pa.array(per_doc(walk.count > 0).astype(np.int64)),
                pa.array(per_doc(np.log10(walk.base))),
                pa.array(per_doc(np.log10(walk.p))),
            ]
            batches.append(pa.RecordBatch.from_arrays(columns, schema=arrow))
        return pa.Table.from_batches(batches, schema=arrow)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def score(docs: DataFrame, held_out: Column, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probabilities of all whole texts under a model of those not ``held_out``.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.  Tokens
    are words in lower case and one end.  ``base_score`` adds log10((c + 1) /
    (N + V + 1)); ``score`` mixes in the n-grams up to ``order``: with c of the
    n-gram and t of its context, p = (t * code(c / t) + PRIOR * p_lower) / (t +
    PRIOR), where code rounds to one of 256 steps of the logarithm.

    Null text is empty, a null ``held_out`` counts as false; repeated rows give
    a row each and count each.  Without training rows all counts are zero.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    size = rows.agg(F.sum(F.length("text") + F.lit(64))).first()[0] or 0
    shards = max(12, -(-size // (BLOCK_BYTES * 3 // 2)))
    made = cut(_tokenize(rows, shards))
    blocks = made.where("kind = 0")
    words = cut(_count_words(made.where("kind = 1")))
    totals = _sums(words)
    args = (totals[0], totals[1], shards)
    answers = words.where("kind = 1")
    for level in range(2, order + 1):
        answers = answers.unionByName(cut(_answers(_questions(blocks, answers, args, level), level == order)))
    out = _scores(blocks, answers, args, order)
    return out.withColumn("train_tokens", F.lit(totals[0]).cast("long"))


def _sums(words: DataFrame) -> tuple[int, int]:
    """Training tokens and different training words over all shards."""
    schema = schema_of("n long, v long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            pairs = np.array([np.frombuffer(x, "<i8") for x in b.column(0).to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=arrow)

    r = words.where("kind = -1").select("a").mapInArrow(run, schema).agg(F.sum("n"), F.sum("v")).first()
    return int(r[0] or 0), int(r[1] or 0)
