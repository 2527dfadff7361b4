"""Language streams: characters and words to text, tokens, times, corrections.

Characters come as (session_id, idx, ch, ts_ms), words as (session_id, idx,
word, start_ms, end_ms) with a dense 0-based idx.  A session can be long, so
its text is handled in pieces; tokens that cross a piece border are joined.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import lineage
from ..functions.joins import attach
from ..functions.ordered import over_slices
from ..functions.strips import OUT, over_strips, pack, strips, text_of, unpack
from .prep import hash60

S = ["session_id"]
cut = partial(lineage.cut, compact=True)

# The token pattern, as regular expressions of both engines.
TOKEN = r"[\w']+|[^\w' \t\n\r]"
WORD_CLASS = r"[\p{L}\p{N}_']"
WORD_PIECES = r"[\p{L}\p{N}_']+|[^\p{L}\p{N}_']"

PIECE_SLICES = 10_000  # pieces per slice of ordered work


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _plain(df: DataFrame, column: str) -> str:
    """The type strips hold a column's numbers in."""
    return "double" if df.schema[column].dataType.typeName() in ("double", "float", "decimal") else "long"


def _in_order(columns: list[pa.Array], by: int) -> list[pa.Array]:
    """The rows in the order of the first ``by`` columns, null first; they mostly are already."""
    first = np.asarray(columns[0])
    if not columns[0].null_count:
        if (first[1:] > first[:-1]).all():
            return columns
        order = np.argsort(first, kind="stable")
        in_turn = first[order]
        if (in_turn[1:] > in_turn[:-1]).all():  # the first column decides
            return [c.take(pa.array(order)) for c in columns]
    names = [str(k) for k in range(len(columns))]
    table = pa.table(columns, names)
    order = pc.sort_indices(table, [(n, "ascending") for n in names[:by]], null_placement="at_start")
    return [c.combine_chunks() for c in table.take(order).columns]


def _pieces(
    chars: DataFrame, width: float, order: str, fn: Callable[[str, pa.Array], dict], ddl: str
) -> DataFrame:
    """``fn`` gets text and times of each session's piece; tasks pack characters into strips before the shuffle."""
    piece = F.floor(F.col(order) / F.lit(width)).cast("long").alias("piece")
    rows = chars.select(*S, piece, F.col(order).cast(_plain(chars, order)).alias("__at"), F.col("idx").cast(_plain(chars, "idx")), "ch")
    schema = T.StructType([*rows.schema.fields[:2], *schema_of(ddl).fields])

    def run(key: tuple, sides: dict[int, list[pa.Array]]) -> dict:
        times, _, ch = _in_order(sides[0], 3)
        return fn(text_of(ch).decode(), times)

    return over_strips(strips(rows, [*S, "piece"], ["__at", "idx", "ch"]), [*S, "piece"], run, schema)


def text_pieces(chars: DataFrame, width: float, order: str = "ts_ms") -> DataFrame:
    """Ordered text of each session in consecutive pieces of ``width`` milliseconds."""

    def whole(text: str, times: pa.Array) -> dict:
        return {"text": [text], "times": [times.to_numpy(zero_copy_only=False) if not times.null_count else times.to_pylist()], "n_chars": [len(times)]}

    found = _pieces(chars, width, order, whole, f"text string, times array<{_plain(chars, order)}>, n_chars long")
    return found.withColumn("times", F.col("times").cast(T.ArrayType(chars.schema[order].dataType)))


def regex_spans(text: str) -> list[tuple[str, int, int]]:
    return [(m.group(), m.start(), m.end()) for m in re.finditer(TOKEN, text)]


Spans = tuple[pa.Array, np.ndarray, np.ndarray]  # text, start and end of tokens

_KINDS = np.full(0x110000, 255, "u1")  # of characters: 0 blank, 1 sign, 2 part of a word, 255 not met yet


def _kinds(codes: np.ndarray) -> np.ndarray:
    kinds = _KINDS[codes]
    if (kinds == 255).any():
        for code in np.unique(codes[kinds == 255]).tolist():
            found = re.match(TOKEN, chr(code))
            _KINDS[code] = 0 if not found else 2 if re.match(r"[\w']", chr(code)) else 1
        kinds = _KINDS[codes]
    return kinds


def token_spans(text: str) -> Spans:
    """What ``regex_spans`` finds, as columns; a piece's characters are told apart in one step."""
    codes, raw = np.frombuffer(text.encode("utf-32-le"), "u4"), np.frombuffer(text.encode(), "u1")
    kinds = _kinds(codes)
    edge = np.diff((kinds == 2).astype("i1"), prepend=0, append=0)
    lo = np.flatnonzero((kinds == 1) | (edge[:-1] == 1))
    hi = np.flatnonzero((kinds == 1) | (edge[1:] == -1)) + 1
    size = 1 + (codes >= 0x80) + (codes >= 0x800).astype("i8") + (codes >= 0x10000)
    at = np.concatenate([[0], np.cumsum(size)])
    ends = np.concatenate([[0], np.cumsum(at[hi] - at[lo])]).astype("i4")
    token = raw[(raw >= 0x80) | (_KINDS[raw] != 0)]  # only blanks lie outside of tokens, and each is one byte
    return pa.Array.from_buffers(pa.string(), len(lo), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(token.tobytes())]), lo, hi


def _as_columns(found: Spans | list[tuple[str, int, int]]) -> Spans:
    if isinstance(found, tuple):
        return found
    return pa.array([t[0] for t in found], pa.string()), *[np.array([t[k] for t in found], dtype="int64") for k in (1, 2)]


def _flat(found: Spans | list[tuple[str, int, int]], clock: np.ndarray) -> list[pa.Array]:
    """Tokens of a piece as columns that are nearly constant where tokens are the text and keys come evenly.

    Text, gaps to the end of the token before, length less that of the text, and
    the start and end time less those of an even clock; the last three begin
    with the first token's start and the clock.
    """
    text, lo, hi = _as_columns(found)
    first, step = (int(clock[0]), (int(clock[-1]) - int(clock[0])) // max(1, len(clock) - 1)) if len(clock) else (0, 0)
    gap = np.cumsum(lo - np.concatenate([np.zeros(min(1, len(hi)), "int64"), hi[:-1]]))
    over = hi - lo - np.asarray(pc.utf8_length(text)).astype("int64")
    early, late = clock[lo] - (first + step * lo), clock[hi - 1] - (first + step * (hi - 1))
    return [text, *[pa.array(c) for c in (gap, over, early, late, np.array([first, step], dtype="int64"))]]


def _unflat(columns: list[pa.Array]) -> list[pa.Array]:
    """Text, start, end, start time and end time of the tokens of a piece."""
    text, (gap, over, early, late, (first, step)) = columns[0], [np.asarray(c) for c in columns[1:]]
    size = over + np.asarray(pc.utf8_length(text)).astype("int64")
    hi = np.cumsum(np.diff(gap, prepend=0) + size)
    lo = hi - size
    return [text, *[pa.array(c) for c in (lo, hi, early + first + step * lo, late + first + step * (hi - 1))]]


_EDGE = "struct<token: string, lo: bigint, hi: bigint, t0: bigint, t1: bigint>"
_TOKEN = "token string, start long, end long, start_ms long, end_ms long"


def _spans(tokenizer: Callable[[str], Spans | list[tuple[str, int, int]]]) -> Callable[[str, pa.Array], dict]:
    """All tokens of a piece packed, with its first and its last one and whether they touch its ends."""

    def spans(text: str, times: pa.Array) -> dict:
        clock = np.asarray(times.fill_null(0)).astype("int64")
        token, lo, hi = found = _as_columns(tokenizer(text))
        n, edge, word = len(token), [None, None], [False, False]
        for e, k in enumerate((0, n - 1) if n else ()):
            one, a, b = token[k].as_py(), int(lo[k]), int(hi[k])
            word[e] = one[0].isalnum() or one[0] in "_'"
            edge[e] = {"token": one, "lo": a, "hi": b, "t0": int(clock[a]), "t1": int(clock[b - 1])}
        return {
            "n_chars": [len(times)],
            "n": [n],
            "opens": [bool(n and edge[0]["lo"] == 0 and word[0])],
            "closes": [bool(n and edge[1]["hi"] == len(times) and word[1])],
            "first": edge[:1],
            "last": edge[1:],
            "body": [pack(_flat(found, clock))],
        }

    return spans


def _unpacked(rows: DataFrame) -> DataFrame:
    """A row for each packed token that touches no other piece, with its place in the session."""
    schema = T.StructType([rows.schema["session_id"], *schema_of(f"token_idx long, {_TOKEN}").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("session_id", "tok0", "char0", "cont", "goes", "body")]
            held, size = [], 0
            for at, (session, tok0, char0, cont, goes, body) in enumerate(zip(*[c.to_pylist() for c in columns], strict=True)):
                token, lo, hi, t0, t1 = _unflat(unpack(body))
                n = len(token) - cont - int(goes)
                if n > 0:
                    token, lo, hi, t0, t1 = [c.slice(cont, n) for c in (token, lo, hi, t0, t1)]
                    held.append([pa.array([session] * n, arrow[0].type), pa.array(np.arange(tok0, tok0 + n)), token, pc.add(lo, char0), pc.add(hi, char0), t0, t1])
                    size += n
                if size >= OUT or (held and at + 1 == batch.num_rows):
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays(c).cast(f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
                    held, size = [], 0

    return rows.select(*S, "tok0", "char0", "cont", "goes", "body").mapInArrow(run, schema)


def tokenize(chars: DataFrame, width: float, tokenizer: Callable[[str], Spans | list[tuple[str, int, int]]] = token_spans) -> DataFrame:
    """Tokens with their number, character offsets and times.

    ``tokenizer`` maps a piece of text to (token, start, end), as rows or as
    columns; a word token that ends a piece continues with one that starts the
    next piece.
    """
    ddl = f"n_chars long, n long, opens boolean, closes boolean, first {_EDGE}, last {_EDGE}, body binary"
    stored = cut(_pieces(chars, width, "ts_ms", _spans(tokenizer), ddl))
    small = stored.drop("first", "last", "body")
    near = over_slices(small, S, ["piece"], PIECE_SLICES, lags={"p_closes": "closes", "p_piece": "piece"}, leads={"n_opens": "opens", "n_piece": "piece"})
    cont = F.coalesce(F.col("opens") & F.col("p_closes") & (F.col("p_piece") == F.col("piece") - 1), F.lit(False))
    goes = F.coalesce(F.col("closes") & F.col("n_opens") & (F.col("n_piece") == F.col("piece") + 1), F.lit(False))
    linked = near.select(*S, "piece", "n", "n_chars", cont.cast("long").alias("cont"), goes.alias("goes")).withColumn("net", F.col("n") - F.col("cont"))
    # written, so that its size is known where it meets the packed tokens
    placed = cut(
        over_slices(linked, S, ["piece"], PIECE_SLICES, sums={"toks": "net", "cs": "n_chars"}).select(
            *S, "piece", "cont", "goes", (F.col("toks") - F.col("net")).alias("tok0"), (F.col("cs") - F.col("n_chars")).alias("char0")
        )
    )
    # Most sessions are one piece, which stays where it is: only the others are looked up.
    body = stored.where("session_id IS NOT NULL AND piece IS NOT NULL").select(*S, "piece", "body")
    at = body.join(placed.where("tok0 <> 0 OR char0 <> 0 OR cont <> 0 OR goes"), [*S, "piece"], "left")
    whole = _unpacked(at.na.fill(0, ["tok0", "char0", "cont"]).na.fill(False, ["goes"]))

    def located(df: DataFrame, pos: Column) -> DataFrame:
        return df.select(
            *S,
            (F.col("tok0") + pos).alias("token_idx"),
            F.col("t.token").alias("token"),
            (F.col("char0") + F.col("t.lo")).alias("start"),
            (F.col("char0") + F.col("t.hi")).alias("end"),
            F.col("t.t0").alias("start_ms"),
            F.col("t.t1").alias("end_ms"),
        )

    # Tokens that touch no other piece are complete; only the few at a border are put together.
    head, tail = F.col("cont") == 1, F.col("goes") & ~((F.col("cont") == 1) & (F.col("n") == 1))
    first = F.when(head, F.struct(F.lit(0).cast("long").alias("pos"), F.col("first").alias("t")))
    last = F.when(tail, F.struct((F.col("n") - 1).alias("pos"), F.col("last").alias("t")))
    rows = stored.select(*S, "piece", "n", "first", "last").join(placed.where("cont = 1 OR goes"), [*S, "piece"])
    ends = rows.select(*S, "tok0", "char0", "cont", F.explode(F.array_compact(F.array(first, last))).alias("e"))
    ends = located(ends.select(*S, "tok0", "char0", "cont", "e.pos", "e.t"), F.col("pos") - F.col("cont"))
    parts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "token"))), lambda p: p["token"]), "")
    joined = ends.groupBy(*S, "token_idx").agg(
        parts.alias("token"), F.min("start").alias("start"), F.max("end").alias("end"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")
    )
    return whole.unionByName(joined)


def vocabulary(tokens: DataFrame) -> DataFrame:
    """Distinct tokens with their count and a dense id in hash order."""
    counted = cut(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumn("__h", hash60(0, "token")))  # read twice: tokens are counted once
    ranked = over_slices(counted, [], ["__h", "token"], 2.0**60 / 1024, rank="__r")
    return ranked.select("token", "n", (F.col("__r") - 1).alias("token_id"))


def with_ids(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    return attach(tokens, cut(vocab.select("token", "token_id")), ["token"])  # written, so that its size is known


CELL = 16_384  # characters of a session that meet their tokens in one step


def _ranges(values: pa.Array, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    """A list of values for each range of places."""
    n = hi - lo
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(ends[-1]) + np.repeat(lo - ends[:-1], n)
    return pa.ListArray.from_arrays(pa.array(ends.astype("i4")), values.take(pa.array(at)))


def _known(values: pa.Array, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Values without nulls, and where the parts that end at ``ends`` end now."""
    there = np.concatenate([[0], np.cumsum(np.asarray(values.is_valid()))])
    return values.drop_null(), there[ends]


def _meet(tokens: DataFrame, chars: DataFrame, cell: int, lists: bool) -> DataFrame:
    """Tokens with the times, and ``lists``, of the characters from their start to before their end.

    Characters and tokens are packed by cells of character numbers.  A token
    that lies in several cells is put together from its part in each.
    """
    at, clock = _plain(chars, "idx"), _plain(chars, "ts_ms")
    own = ["idx", "ts_ms", *(["keystrokes", "trigger_keystroke"] if lists else [])]
    cast = {"idx": F.col("idx").cast(at), "ts_ms": F.col("ts_ms").cast(clock)}
    numbered = chars.where("session_id IS NOT NULL AND idx IS NOT NULL").select(*S, *own).withColumns(cast)
    packed = strips(numbered.withColumn("cell", F.floor(F.col("idx") / cell).cast("long")), [*S, "cell"], own)
    t = tokens.select(*S, *[F.col(c).cast("long").alias(c) for c in ("token_idx", "start", "end")], "token")
    one, last = F.floor(F.col("start") / cell).cast("long"), F.floor((F.col("end") - 1) / cell).cast("long")
    found = F.coalesce((F.col("session_id").isNotNull()) & (F.col("end") > F.col("start")), F.lit(False))
    more = f", first {at}, start_ms {clock}, last {at}, end_ms {clock}" + (
        f", idx array<{at}>, keystrokes array<string>, triggers array<string>" if lists else ""
    )
    schema = T.StructType([t.schema["session_id"], *schema_of(f"token_idx long, token string, start long, end long{more}").fields])
    kind = {"long": pa.int64(), "double": pa.float64()}

    def run(key: tuple, sides: dict[int, list[pa.Array]], tag: int) -> dict:
        token_idx, start, end, token = sides[tag]
        empty = [pa.array([], kind[at]), pa.array([], kind[clock]), pa.array([], pa.list_(pa.string())), pa.array([], pa.string())]
        columns = _in_order(sides.get(0, empty), 1)
        numbers = np.asarray(columns[0])
        lo, hi = np.searchsorted(numbers, np.asarray(start)), np.searchsorted(numbers, np.asarray(end))
        there = hi > lo
        a, b = pa.array(lo, mask=~there), pa.array(hi - 1, mask=~there)
        out = {"token_idx": token_idx, "token": token, "start": start, "end": end}
        out |= {"first": columns[0].take(a), "start_ms": columns[1].take(a), "last": columns[0].take(b), "end_ms": columns[1].take(b)}
        if lists:
            hi = np.maximum(lo, hi)
            in_rows = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(columns[2]), 0)))])
            out["idx"] = _ranges(columns[0], lo, hi)
            for c, (values, ends) in {"keystrokes": _known(columns[2].flatten(), in_rows), "triggers": _known(columns[3], np.arange(len(numbers) + 1))}.items():
                out[c] = _ranges(values, ends[lo], ends[hi])
        return out

    # a token of one cell is whole there, the others once in each of their cells; all meet by the same shuffle
    rows = t.where(found).withColumns({"cell": F.explode(F.sequence(one, last)), "tag": F.when(one == last, 1).otherwise(2).cast("tinyint")})
    sides = packed.unionByName(strips(rows, [*S, "cell"], ["token_idx", "start", "end", "token"], tag="tag"))
    single, parts = [over_strips(sides, [*S, "cell"], partial(run, tag=tag), schema, need=tag) for tag in (1, 2)]
    joined = [F.min_by("start_ms", "first").alias("start_ms"), F.max_by("end_ms", "last").alias("end_ms")]
    if lists:
        some = F.sort_array(F.collect_list(F.when(F.col("first").isNotNull(), F.struct("first", "idx", "keystrokes", "triggers"))))
        joined += [F.flatten(F.transform(some, lambda p: p[c])).alias(c) for c in ("idx", "keystrokes", "triggers")]  # noqa: B023
    crossing = parts.groupBy(*S, "token_idx", "token", "start", "end").agg(*joined)
    rest = t.where(~found).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in t.columns else F.col(f.name) for f in schema.fields])
    out = single.drop("first", "last").unionByName(crossing).unionByName(rest.drop("first", "last"))
    zero = lambda c: F.coalesce(F.col(c).cast(chars.schema["ts_ms"].dataType), F.lit(0).cast("long")).alias(c)
    return out.withColumns({c: zero(c) for c in ("start_ms", "end_ms")})


def align_chars(tokens: DataFrame, chars: DataFrame, cell: int = CELL) -> DataFrame:
    """Times of tokens from the first and last of their characters; 0 without characters.

    ``tokens`` has session_id, token_idx, token, start, end; a token_idx is one
    token of its session.  ``cell`` characters meet their tokens in one step.
    """
    return _meet(tokens, chars, cell, False).select(
        *S, "token_idx", "token", "start", "end", "start_ms", "end_ms", (F.col("start") == F.col("end")).alias("special")
    )


def align_keys(tokens: DataFrame, chars: DataFrame, cell: int = CELL) -> DataFrame:
    """As ``align_chars`` for typed characters, with character numbers and keystrokes.

    ``chars`` also has keystrokes (array of strings) and trigger_keystroke.
    The lists are as long as the token.
    """
    listed = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>"))
    return _meet(tokens, chars, cell, True).select(
        *S,
        "token_idx",
        "token",
        "start_ms",
        "end_ms",
        listed("idx", "bigint").alias("char_indices"),
        F.to_json(listed("keystrokes", "string")).alias("keystroke_events"),
        F.to_json(listed("triggers", "string")).alias("trigger_keystrokes"),
    )


def word_offsets(words: DataFrame, slice_words: int = 100_000) -> DataFrame:
    """Place of each word in the blank-joined text of its session."""
    sized = words.withColumn("__l", F.length("word").cast("long") + 1)
    summed = over_slices(sized, S, ["idx"], slice_words, sums={"__to": "__l"})
    return (
        summed.withColumn("text_start", F.col("__to") - F.col("__l"))
        .withColumn("text_end", F.col("__to") - 1)
        .drop("__l", "__to")
    )


def word_text(words: DataFrame, words_per_piece: int = 1000) -> DataFrame:
    """The blank-joined text of each session in pieces of words."""
    parts = F.sort_array(F.collect_list(F.struct("idx", "word")))
    return words.groupBy(*S, F.floor(F.col("idx") / words_per_piece).cast("long").alias("piece")).agg(
        F.array_join(F.transform(parts, lambda w: w["word"]), " ").alias("text"), F.count(F.lit(1)).alias("n_words")
    )


def word_tokens(placed: DataFrame, slice_words: int = 100_000) -> DataFrame:
    """Tokens of placed words with offsets in the text; a word holds no blank."""
    pieces = F.regexp_extract_all("word", F.lit(f"({WORD_PIECES})"), F.lit(1))
    rows = placed.withColumn("__p", pieces).withColumn("__n", F.size("__p").cast("long"))
    rows = over_slices(rows, S, ["idx"], slice_words, sums={"__to": "__n"})
    # a word has few pieces, so their offsets are added up within the row
    at = F.transform("__p", lambda p, i: F.struct(p.alias("token"), F.aggregate(F.slice("__p", F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x)).alias("lo")))
    start = F.col("text_start") + F.col("t.lo")
    return (
        rows.select(*S, "text_start", (F.col("__to") - F.col("__n")).alias("__t0"), F.posexplode(at).alias("pos", "t"))
        .select(*S, (F.col("__t0") + F.col("pos")).alias("token_idx"), F.col("t.token").alias("token"), start.alias("start"), (start + F.length("t.token")).alias("end"))
    )


def align_words(tokens: DataFrame, placed: DataFrame, cell: int = 64, strict: bool = False) -> DataFrame:
    """Times of tokens from the first and last word they meet.

    Both bounds are inclusive, so a word that only touches a token counts;
    ``strict`` asks for a real overlap.
    """
    cells = lambda a, b: F.sequence(F.floor(F.col(a) / cell).cast("long"), F.floor(F.col(b) / cell).cast("long"))
    t = tokens.select(*S, "token_idx", "start", "end").where("end > start").withColumn("__cell", F.explode(cells("start", "end")))
    w = placed.select(*S, "idx", "text_start", "text_end", "start_ms", "end_ms").withColumn("__cell", F.explode(cells("text_start", "text_end")))
    meet = (F.col("text_start") <= F.col("end")) & (F.col("text_end") >= F.col("start"))
    if strict:
        meet = (F.col("text_start") < F.col("end")) & (F.col("text_end") > F.col("start"))
    # a pair can share two cells; minima and maxima do not mind
    times = (
        t.join(w, [*S, "__cell"])
        .where(meet)
        .groupBy(*S, "token_idx")
        .agg(F.min_by("start_ms", "idx").alias("start_ms"), F.max_by("end_ms", "idx").alias("end_ms"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return tokens.join(times, [*S, "token_idx"], "left").select(*S, "token_idx", "token", "start", "end", zero("start_ms"), zero("end_ms"))


def correctable(token: Column) -> Column:
    """Words of two or more characters that are not all capitals."""
    capitals = (token == F.upper(token)) & (token != F.lower(token))
    return token.rlike(r"^[\p{L}\p{N}_']+$") & token.rlike(r"\p{L}") & (F.length(token) > 1) & ~capitals


def corrections(tokens: DataFrame, known: DataFrame) -> DataFrame:
    """(token, corrected) for every distinct token with a known word one edit away.

    ``known`` has word and n.  A word that is known stays; otherwise the most
    frequent known word (first in order on ties) that differs by one changed,
    missing or extra character replaces it.  Candidates meet on keys: a word
    with one position masked, or with one character left out.  Each key keeps
    only its best known word, so no list of candidates is built.
    """
    known = cut(known.select("word", "n"))  # each is read several times, and both stem from all tokens
    words = cut(tokens.select("token").distinct().where(correctable(F.col("token"))).withColumn("word", F.lower("token")))
    open_words = words.select("word").distinct().join(known.select("word"), "word", "left_anti")
    rank = F.struct((-F.col("n")).alias("m"), F.col("word").alias("best"))
    places = F.sequence(F.lit(1), F.length("word"))
    masked = F.transform(places, lambda i: F.concat(F.substring("word", F.lit(1), i - 1), F.lit("\x01"), F.substring("word", i + 1, F.length("word"))))
    shorter = F.array_distinct(F.transform(places, lambda i: F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.length("word")))))

    by_mask = known.withColumn("key", F.explode(masked)).groupBy("key").agg(F.min(rank).alias("c"))
    by_short = known.withColumn("key", F.explode(shorter)).groupBy("key").agg(F.min(rank).alias("c"))
    as_is = known.select(F.col("word").alias("key"), rank.alias("c"))
    found = (
        open_words.withColumn("key", F.explode(masked)).join(by_mask, "key")
        .unionByName(open_words.withColumn("key", F.col("word")).join(by_short, "key"))
        .unionByName(open_words.withColumn("key", F.explode(shorter)).join(as_is, "key"))
        .groupBy("word")
        .agg(F.min("c").alias("c"))
    )
    first = F.substring("token", 1, 1)
    best = F.col("c.best")
    cased = F.when(first != F.lower(first), F.concat(F.upper(F.substring(best, 1, 1)), F.substring(best, F.lit(2), F.length(best)))).otherwise(best)
    return words.join(found, "word").select("token", cased.alias("corrected"))


def correct(tokens: DataFrame, known: DataFrame, different: DataFrame | None = None) -> DataFrame:
    """Tokens with their corrected form; ``different`` holds each token once, where the caller has counted them."""
    fixed = cut(corrections(tokens if different is None else different, known))  # written, so that its size is known: where it is small, tokens stay in place
    return attach(tokens, fixed, ["token"], "left").withColumn("corrected", F.coalesce("corrected", "token"))


def align_corrected(corrected: DataFrame, slice_tokens: int = 100_000) -> DataFrame:
    """Times and original tokens of corrected tokens.

    A correction turns one token into one token, so the sequences differ only
    in runs of changed tokens: an unchanged token keeps its times; each token
    of a run gets the times and the token numbers of the whole run.
    """
    there = corrected.where("session_id IS NOT NULL AND token_idx IS NOT NULL")
    # Only changed tokens are numbered: within a run of them the number of the token less its rank among them stays the same.
    ranked = over_slices(there.where("token <> corrected"), S, ["token_idx"], slice_tokens, rank="__r")
    hit = ranked.withColumn("run", F.col("token_idx") - F.col("__r")).drop("__r")
    runs = hit.groupBy(*S, "run").agg(
        F.min("start_ms").alias("__t0"), F.max("end_ms").alias("__t1"), F.min("token_idx").alias("__a"), F.max("token_idx").alias("__b")
    )
    cols = [*S, "token_idx", "token", "corrected"]
    kept = there.where("token = corrected").select(
        *cols, "start_ms", "end_ms", F.col("token_idx").alias("first_original"), F.col("token_idx").alias("last_original"), F.lit(True).alias("unchanged")
    )
    moved = attach(hit, runs, [*S, "run"]).select(
        *cols,
        F.col("__t0").alias("start_ms"),
        F.col("__t1").alias("end_ms"),
        F.col("__a").alias("first_original"),
        F.col("__b").alias("last_original"),
        F.lit(False).alias("unchanged"),
    )
    return kept.unionByName(moved)


def score(aligned: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Share of unchanged among mapped tokens."""
    return aligned.groupBy(*(keys or S)).agg(
        F.count(F.lit(1)).alias("n_mapped"),
        F.count_if("unchanged").alias("n_unchanged"),
        F.avg(F.col("unchanged").cast("double")).alias("score"),
    )


def correction_view(aligned: DataFrame, tokens_per_piece: int = 200) -> DataFrame:
    """Original and corrected text side by side, in pieces of tokens, with the score."""
    piece = F.floor(F.col("token_idx") / tokens_per_piece).cast("long").alias("piece")
    rows = aligned.select(*S, piece, F.col("token_idx").cast("long"), "token", "corrected", F.col("unchanged").cast("long").alias("same"))
    schema = T.StructType([*rows.schema.fields[:2], *schema_of("original string, corrected string, score double").fields])

    def view(key: tuple, sides: dict[int, list[pa.Array]]) -> dict:
        _, token, corrected, same = _in_order(sides[0], 3)
        known = len(same) - same.null_count

        def joined(c: pa.Array) -> pa.Array:
            there = c.drop_null()
            return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(there)], pa.int32()), there), " ")

        return {"original": joined(token), "corrected": joined(corrected), "score": [pc.sum(same).as_py() / known if known else None]}

    return over_strips(strips(rows, [*S, "piece"], ["token_idx", "token", "corrected", "same"]), [*S, "piece"], view, schema)


def summary(units: DataFrame) -> DataFrame:
    """Characters and words per group of each session; any group qualifies.

    ``units`` has session_id, grp (L, W, R or S) and n.
    """
    n = lambda g: F.coalesce(F.sum(F.when(F.col("grp") == g, F.col("n"))), F.lit(0))
    counted = units.groupBy(*S).agg(n("L").alias("l_chars"), n("W").alias("w_chars"), n("R").alias("r_words"), n("S").alias("s_words"))
    out = counted
    for g, c in (("l", "l_chars"), ("w", "w_chars"), ("r", "r_words"), ("s", "s_words")):
        out = out.withColumn(f"has_{g}", F.col(c) > 0)
    return out.withColumn("qualifies", F.col("has_l") | F.col("has_w") | F.col("has_r") | F.col("has_s"))


def element_summary(units: DataFrame) -> DataFrame:
    """Start, end, units, mean unit duration and modes per element."""
    mode = F.coalesce("mode", F.lit("R"))
    return units.groupBy("element_id").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.min("start_ms").alias("start_ms"),
        F.max("end_ms").alias("end_ms"),
        F.avg(F.col("end_ms") - F.col("start_ms")).alias("mean_unit_ms"),
        F.array_join(F.sort_array(F.collect_set(mode)), ",").alias("modes"),
    )


def element_text(units: DataFrame, sep: str = " ", width: float = 86_400_000, units_per_piece: int = 1000) -> DataFrame:
    """Text of each element in pieces of units, all in (start, idx) order.

    The place of a unit is counted in slices of ``width`` of the start time, so
    pieces follow each other in time even where idx does not.
    """
    placed = over_slices(units.select("element_id", "start_ms", "idx", "word"), ["element_id"], ["start_ms", "idx"], width, rank="__n")
    piece = F.floor((F.col("__n") - 1) / units_per_piece).cast("long").alias("piece")
    rows = F.sort_array(F.collect_list(F.struct("start_ms", "idx", "word")))
    return placed.groupBy("element_id", piece).agg(F.array_join(F.transform(rows, lambda u: u["word"]), sep).alias("text"))


def split_modes(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Read-aloud words (LR) and all others; a missing mode counts as R."""
    mode = F.coalesce("mode", F.lit("R"))
    known = words.withColumn("mode", mode)
    return known.where("mode = 'LR'"), known.where("mode <> 'LR'")


def typing_speed(chars: DataFrame) -> DataFrame:
    """Characters per minute between the first and the last one."""
    span = F.col("t1") - F.col("t0")
    return (
        chars.groupBy(*S)
        .agg(F.count(F.lit(1)).alias("n_chars"), F.min("ts_ms").alias("t0"), F.max("ts_ms").alias("t1"))
        .select(*S, "n_chars", F.when(span > 0, F.col("n_chars") / (span / 1000.0) * 60.0).alias("per_minute"))
    )
