"""Language identification by a small byte convolutional network.

Filters of several widths slide over the bytes of fixed-length windows; each
filter's highest response in a window is kept, and a softmax over these gives
the languages.  The network is trained in numpy on a bounded sample of labelled
text, inside one task.  For prediction the byte embedding and the filters are
multiplied out into tables over bytes and byte pairs, so that a window costs
table look-ups only.

To reject what is no language, the network can be trained with one more class,
``und``, of junk: shuffled bytes, symbols, keys, and letters of scripts that the
sample does not hold.  A text is rejected where the class gets at least a bound
calibrated on the labelled rows (see ``bound_of``).
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .arrow import schema_of

UNKNOWN = "und"
_MARK = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is a letter; digits of other kinds (½, ², ①) are none."""
    return any(m[0].isalpha() for m in _MARK.finditer(text))

WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
WINDOW = 256
STEP = WINDOW - max(WIDTHS) + 1  # every run of bytes a filter sees lies in some window
SAMPLE = 6000
SAMPLE_CHARS = 600
ROUNDS = 700
BATCH = 64
JUNK = 0.25  # junk texts for each labelled one, where the network has a class for them
LEAST_BOUND = 0.8  # a junk class below this never rejects
SCRIPTS = (0x370, 0x410, 0x531, 0x5D0, 0x620, 0x905, 0xE01, 0x10D0, 0x30A1, 0x4E00, 0xAC00)


def fit(texts: list[str], labels: list[str], rounds: int = ROUNDS, seed: int = 7) -> dict:
    """Train on windows cut at random places; returns plain arrays."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    target = np.array([names.index(x) for x in labels])
    raw = [np.frombuffer(t.encode("utf-8", "surrogatepass").lower(), np.uint8) for t in texts]
    e = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
    filters = {w: rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)).astype(np.float32) for w in WIDTHS}
    out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    params = [e, out, bias, *filters.values()]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, rounds + 1):
        picked = rng.integers(0, len(raw), BATCH)
        x = np.zeros((BATCH, WINDOW), np.uint8)
        for i, k in enumerate(picked):
            # short windows too, as texts and last windows may be short
            size = WINDOW if rng.random() < 0.6 else int(rng.integers(12, WINDOW))
            at = int(rng.integers(0, max(1, len(raw[k]) - size + 1)))
            part = raw[k][at : at + size]
            x[i, : len(part)] = part
        emb = e[x]
        cols, tops, hs = [], [], []
        for w in WIDTHS:
            c = np.concatenate([emb[:, j : WINDOW - w + 1 + j] for j in range(w)], axis=2)
            z = c.reshape(-1, w * EMBED) @ filters[w]
            z = z.reshape(BATCH, -1, FILTERS)
            top = z.argmax(axis=1)
            cols.append(c)
            tops.append(top)
            hs.append(np.take_along_axis(z, top[:, None, :], axis=1)[:, 0])
        h = np.tanh(np.concatenate(hs, axis=1))
        score = h @ out + bias
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = p
        g[np.arange(BATCH), target[picked]] -= 1
        g /= BATCH
        grads = [np.zeros_like(e), h.T @ g, g.sum(axis=0)]
        gh = (g @ out.T) * (1 - h * h)
        for k, w in enumerate(WIDTHS):
            gk = gh[:, k * FILTERS : (k + 1) * FILTERS]
            seen = cols[k][np.arange(BATCH)[:, None], tops[k]]  # batch, filter, w * embed
            grads.append(np.einsum("bfd,bf->df", seen, gk))
            back = gk[:, :, None, None] * filters[w].T.reshape(1, FILTERS, w, EMBED)
            at = tops[k][:, :, None] + np.arange(w)
            np.add.at(grads[0], x[np.arange(BATCH)[:, None, None], at], back)
        rate = 0.01 * (1 - 0.9 * t / rounds)
        for q, gq, mq, vq in zip(params, grads, m, v, strict=True):
            mq += 0.1 * (gq - mq)
            vq += 0.01 * (gq * gq - vq)
            q -= rate * (mq / (1 - 0.9**t)) / (np.sqrt(vq / (1 - 0.99**t)) + 1e-8)
    return {"names": names, "embed": e, "out": out, "bias": bias, "filters": filters}


def junk_of(texts: list[str], n: int, seed: int = 5) -> list[str]:
    """Texts in no language with the lengths of given ones, and letters in them.

    Shuffled characters of texts that are nearly all ASCII (of others, shuffled
    characters can be the same script's words), bytes as characters, symbols
    with a few letters, random keys, and letters of scripts not in the texts.
    """
    rng = random.Random(seed)
    used = {ord(c) >> 8 for t in texts for c in t if c > "\u02ff"}
    foreign = [s for s in SCRIPTS if s >> 8 not in used]
    ascii_texts = [t for t in texts if sum(c < "\x80" for c in t) >= 0.9 * len(t)]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    symbols = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~ 0123456789"
    out = []
    for i in range(n):
        size = max(40, len(rng.choice(texts)))
        kind = i % 5
        if kind == 0 and ascii_texts:
            chars = list(rng.choice(ascii_texts).ljust(40, "x"))
            rng.shuffle(chars)
            out.append("".join(chars))
        elif kind == 4 and foreign:
            start = rng.choice(foreign)
            line = [" " if rng.random() < 0.17 else chr(start + rng.randrange(26)) for _ in range(size)]
            out.append("".join(line))
        elif kind == 1:
            out.append("".join(chr(rng.randrange(256)) for _ in range(size)))
        elif kind == 2:
            out.append("".join(rng.choice(letters if rng.random() < 0.06 else symbols) for _ in range(size)))
        else:
            out.append("".join(rng.choice(letters + "0123456789+/") for _ in range(size)))
    return out


def bound_of(model: dict, texts: list[str], seed: int = 9) -> float:
    """What the junk class must reach for a rejection: above all that labelled texts reach, whole or cut short.

    Halfway from the highest share of a labelled text to 1, LEAST_BOUND at
    least: no text of the sample is rejected, however short its cut.
    """
    rng = random.Random(seed)
    at = model["names"].index(UNKNOWN)
    cuts = [t[k : k + rng.randint(2, 80)] for t in texts for k in (0, rng.randrange(max(1, len(t) - 40)))]
    given = [t for t in texts + cuts if has_letter(t)]
    top = Predictor(model).texts(given)[:, at].max()
    return max(LEAST_BOUND, (1 + float(top)) / 2)


class Predictor:
    """The network as tables: pairs of bytes for the widths 2, 3 and 4."""

    def __init__(self, model: dict) -> None:
        self.names, self.out, self.bias = model["names"], model["out"], model["bias"]
        self.bound = model.get("bound")  # of the junk class, if the network has one
        one = {w: [model["embed"] @ f[j * EMBED : (j + 1) * EMBED] for j in range(w)] for w, f in model["filters"].items()}

        def pair(a, b):
            return (a[:, None, :] + b[None, :, :]).reshape(1 << 16, FILTERS)

        self.two = pair(one[2][0], one[2][1])
        self.three, self.three_end = pair(one[3][0], one[3][1]), one[3][2]
        self.four, self.four_end = pair(one[4][0], one[4][1]), pair(one[4][2], one[4][3])

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each language for rows of WINDOW bytes."""
        p = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        h = [
            self.two[p].max(axis=1),
            (self.three[p[:, :-1]] + self.three_end[x[:, 2:]]).max(axis=1),
            (self.four[p[:, :-2]] + self.four_end[p[:, 2:]]).max(axis=1),
        ]
        h = np.tanh(np.concatenate(h, axis=1))
        score = (h[:, :, None] * self.out[None]).sum(axis=1) + self.bias
        q = np.exp(score - score.max(axis=1, keepdims=True))
        return q / q.sum(axis=1, keepdims=True)

    def texts(self, texts: list[str], at_once: int = 128) -> np.ndarray:
        """Mean over all windows of each whole text, by their bytes."""
        raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
        sizes = np.array([len(r) for r in raw])
        counts = np.maximum(1, -(-(sizes - max(WIDTHS) + 1) // STEP))
        room = np.maximum(sizes, counts * STEP + max(WIDTHS) - 1) + WINDOW
        flat = np.frombuffer(b"".join(r.ljust(n, b"\0") for r, n in zip(raw, room.tolist(), strict=True)), np.uint8)
        base = np.concatenate(([0], np.cumsum(room)[:-1]))
        owner = np.repeat(np.arange(len(raw)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = base[owner] + within * STEP
        weight = np.clip(sizes[owner] - within * STEP, 1, WINDOW)
        total = np.zeros((len(raw), len(self.names)))
        for i in range(0, len(owner), at_once):
            x = flat[start[i : i + at_once, None] + np.arange(WINDOW)]
            # bytes behind a window's own text belong to nobody
            x = np.where(np.arange(WINDOW) < weight[i : i + at_once, None], x, 0).astype(np.uint8)
            np.add.at(total, owner[i : i + at_once], self.windows(x) * weight[i : i + at_once, None])
        return total / total.sum(axis=1, keepdims=True)


def predict_batch(predictor: Predictor | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if t is not None and has_letter(t)]
    if predictor is None or not known:
        return names, scores
    p = predictor.texts([texts[i] for i in known])
    if predictor.bound is not None:
        at = predictor.names.index(UNKNOWN)
        junk = p[:, at] >= predictor.bound
        known = [i for i, j in zip(known, junk.tolist(), strict=True) if not j]
        p = p[~junk]
        p[:, at] = 0
    for i, k, s in zip(known, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
        names[i], scores[i] = predictor.names[k], min(1.0, s)
    return names, scores


def train(docs: DataFrame, use: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample: int = SAMPLE, chars: int = SAMPLE_CHARS, rounds: int = ROUNDS, junk: float = 0.0) -> dict | None:
    """Fit on about ``sample`` rows where ``use`` holds and the label is not null; None if there are none.

    The rows are chosen by a hash of the id, each gives one stretch of
    ``chars`` characters from a place the hash chooses.  The sample bounds the
    training in every respect, so it runs in a single task.  ``junk`` above 0
    adds so many texts of no language for each row, as the class ``und``, and
    the bound from which it rejects a text.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    ).where(use & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = rows.select("id").count()
    if not n:
        return None
    h = F.xxhash64("id", F.lit("sample"))
    place = F.pmod(h, F.greatest(F.length("text") - chars, F.lit(1))).cast("int") + 1
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(n)) < sample).select("lang", F.substring("text", place, F.lit(chars)).alias("part"))
    schema = schema_of("model binary")

    def run(batches):
        import pickle

        texts, labels = [], []
        for b in batches:
            labels += b.column(0).to_pylist()
            texts += b.column(1).to_pylist()
        kept = [(t, x) for t, x in zip(texts, labels, strict=True) if has_letter(t)]
        if kept:
            kept.sort()  # the order of arrival must not matter
            texts, labels = [t for t, _ in kept], [x for _, x in kept]
            clean = [t for t, x in kept if x != UNKNOWN]
            more = junk_of(clean, max(50, int(junk * len(clean)))) if junk and clean else []
            model = fit(texts + more, labels + [UNKNOWN] * len(more), rounds)
            if more:
                model["bound"] = bound_of(model, clean)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)])], schema=to_arrow_schema(schema))

    rows = some.repartition(1).mapInArrow(run, schema).collect()
    if not rows:
        return None
    import pickle

    return pickle.loads(bytes(rows[0].model))


def predict(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) of every whole text.

    A text that is null or has no letter gets ``und`` and score 0, as does any
    text without a model and any that a model with a junk class rejects.  Equal
    texts get equal results; every row gives one, also with a null or repeated
    id.  Only the two named columns are read, so others may have any name.  An
    empty table gives none.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        predictor = Predictor(model) if model else None
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            names, scores = predict_batch(predictor, texts)
            yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema=arrow)

    schema = schema_of("doc_id long, lang_pred string, score double")
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(run, schema)


def identified(docs: DataFrame, model: dict | None, least: float = 0.0, text_col: str = "text") -> DataFrame:
    """The rows whose language is known with at least ``least``, with all their columns.

    Null texts and texts without letters go.  Each row is decided by its own
    text, so ids may be null or repeated; other columns may have any name.
    """
    schema = docs.schema
    at = docs.columns.index(text_col)
    text_is = F.col(text_col).cast("string")

    def run(batches):
        predictor = Predictor(model) if model else None
        for b in batches:
            names, scores = predict_batch(predictor, b.column(at).cast(pa.string()).to_pylist())
            keep = [n != UNKNOWN and s >= least for n, s in zip(names, scores, strict=True)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.withColumn(text_col, text_is).mapInArrow(run, schema)
