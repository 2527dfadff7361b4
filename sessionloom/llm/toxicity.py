"""Toxicity by cumulative-link ordinal regression on sparse word features.

P(grade <= k) = logistic(threshold_k - w.x): one weight vector for all ordered
thresholds.  The expected severity is the sum over k of P(grade > k).

Labels say only whether a text is toxic.  Grades come from them: 0 is not
toxic; toxic texts are graded 1 to 3 by how many of their words are marked,
split at the terciles of the training sample.  A word is marked if it stands in
toxic training texts far more often than chance allows.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .arrow import id_and_text, map_columns, schema_of

WORD = re.compile(r"[^\W_]+")
SAMPLE = 8000
FEATURES = 500
LEAST_DOCS = 4
LEAST_CHI = 20.0  # a word says something if its chi-square is this
MARKED = 30.0  # chi-square of a marked word
GRADES = 4
BEGINNINGS = (4, 5, 6, 7)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features_of(words: list[str]) -> list[str]:
    """Words, and beginnings of longer words: insults come with many endings."""
    return words + ["^" + w[:n] for n in BEGINNINGS for w in words if len(w) > n]


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: list[str], toxic: list[int], rounds: int = 400, decay: float = 2e-4) -> dict:
    """Choose the words, grade the toxic texts, fit weights and thresholds."""
    words = [words_of(t) for t in texts]
    seen: set[tuple] = set()
    own = []  # near copies would make any of their words look marked: one text of each beginning and end
    for i, w in enumerate(words):
        ends = {("begin", *w[:5]), ("end", *w[-5:])}
        if not ends & seen:
            own.append(i)
        seen |= ends
    counted = [Counter(features_of(words[i])) for i in own]
    label = np.array([toxic[i] for i in own])
    n, n1 = len(label), int(label.sum())
    docs, hits = Counter(), Counter()
    for c, y in zip(counted, label, strict=True):
        docs.update(c.keys())
        if y:
            hits.update(c.keys())
    chi = {}
    for w, df in docs.items():
        if df >= LEAST_DOCS and 0 < n1 < n:
            expected = df * n1 / n
            chi[w] = (hits[w] - expected) ** 2 / (expected * (1 - n1 / n) * (1 - df / (n + 1)))
    chosen = sorted((w for w in chi if chi[w] >= LEAST_CHI), key=lambda w: (-chi[w], w))[:FEATURES]
    marked = {w for w in chosen if chi[w] >= MARKED and hits[w] * n > docs[w] * n1}
    load = np.array([sum(k for w, k in c.items() if w in marked) for c in counted])
    cuts = np.quantile(load[label == 1], [1 / 3, 2 / 3]) if n1 else np.zeros(2)
    grade = np.where(label == 1, 1 + (load[:, None] > cuts).sum(axis=1), 0)

    index = {w: i for i, w in enumerate(chosen)}
    cells = [(r, index[w], np.log1p(k)) for r, c in enumerate(counted) for w, k in c.items() if w in index]
    r, f, x = (np.array(v) for v in zip(*cells, strict=True)) if cells else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    w = np.zeros(len(chosen))
    # thresholds rise: the first, then logarithms of the steps
    share = np.clip([(grade <= k).mean() for k in range(GRADES - 1)], 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    free = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 0.1))))
    params = [w, free]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    rows = np.arange(n)
    for t in range(1, rounds + 1):
        theta = free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))
        z = np.bincount(r, weights=x * w[f], minlength=n)
        below = np.ones((n, GRADES + 1))
        below[:, 0] = 0
        below[:, 1:-1] = logistic(theta[None] - z[:, None])
        p = np.maximum(below[rows, grade + 1] - below[rows, grade], 1e-12)
        slope = below * (1 - below)
        gz = (slope[rows, grade + 1] - slope[rows, grade]) / p / n
        gt = np.zeros((n, GRADES + 1))
        gt[rows, grade + 1] -= slope[rows, grade + 1] / p / n
        gt[rows, grade] += slope[rows, grade] / p / n
        gt = gt[:, 1:-1].sum(axis=0)
        gfree = np.concatenate(([gt.sum()], [gt[k:].sum() * np.exp(free[k]) for k in range(1, GRADES - 1)]))
        grads = [np.bincount(f, weights=x * gz[r], minlength=len(w)) + decay * w, gfree]
        for q, g, mq, vq in zip(params, grads, m, v, strict=True):
            mq += 0.1 * (g - mq)
            vq += 0.01 * (g * g - vq)
            q -= 0.1 * (mq / (1 - 0.9**t)) / (np.sqrt(vq / (1 - 0.99**t)) + 1e-9)
    theta = free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))
    return {"weights": dict(zip(chosen, w.tolist(), strict=True)), "thresholds": theta.tolist()}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """Fit on about ``sample`` labelled documents, chosen by a hash of the id; None if there are none.

    The chosen labels are few by construction and are broadcast; their texts
    are gathered in one task, which the sample bounds.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IN (0, 1)"
    )
    n = known.count()
    if not n:
        return None
    some = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < sample).limit(2 * sample)
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(some), "doc_id").select("text", "toxic")
    schema = schema_of("model binary")

    def run(batches):
        rows = sorted((t, y) for b in batches for t, y in zip(*[c.to_pylist() for c in b.columns], strict=True))
        if rows:
            model = fit([t for t, _ in rows], [y for _, y in rows])
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)])], schema=to_arrow_schema(schema))

    got = texts.repartition(1).mapInArrow(run, schema).collect()
    return pickle.loads(bytes(got[0].model)) if got else None


def predict(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, severity (expected grade, 0 to 3), grade (most likely), p_toxic, toxic of every whole text.

    Null and empty texts have no features and get what the thresholds alone
    say; without a model all are 0.  Every row gives one, ties and repeats too.
    """

    def run(ids, texts):
        if model is None:
            zero = [0.0] * len(ids)
            return {"doc_id": ids, "severity": zero, "grade": [0] * len(ids), "p_toxic": zero, "toxic": [False] * len(ids)}
        weights = model["weights"]
        lengths = sorted({len(w) - 1 for w in weights if w[0] == "^"})
        z = []
        for t in texts:
            words = words_of(t)
            found = [w for w in words if w in weights]
            for n in lengths:
                found += [b for w in words if len(w) > n and (b := "^" + w[:n]) in weights]
            c = Counter(found)
            z.append(sum(weights[w] * np.log1p(k) for w, k in c.items()))
        above = logistic(np.array(z)[:, None] - np.array(model["thresholds"])[None])
        full = np.column_stack((np.ones(len(z)), above, np.zeros(len(z))))
        return {
            "doc_id": ids,
            "severity": above.sum(axis=1),
            "grade": (full[:, :-1] - full[:, 1:]).argmax(axis=1),
            "p_toxic": above[:, 0],
            "toxic": above[:, 0] >= 0.5,
        }

    ddl = "doc_id long, severity double, grade int, p_toxic double, toxic boolean"
    return map_columns(id_and_text(docs, id_col, text_col), run, ddl)
