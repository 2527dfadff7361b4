"""Recursive filters run forward and back over signals of any length.

A filter is a sum of first-order recursions, one per pole.  The state of each
after a block of samples is a power of the pole times the state before, plus a
number that the block alone decides.  So all blocks first run from rest, one row
per block is scanned for the states it starts from, and the blocks run again
from there; then the same from the other end.  Inside a block the same rule
holds for short stretches, which are added up by small matrices.  Powers of
poles lose no digits, which powers of a filter's state matrix would.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.joins import attach
from ..functions.lineage import cut

K = ["session_id", "channel"]
STRETCH = 64

Filter = tuple[tuple[complex, ...], tuple[complex, ...], float]  # zeros, different poles, gain


def butterworth(lo: float, hi: float, fs: float, order: int = 4) -> Filter:
    """The digital Butterworth band-pass (bilinear, edges warped)."""
    low, high = (4 * np.tan(np.pi * f / fs) for f in (lo, hi))
    angles = np.pi * np.arange(-order + 1, order, 2) / (2 * order)
    half = -np.exp(1j * angles) * (high - low) / 2
    turn = np.sqrt(half * half - low * high)
    poles = np.concatenate((half + turn, half - turn))
    gain = (high - low) ** order * np.real(4.0**order / np.prod(4 - poles))
    return (1.0,) * order + (-1.0,) * order, tuple((4 + poles) / (4 - poles)), float(gain)


def notch_filter(line: float, fs: float, q: float = 30.0) -> Filter:
    """Second-order notch whose half-power width is line / q."""
    w = 2 * np.pi * line / fs
    gain = 1 / (1 + np.tan(w / q / 2))
    return (np.exp(1j * w), np.exp(-1j * w)), tuple(np.roots([1.0, -2 * gain * np.cos(w), 2 * gain - 1])), float(gain)


class Recursion:
    """One state per pole: state' = pole state + x, and y = direct x + sum of weight state'."""

    def __init__(self, zpk: Filter):
        zeros, poles, gain = np.array(zpk[0], complex), np.array(zpk[1], complex), zpk[2]
        direct = gain * np.prod(zeros) / np.prod(poles)
        upper = [k for k, p in enumerate(poles) if p.imag > 1e-14]  # their conjugates give the other half
        real = [k for k, p in enumerate(poles) if abs(p.imag) <= 1e-14]
        weight = np.array([gain * np.prod(1 - zeros / poles[k]) / np.prod(1 - np.delete(poles, k) / poles[k]) for k in upper + real])
        weight[: len(upper)] *= 2
        self.pole, self.direct, self.n = poles[upper + real], float(direct.real), 2 * len(upper + real)
        self.rest = 1 / (1 - self.pole)  # states of an endless input of 1
        power = self.pole[None] ** np.arange(STRETCH + 1)[:, None]
        answer = (power[:STRETCH] * weight).real.sum(axis=1)
        answer[0] += self.direct
        k = np.arange(STRETCH)
        self.inside = np.where(k[:, None] >= k, answer[np.maximum(k[:, None] - k, 0)], 0)  # output from input in a stretch
        self.seen = power[1:] * weight  # output from the state before
        self.gather = power[:STRETCH][::-1].T  # state after from input
        self.full, self.weight = power[STRETCH], weight

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Outputs and the state after the samples ``x`` from a state."""
        whole = len(x) // STRETCH
        rows = x[: whole * STRETCH].reshape(whole, STRETCH)
        gathered = np.einsum("ks,ns->kn", rows, self.gather)
        states = np.empty((whole, len(self.pole)), complex)
        for k in range(whole):
            states[k] = state
            state = self.full * state + gathered[k]
        y = np.einsum("ts,ks->kt", self.inside, rows) + np.einsum("tn,kn->kt", self.seen, states).real
        out = [y.ravel()]
        for v in x[whole * STRETCH :]:
            state = self.pole * state + v
            out.append(np.array([self.direct * v + (self.weight * state).sum().real]))
        return np.concatenate(out), state


def _pass(blocks: DataFrame, filters: dict[str, Filter], back: bool) -> DataFrame:
    """All blocks filtered in one direction; the first starts at rest with its first sample."""
    key = [*K, "band"]
    known = {name: Recursion(c) for name, c in filters.items()}

    @F.arrow_udf("array<double>")
    def after(band: pa.Array, x: pa.Array) -> pa.Array:
        out = []
        for name, v in zip(band.to_pylist(), x, strict=True):
            v = v.values.to_numpy()
            r = known[name]
            out.append(r.run(v[::-1] if back else v, np.zeros(r.n // 2, complex))[1].view(float))
        return pa.array(out, pa.list_(pa.float64()))

    @F.arrow_udf("array<double>")
    def filtered(band: pa.Array, x: pa.Array, state: pa.Array) -> pa.Array:
        out = []
        for name, v, s in zip(band.to_pylist(), x, state, strict=True):
            v = v.values.to_numpy()
            y = known[name].run(v[::-1] if back else v, s.values.to_numpy().view(complex))[0]
            out.append(y[::-1] if back else y)
        return pa.array(out, pa.list_(pa.float64()))

    first = F.element_at("x", -1 if back else 1)
    ends = blocks.select(*key, "block", F.size("x").cast("long").alias("n"), first.alias("first"), after("band", "x").alias("after"))
    schema = blocks.select(*key, "block", F.array().cast("array<double>").alias("state")).schema
    arrow = to_arrow_schema(schema)

    def scan(group: pa.Table) -> pa.Table:
        rows = group.sort_by([("block", "descending" if back else "ascending")]).to_pylist()
        r = known[rows[0]["band"]]
        state, out = r.rest * rows[0]["first"], []
        for row in rows:
            out.append(state.view(float).tolist())
            state = r.pole ** row["n"] * state + np.array(row["after"]).view(complex)
        columns = [[row[k] for row in rows] for k in [*key, "block"]] + [out]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    states = ends.groupBy(*key).applyInArrow(scan, schema)
    return cut(blocks.join(states, [*key, "block"]).select(*key, "block", filtered("band", "x", "state").alias("x")))


def forward_back(samples: DataFrame, filters: dict[str, Filter], block: int = 60_000) -> DataFrame:
    """session_id, channel, band, sample, x: every channel run forward and back through every filter.

    Channels have samples numbered from 0 without holes.  They are continued at
    both ends by an odd reflection of three times the filter's length (less on
    shorter channels), and each run starts in the state of a constant input of
    its first sample.  The result does not depend on ``block``.  A null value
    counts as 0.  A channel of one sample is continued by nothing.
    """
    own = samples.select(*K, F.col("sample").cast("long").alias("sample"), F.coalesce(F.col("x").cast("double"), F.lit(0.0)).alias("x"))
    ends = cut(own.groupBy(*K).agg(F.count(F.lit(1)).alias("__n"), F.min_by("x", "sample").alias("__first"), F.max_by("x", "sample").alias("__last")))
    parts = []
    pads = {name: 3 * (len(poles) + 1) for name, (_, poles, _) in filters.items()}
    for name in filters:
        pad = F.least(F.lit(pads[name]).cast("long"), F.col("__n") - 1)
        rows = attach(own, ends, K).withColumn("__pad", pad)
        s, n, p = F.col("sample"), F.col("__n"), F.col("__pad")
        before = F.when((s > 0) & (s <= p), F.struct((p - s).alias("at"), (2 * F.col("__first") - F.col("x")).alias("x")))
        after = F.when((s < n - 1) & (s >= n - 1 - p), F.struct((p + 2 * (n - 1) - s).alias("at"), (2 * F.col("__last") - F.col("x")).alias("x")))
        each = F.array_compact(F.array(F.struct((p + s).alias("at"), F.col("x").alias("x")), before, after))
        parts.append(rows.select(*K, F.lit(name).alias("band"), F.explode(each).alias("e")).select(*K, "band", "e.at", "e.x"))
    extended = parts[0]
    for part in parts[1:]:
        extended = extended.unionByName(part)
    gathered = F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda e: e["x"])
    blocks = cut(extended.groupBy(*K, "band", F.floor(F.col("at") / block).cast("long").alias("block")).agg(gathered.alias("x")))
    done = _pass(_pass(blocks, filters, back=False), filters, back=True)
    pad_of = F.create_map(*[v for name, n in pads.items() for v in (F.lit(name), F.lit(n).cast("long"))])
    each = done.select(*K, "band", "block", F.posexplode("x").alias("pos", "x"))
    placed = attach(each, ends.select(*K, "__n"), K).withColumn("__pad", F.least(pad_of[F.col("band")], F.col("__n") - 1))
    placed = placed.withColumn("sample", F.col("block") * block + F.col("pos") - F.col("__pad"))
    return placed.where((F.col("sample") >= 0) & (F.col("sample") < F.col("__n"))).select(*K, "band", "sample", "x")


def recursive_bandpass(samples: DataFrame, lo: float, hi: float, fs: float, order: int = 4, block: int = 60_000) -> DataFrame:
    return forward_back(samples, {"band": butterworth(lo, hi, fs, order)}, block).drop("band")


def recursive_notch(samples: DataFrame, line: float, fs: float, q: float = 30.0, block: int = 60_000) -> DataFrame:
    return forward_back(samples, {"notch": notch_filter(line, fs, q)}, block).drop("band")


def recursive_bank(samples: DataFrame, bands: dict[str, tuple[float, float]], fs: float, order: int = 4, block: int = 60_000) -> DataFrame:
    """The signal under several bands, with the band as a column."""
    return forward_back(samples, {n: butterworth(lo, hi, fs, order) for n, (lo, hi) in bands.items()}, block)
