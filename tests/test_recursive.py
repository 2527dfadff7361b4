"""Block-wise recursive filters against the plain recursion with its end padding."""

import numpy as np
import pytest

from sessionloom.operators import recursive


def plain_run(b, a, x, state):
    state, out = np.array(state, float), []
    n = len(state)
    for v in x:
        y = b[0] * v + state[0]
        out.append(y)
        state = np.array([(state[i + 1] if i + 1 < n else 0.0) + b[i + 1] * v - a[i + 1] * y for i in range(n)])
    return np.array(out)


def coefficients_of(zpk):
    return zpk[2] * np.real(np.poly(zpk[0])), np.real(np.poly(zpk[1]))


def plain_filtfilt(zpk, x):
    b, a = coefficients_of(zpk)
    n = len(a) - 1
    pad = min(3 * len(a), len(x) - 1)
    ext = np.concatenate((2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1])) if pad else x
    step = np.eye(n, k=1)
    step[:, 0] -= a[1:]
    rest = np.linalg.solve(np.eye(n) - step, b[1:] - a[1:] * b[0])
    y = plain_run(b, a, ext, rest * ext[0])
    y = plain_run(b, a, y[::-1], rest * y[-1])[::-1]
    return y[pad : pad + len(x)]


def response(zpk, f, fs):
    coefficients = coefficients_of(zpk)
    z = np.exp(-2j * np.pi * f / fs * np.arange(len(coefficients[0])))
    return abs(np.sum(np.array(coefficients[0]) * z) / np.sum(np.array(coefficients[1]) * z))


def test_designs_have_their_edges():
    for lo, hi, fs, order in ((5, 20, 64, 4), (0.5, 40, 500, 4), (8, 13, 128, 2)):
        c = recursive.butterworth(lo, hi, fs, order)
        assert abs(response(c, lo, fs) - 0.5**0.5) < 1e-4 and abs(response(c, hi, fs) - 0.5**0.5) < 1e-4
        middle = fs / np.pi * np.arctan((np.tan(np.pi * lo / fs) * np.tan(np.pi * hi / fs)) ** 0.5)
        assert abs(response(c, middle, fs) - 1) < 1e-4
        assert (np.abs(c[1]) < 1).all()
    c = recursive.notch_filter(60, 500, 30)
    assert response(c, 60, 500) < 1e-9 and abs(response(c, 59, 500) - 0.5**0.5) < 0.01 and response(c, 40, 500) > 0.99


@pytest.mark.parametrize("block", [50, 333, 60_000])
def test_equals_the_plain_recursion(spark, block):
    rng = np.random.default_rng(1)
    signals = {("a", 0): rng.normal(size=1700).cumsum(), ("a", 1): rng.normal(size=501), ("b", 0): rng.normal(size=20), ("b", 1): np.array([3.0]), ("c", 0): np.full(64, 2.0)}
    rows = [(s, c, i, float(v)) for (s, c), x in signals.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "session_id string, channel int, sample long, x double").repartition(4)
    filters = {"low": recursive.butterworth(4, 8, 64), "line": recursive.notch_filter(20, 64, 5)}
    got = {}
    for r in recursive.forward_back(df, filters, block).collect():
        got.setdefault((r.band, r.session_id, r.channel), []).append((r["sample"], r.x))
    assert len(got) == 10
    for (band, s, c), y in got.items():
        want = plain_filtfilt(filters[band], signals[s, c])
        y = sorted(y)
        assert [k for k, _ in y] == list(range(len(want)))
        assert np.abs(np.array([v for _, v in y]) - want).max() <= 1e-9 * max(1, np.abs(signals[s, c]).max())


def test_low_edge_at_a_high_rate(spark):
    """0.5 to 40 Hz at 500 Hz, poles close to 1: the coefficients of the plain recursion lose digits, the poles do not."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=4000) + 5 * np.sin(np.arange(4000) / 40)
    df = spark.createDataFrame([("s", 0, i, float(v)) for i, v in enumerate(x)], "session_id string, channel int, sample long, x double")
    got, again = (np.array([r.x for r in recursive.recursive_bandpass(df, 0.5, 40, 500, block=b).orderBy("sample").collect()]) for b in (900, 70))
    assert np.abs(got - again).max() < 1e-9
    assert np.abs(got - plain_filtfilt(recursive.butterworth(0.5, 40, 500), x)).max() < 1e-4


def test_empty_table(spark):
    df = spark.createDataFrame([], "session_id string, channel int, sample long, x double")
    assert recursive.recursive_notch(df, 60, 500).count() == 0
