import math
import random

import numpy as np
import pytest

from millrace.llm import whiten


def brute(rows, k=16):
    """Rows of (id, entries) that take part, by numpy and Python integers."""
    fine = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    grid = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in fine}
    fit = sorted({tuple(x) for x in grid.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for i, x in grid.items()}
    mean = np.array([s / n for s in sums])
    c = np.array(fit, dtype=float) - mean
    v = c.T @ c / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    white = {i: (np.array(x, dtype=float) - mean) @ vectors / np.sqrt(values) for i, x in grid.items()}
    return n, deviation, values / np.trace(v), white


def vectors(seed, n, d, spread=1.0):
    draw = np.random.default_rng(seed)
    scales = np.linspace(2, 0.5, d) ** spread
    return [(i, [float(np.float32(c)) for c in draw.standard_normal(d) * scales]) for i in range(n)]


@pytest.mark.parametrize("d,spread", [(40, 1.0), (24, 0.05), (5, 1.0), (70, 3.0)])
def test_against_numpy(spark, d, spread):
    rows = vectors(d, 400, d, spread)
    # copies count once in the fit; odd rows take no part
    rows += [(1000 + i, rows[0][1]) for i in range(150)]
    odd = [(5001, None), (5002, []), (5003, [1.0] * (d + 1)), (5004, [math.nan] + [0.0] * (d - 1)), (5005, [math.inf] * d), (5006, [None] * d), (5007, [1e300] * d)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = whiten.whitened_rows(frame, "vec_id", "embedding").collect()
    n, deviation, share, white = brute(rows)
    k = min(16, d)
    assert len(got) == len(rows) * k and {r["vec_id"] for r in got} == {i for i, _ in rows}
    sign = {}
    for r in got:
        want = white[r["vec_id"]][r["component"] - 1]
        sign.setdefault(r["component"], np.sign(want * r["whitened"]) if abs(want) > 1e-3 else None)
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-10 and r["identity_error"] < 1e-10
        assert abs(abs(r["whitened"]) - abs(want)) < 1e-7 * max(1, abs(want))
        if sign[r["component"]] is not None and abs(want) > 1e-3:
            assert np.sign(want * r["whitened"]) == sign[r["component"]]


def test_certificate_and_filter():
    """Without Spark: the filter damps what is unwanted, and the pairs found are V's."""

    class Dense:
        def __init__(self, v):
            self.v, self.dims, self.trace, self.passes, self.found = v, len(v), float(np.trace(v)), 0, None

        def times(self, q):
            self.passes += 1
            return self.v @ q

    draw = np.random.default_rng(3)
    basis, _ = np.linalg.qr(draw.standard_normal((200, 200)))
    values = np.concatenate([np.linspace(9, 6, 16), np.linspace(5.5, 0.1, 184)])
    v = Dense(basis * values @ basis.T)
    found = whiten.leading(v, 16)
    assert np.allclose(found.values, values[:16], rtol=1e-12) and found.residual < 1e-12
    assert np.abs(np.abs((found.vectors * basis[:, :16]).sum(axis=0)) - 1).max() < 1e-12
    low, high = whiten.spectrum_ends(v, 12, draw)
    assert high >= 9 and low < 2
    out = whiten.filtered(v, basis, 0.1, 5.5, 9.0, 10)
    grown = np.abs((basis * out).sum(axis=0))
    assert grown[16:].max() < 1e-3 and abs(grown[0] - 1) < 1e-9


def test_few_and_equal_vectors(spark):
    """Directions without spread are no components."""
    kind = "vec_id long, embedding array<float>, id string, x int, component string"
    none = spark.createDataFrame([], kind)
    assert whiten.whitened_rows(none, "vec_id", "embedding").count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], "a", 1, "c") for i in range(5)], kind)
    assert whiten.whitened_rows(same, "vec_id", "embedding").count() == 0
    line = spark.createDataFrame([(None, [1.0, 2.0, 5.0], "a", 1, "c"), (2, [3.0, 2.0, 1.0], "a", 1, "c")], kind)
    got = whiten.whitened_rows(line, "vec_id", "embedding").collect()
    assert [r["component"] for r in got] == [1, 1] and {r["vec_id"] for r in got} == {None, 2}
    assert all(abs(abs(r["whitened"]) - 1) < 1e-12 and abs(r["explained"] - 1) < 1e-12 for r in got)


def test_exact_deviations_beyond_a_long():
    draw = random.Random(2)
    rows = [[draw.randrange(-(1 << 40), 1 << 40) for _ in range(3)] for _ in range(20)] + [[5, 6, 7]] * 3
    x = np.array(rows, dtype=np.int64)
    for n in (1, 7, 1000):
        sums = [draw.randrange(n * 9) for _ in range(3)]
        want = [sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in rows]
        assert whiten.deviations(whiten.Moments(n, sums), x) == [w if w < 1 << 63 else None for w in want]
