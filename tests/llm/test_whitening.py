"""Whitening against a full eigendecomposition."""

import math
from decimal import Decimal

import numpy as np
import pytest

from custlens.llm import queries as q
from custlens.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, component string, n int"


def plain(rows, k=4):
    """(id, component) -> (n, deviation, whitened up to its sign, explained), by numpy on the driver and Python's integers."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array(fit, float) - np.array(sums) / n
    e, vectors = np.linalg.eigh(x.T @ x / n)
    e, vectors = e[::-1], vectors[:, ::-1]
    out = {}
    for i, v in kept:
        z = (np.array(v, float) - np.array(sums) / n) @ vectors[:, :k] / np.sqrt(e[:k])
        for c in range(min(k, len(sums))):
            out.setdefault((i, c + 1), []).append((n, sum((n * a - s) ** 2 for a, s in zip(v, sums)), z[c], e[c] / e.sum()))
    return out


def compare(got, want, close=1e-8):
    assert len(got) == sum(map(len, want.values()))
    sign = {}
    for r in got:
        n, deviation, z, explained = next(w for w in want[(r[0], r.component)] if w[1] == int(r.deviation))
        sign.setdefault(r.component, math.copysign(1, r.whitened * z) if abs(z) > 1e-3 else None)
        assert r.n == n and r.explained == pytest.approx(explained, rel=1e-10) and r.identity_error < 1e-10
        assert r.whitened == pytest.approx((sign[r.component] or math.copysign(1, r.whitened * z)) * z, abs=close)


def test_op11_equals_full_decomposition(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in q.table(spark, folder, "embeddings").collect()]
    got = q.QUERIES["op11_embedding_whitening"](spark, folder)
    assert [f.simpleString() for f in got.schema][:4] == ["vec_id:bigint", "component:int", "n:bigint", "deviation:bigint"]
    compare(got.collect(), plain(rows))


def test_bad_rows_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(300, 30)) * np.linspace(2, 0.5, 30))]
    rows += [(5, rows[5][1])] * 2 + [(900, rows[7][1]), (None, rows[8][1]), (901, [-0.0] * 30)]
    bad = [(902, None), (903, [None] + [1.0] * 29), (904, [float("nan")] * 30), (905, [float("-inf")] * 30), (906, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], SCHEMA)
    vectors = wh.integer_vectors(df, "vec_id", "embedding")
    assert vectors.count() == len(rows) + 1  # the empty vector takes part, without components
    compare(wh.whiten(vectors, wh.fit(vectors)).collect(), plain(rows))
    none = vectors.where("false")
    assert wh.whiten(none, wh.fit(none)).count() == 0


def test_lengths_are_fitted_apart_and_constants_have_no_variance(spark):
    rows = [(i, [float(i % 5), float(i % 3), 1.0]) for i in range(30)] + [(100 + i, [float(i), 2.0 * i]) for i in range(9)] + [(200, [3.0])]
    vectors = wh.integer_vectors(spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA), "vec_id", "embedding")
    got = {(r.id, r.component): r for r in wh.whiten(vectors, wh.fit(vectors)).collect()}
    assert {c for _, c in got} == {1, 2, 3} and len(got) == 30 * 3 + 9 * 2 + 1
    assert got[(0, 3)].whitened is None and got[(0, 3)].explained == pytest.approx(0, abs=1e-12) and got[(0, 1)].n == 15
    assert got[(100, 2)].whitened is None and abs(got[(100, 1)].whitened) == pytest.approx(4 / math.sqrt(60 / 9)) and got[(200, 1)].explained is None


def spectrum(values, seed=1):
    u = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    return (u * values) @ u.T, u


@pytest.mark.parametrize("values", [
    np.linspace(1.1, 0.9, 200),  # a flat spectrum: small gaps
    10.0 ** -np.arange(0, 100) * 1e6,  # a steep one
    np.concatenate([[5, 4, 3, 2], np.full(60, 1.0)]),
    np.concatenate([[9.0, 2.0, 1.0, 0.5, 0.1], np.zeros(75)]),  # less rank than the block has columns
])
def test_leading_vectors_of_many_spectra(values):
    v, u = spectrum(values)
    passes = []
    e, found = wh.leading(lambda b: passes.append(1) or v @ b, len(values))
    assert e == pytest.approx(values[:4], rel=1e-9) and len(passes) < 200
    gap = np.min(np.abs(np.subtract.outer(values, values)) + np.eye(len(values)) * 1e9, axis=1)[:4]
    assert (1 - np.abs((found * u[:, :4]).sum(axis=0)) < np.maximum(1e-12, (1e-12 * values[0] / gap) ** 2)).all()


def test_equal_eigenvalues_end():
    v, _ = spectrum(np.concatenate([np.full(10, 3.0), np.linspace(1, 0, 70)]))
    e, found = wh.leading(lambda b: v @ b, 80)
    assert e == pytest.approx([3.0] * 4) and np.allclose(v @ found, 3 * found, atol=1e-11)


def test_deviation_is_exact_at_any_width():
    rows = np.array([[3, -4], [2**62, 5]])
    small = wh.deviations(rows[:1], 10, [7, 9]).to_pylist()
    assert small == [Decimal(23**2 + 49**2)]
    assert wh.deviations(rows, 10, [7, 9]).to_pylist() == [Decimal(23**2 + 49**2), None]
    wide = wh.deviations(rows[:1] * 10**9, 10**6, [7, 9]).to_pylist()
    assert wide == [Decimal((3 * 10**15 - 7) ** 2 + (4 * 10**15 + 9) ** 2)]
    assert wh._exact_sums(np.array([[2**62, 5]] * 3)) == [3 * 2**62, 15]
    kind, block = wh._packed(np.array([[-3, 300]]))
    assert kind == "<i2" and np.frombuffer(block, kind).tolist() == [-3, 300]
