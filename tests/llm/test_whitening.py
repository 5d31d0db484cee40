"""Whitening against a dense eigensolver."""

import math

import numpy as np
import pytest

from cellmart.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in rows], SCHEMA).repartition(4)


def brute(rows, k):
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=float)
    exact = sorted(set(map(tuple, x.values())))
    n, sums = len(exact), [sum(c) for c in zip(*exact)]
    mean = np.array([s / n for s in sums])
    v = (fit - mean).T @ (fit - mean) / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:k]
    dev = {i: sum((n * a - s) ** 2 for a, s in zip(r, sums)) for i, r in x.items()}
    white = {i: (np.array(r) - mean) @ vectors[:, order] / np.sqrt(values[order]) for i, r in x.items()}
    return n, dev, white, values[order] / np.trace(v)


def test_rows_match(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.standard_normal(24) * np.linspace(.2, 3, 24)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(400)]
    n, dev, white, share = brute(rows, 16)
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 16 * len(rows)
    sign = {}
    for r in got:
        k = r["component"] - 1
        want = white[r["vec_id"]][k]
        if k not in sign and abs(want) > 1e-3:
            sign[k] = math.copysign(1, want * r["whitened"])
        assert r["n"] == n and r["deviation"] == dev[r["vec_id"]]
        assert abs(r["explained"] - share[k]) <= 1e-9 * share[k] and r["identity_error"] < 1e-9
        if k in sign:
            assert abs(sign[k] * r["whitened"] - want) < 1e-8
    assert len(sign) == 16


def test_left_out_rows_and_edges(spark):
    good = [(i, [float(i), float(i * i % 7), 1.0]) for i in range(20)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [1.0, float("inf"), 2.0]), (105, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, good + bad + [(None, good[0][1]), (3, good[3][1])])).collect()
    # The third entry does not vary: two components.
    assert {r["component"] for r in got} == {1, 2} and len(got) == 2 * 22
    assert {r["n"] for r in got} == {20} and sum(r["vec_id"] is None for r in got) == 2
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, bad[:2])).count() == 0
    assert whitening.whiten(frame(spark, good[:1] * 3)).count() == 0
    assert whitening.whiten(frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])).where("deviation IS NULL").count() > 0


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 64), np.repeat([5.0, 4.0, 1.0], [3, 30, 31]), np.ones(20), np.logspace(0, -9, 40),
    np.concatenate(([7.0], 1 + 1e-7 * np.arange(50))), np.array([2.0]), np.array([3.0, 1.0])])
def test_feast(values):
    rnd = np.random.default_rng(2)
    q, _ = np.linalg.qr(rnd.standard_normal((len(values), len(values))))
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    got, vectors = whitening.feast(v, 16)
    want = np.sort(values)[::-1][:16]
    assert len(got) == len(want)
    assert np.allclose(got, want, rtol=1e-12, atol=1e-13 * want[0])
    assert np.abs(v @ vectors - vectors * got).max() < 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-8


def test_inertia_counts():
    rnd = np.random.default_rng(3)
    a = rnd.standard_normal((30, 30))
    a = a + a.T
    values = np.linalg.eigvalsh(a)
    shifts = rnd.uniform(values[0] - 1, values[-1] + 1, 50)
    assert (whitening.count_below(whitening.tridiagonal(a), shifts) == [(values < s).sum() for s in shifts]).all()
