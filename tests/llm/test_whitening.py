"""Operator 13 against whole-number arithmetic of any length and its own covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from farelane.llm import whitening as wh
from farelane.llm.common import read

SCHEMA = "vec_id long, embedding array<float>"


def checked(rows, out, components=32):
    fit = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in r[1]] for r in fit]
    n, size = len(x), len(x[0])
    sums = [sum(v[d] for v in x) for d in range(size)]
    deviation = sorted((r[0], sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for r, v in zip(fit, x, strict=True))
    v = np.array([[float(Fraction(n * sum(a[i] * a[j] for a in x) - sums[i] * sums[j], n * n)) for j in range(size)] for i in range(size)])
    values = np.linalg.eigvalsh(v)[::-1]
    got = out.toPandas()
    k = got.component.max()
    assert len(got) == n * k
    assert sorted(got[got.component == 1][["vec_id", "deviation"]].itertuples(index=False, name=None)) == deviation
    assert (got.n == n).all()
    for c in range(1, k + 1):
        assert got[got.component == c].explained.iloc[0] == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    cov = wide.T @ wide / n - np.outer(wide.mean(axis=0), wide.mean(axis=0))
    assert np.abs(cov - np.eye(k)).max() < 1e-8
    assert got.identity_error.nunique() == 1
    assert got.identity_error.iloc[0] < 1e-8
    # Each component is an eigenvector's projection: the regression of x on it gives the vector back.
    centred = np.array([[float(Fraction(a * n - s, n)) for a, s in zip(v_, sums, strict=True)] for _, v_ in sorted(zip([r[0] for r in fit], x, strict=True))])
    sides = centred.T @ wide / n / np.sqrt(values[:k])
    assert np.abs(sides.T @ sides - np.eye(k)).max() < 1e-8
    assert np.abs(v @ sides - sides * values[:k]).max() < 1e-7 * values[0]


def test_table_against_whole_numbers(spark, small):
    df = read(spark, small, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    out = wh.whitened(df)
    assert out.filter("component = 32").count() == len(rows)
    checked(rows, out)


def test_nulls_odd_entries_and_few_dimensions(frame):
    dice = np.random.default_rng(3)
    rows = [(i, [float(c) for c in dice.normal(size=5) * [1, 5, 0.1, 300, 2]]) for i in range(200)]
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan"), 0.0, 0.0, 0.0, 0.0]), (903, [float("inf")] * 5), (904, []), (905, [1.0, 2.0])]
    out = wh.whitened(frame(rows, SCHEMA))
    assert out.filter("vec_id >= 900").count() == 0
    checked([r for r in rows if r[1] is None or len(r[1]) == 5], out)


def test_repeated_and_null_ids_keep_their_rows(frame):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [3.0, 5.0]), (2, [1.0, -1.0])]
    out = wh.whitened(frame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in out) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2)]


def test_directions_without_spread_are_left_out(frame):
    assert wh.whitened(frame([], SCHEMA)).count() == 0
    assert wh.whitened(frame([(1, [1.0, 2.0])], SCHEMA)).count() == 0
    assert wh.whitened(frame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)).count() == 0
    out = wh.whitened(frame([(i, [float(i), 2.0, float(i)]) for i in range(9)], SCHEMA)).collect()
    assert {r.component for r in out} == {1}
    assert out[0].explained == pytest.approx(1)


def test_deviations_that_no_long_holds(frame):
    rows = [(1, [3e15, 0.0]), (2, [-3e15, 1.0]), (3, [5.0, 2.0])]
    out = {r.vec_id: r for r in wh.whitened(frame(rows, SCHEMA)).filter("component = 1").collect()}
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    sums = [sum(c) for c in zip(*x.values(), strict=True)]
    for i, v in x.items():
        exact = sum((3 * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        assert out[i].deviation == (exact if exact < 1 << 63 else None)
        assert (int(out[i].wide_deviation) if out[i].wide_deviation is not None else out[i].deviation) == exact


@pytest.mark.parametrize("widths", [(3, 1, 0, 7), (40, 2, 61, 5), (24, 25, 23, 48)])
def test_planes_give_exact_products(widths):
    dice = np.random.default_rng(7)
    x = np.stack([dice.integers(0, 1 << w, size=1000) if w else np.zeros(1000, np.int64) for w in widths], axis=1)
    real = [int(c).bit_length() for c in x.max(axis=0)]
    dims = np.array([d for d, w in enumerate(real) for _ in range(w)])
    bits = np.array([b for w in real for b in range(w)])
    used = np.unique(dims)
    counts = sum(wh.joint_counts(wh.planes(x[a : a + 300], dims, bits)) for a in range(0, 1000, 300))
    whole = np.zeros((len(used), len(used)), object)
    for limb, part in wh.weighted(counts, dims, bits):
        whole += part.astype(object) * (1 << (wh.LIMB * limb))
    y = x[:, used].astype(object)
    assert (whole == y.T.dot(y)).all()
