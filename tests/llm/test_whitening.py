import math
from fractions import Fraction

import numpy as np
import pytest

from duolog.llm import whitening
from duolog.llm.whitening import Spectrum, secular_roots

SCHEMA = "vec_id long, embedding array<float>, label int, x string"


def covariance(x):
    """Exact covariance of integer rows, rounded once."""
    n, sums = len(x), [sum(map(int, c)) for c in x.T]
    square = x.astype(object).T @ x.astype(object)
    return np.array([[float(Fraction(n * int(square[i, j]) - sums[i] * sums[j], n * n)) for j in range(x.shape[1])] for i in range(x.shape[1])])


def test_roots_interlace_and_solve_the_secular_equation():
    rng = np.random.default_rng(1)
    for m in (1, 2, 7, 60):
        for spread in (1.0, 1e-6, 1e6):
            d = np.cumsum(rng.random(m) * spread + spread * 1e-3)
            z = rng.normal(size=m)
            roots, away = secular_roots(d, z, 0.7)
            assert (roots > d).all() and (roots[:-1] < d[1:]).all()
            assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(z, z)), rtol=1e-12, atol=1e-13 * roots[-1])
            assert np.allclose(away, d[:, None] - roots, rtol=1e-6)


@pytest.mark.parametrize("kind", ["plain", "few", "small integers", "unit", "scales", "equal", "one dimension"])
def test_spectra_of_updates_and_merges(kind):
    rng = np.random.default_rng(2)
    x = {
        "plain": np.floor(rng.normal(size=(400, 24)) * 40), "few": np.repeat(np.floor(rng.normal(size=(5, 20)) * 40), 8, 0), "small integers": rng.integers(0, 2, (300, 10)).astype(float),
        "unit": np.eye(16).repeat(2, 0) * 1e5, "scales": np.floor(rng.normal(size=(200, 8)) * 10.0 ** np.arange(8)), "equal": np.ones((6, 3)), "one dimension": np.arange(9.0)[:, None],
    }[kind]
    one, parts = Spectrum(x.shape[1]), [Spectrum(x.shape[1]) for _ in range(4)]
    for k, row in enumerate(x):
        one.add(row)
        parts[k % 3].add(row)  # the fourth stays empty
    merged = Spectrum.unpacked(whitening._merged_spectra([p.packed() for p in parts]))
    scatter = np.atleast_2d(np.cov(x.T, bias=True)) * len(x)
    for s in (one, merged):
        assert s.n == len(x) and np.allclose(s.mean, x.mean(0), atol=1e-9)
        assert np.abs(s.vectors.T @ s.vectors - np.eye(x.shape[1])).max() < 1e-12
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() <= 1e-12 * max(1.0, np.abs(scatter).max())


def rows_of(vectors):
    return [(k, None if v is None else [None if c is None else float(c) for c in v], k % 3, "x") for k, v in enumerate(vectors)]


def check(got, kept, components=4):
    """kept: vec_id -> vector of float32 values."""
    x = {k: np.array([math.floor(256 * float(c)) for c in v], np.int64) for k, v in kept.items()}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    n, sums = len(fit), [sum(map(int, c)) for c in fit.T]
    v = covariance(fit)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, fit.shape[1])
    assert sorted((r.vec_id, r.component) for r in got) == sorted((k, c) for k in x for c in range(1, keep + 1))
    signs = {}
    for r in got:
        at = x[r.vec_id]
        assert r.n == n and r.deviation == sum((n * int(a) - s) ** 2 for a, s in zip(at, sums))
        e = values[r.component - 1]
        assert math.isclose(r.explained, e / np.trace(v), rel_tol=1e-9) and r.identity_error < 1e-9
        expected = float(vectors[:, r.component - 1] @ (at - np.array(sums) / n) / math.sqrt(e))
        if abs(expected) > 1e-6:
            assert math.isclose(abs(r.whitened), abs(expected), rel_tol=1e-7, abs_tol=1e-8)
            signs.setdefault(r.component, set()).add(r.whitened * expected > 0)
    assert all(len(s) == 1 for s in signs.values())
    assert len({r.identity_error for r in got}) == 1


def test_whitening_equals_an_exact_covariance(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(16, 16))
    vectors = [*(rng.normal(size=(400, 16)) @ mix * 0.1).astype(np.float32)]
    vectors += [vectors[0]] * 300 + [vectors[1]]  # copies count once in the fit
    bad = [None, [], [None] * 16, [float("nan")] + [0.0] * 15, [float("inf")] + [0.0] * 15, [1.0] * 15, [0.5] * 15 + [None]]
    zero = [np.zeros(16, np.float32), -np.zeros(16, np.float32)]
    df = spark.createDataFrame(rows_of([*vectors, *zero, *bad]), SCHEMA).repartition(6)
    check(whitening.whitened(df).collect(), dict(enumerate([*vectors, *zero])))


def test_few_dimensions_null_ids_repeats_and_no_variance(spark):
    two = spark.createDataFrame(rows_of([[0.1, 0.9], [0.3, 0.2], [0.5, 0.7]]), SCHEMA)
    check(whitening.whitened(two).collect(), {0: np.float32([0.1, 0.9]), 1: np.float32([0.3, 0.2]), 2: np.float32([0.5, 0.7])})
    same = spark.createDataFrame([(None, [0.5, 0.25], 1, "x"), (None, [0.5, 0.25], 1, "x"), (4, [0.5, 0.25], 1, "x")], SCHEMA)
    got = whitening.whitened(same).collect()
    assert len(got) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, 0.0, 0.0, 0.0)}
    line = spark.createDataFrame(rows_of([[0.0, 0.0, 0.0], [1.0, 1.0, 1.0], [2.0, 2.0, 2.0]]), SCHEMA)
    got = whitening.whitened(line).collect()
    assert {(r.component, round(r.explained, 9)) for r in got} == {(1, 1.0), (2, 0.0), (3, 0.0)} and {r.whitened for r in got if r.component > 1} == {0.0}
    for nothing in (two.limit(0), spark.createDataFrame(rows_of([None, []]), SCHEMA)):
        found = whitening.whitened(nothing)
        assert found.count() == 0 and found.columns == whitening.whitened(two).columns


def test_deviations_are_exact_or_null():
    x = np.array([[2**40, -(2**40)], [3, 4]], np.int64)
    assert whitening.deviations(x, 5, [10, 20]) == [None, 25]
    assert whitening.deviations(x[1:], 5, [10, 20]) == [25] and whitening.deviations(x[:0], 5, [10, 20]) == []


def test_tree_of_more_summaries_than_one_task_takes(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(5)
    vectors = [*rng.normal(size=(60, 6)).astype(np.float32)]
    check(whitening.whitened(spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(9)).collect(), dict(enumerate(vectors)))
