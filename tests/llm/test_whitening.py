"""Whitening against NumPy's eigenvectors of the exact covariance; contour integration by itself."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearwell.llm import feast, whitening
from clearwell.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, key int, x int, component int"


def table(llm, vectors):
    return llm.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in vectors], SCHEMA)


def symmetric(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    a = (q * values) @ q.T
    return (a + a.T) / 2


SPECTRA = {
    "spread": np.logspace(3, -3, 40),
    "equal": np.ones(30),
    "groups": np.repeat([9.0, 4.0, 1.0], [12, 3, 15]),
    "close": 1 + np.arange(25) * 1e-7,
    "low rank": np.concatenate([np.arange(1, 6), np.zeros(20)]),
    "one": np.array([2.5]),
    "steep": 10.0 ** -np.arange(12),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_all_wanted_eigenpairs_are_found(name):
    values = np.sort(SPECTRA[name])[::-1]
    a = symmetric(values)
    parts = feast.intervals(a, 32)
    assert sum(c for *_, c in parts) >= min(32, (values > 0).sum())
    vectors = np.concatenate([feast.eigenpairs(a, *p)[1] for p in parts], axis=1)
    found, vectors = feast.combined(a, vectors, 32)
    assert np.allclose(found, values[: len(found)], atol=1e-12 * values[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12 * values[0]


def test_directions_mixed_from_both_sides_do_not_count():
    # Eigenvalues as far below the interval as above it are filtered alike, so their mean inside is a value of a mixed direction.
    inside, sides = np.array([69.5, 69.9, 70.2, 70.6]), 1.15 + 0.1 * np.arange(12)
    for seed in range(8):
        a = symmetric(np.concatenate([inside, 70 - sides, 70 + sides, [71.1]]), seed)
        values, vectors = feast.eigenpairs(a, 69.0, 71.0, 4)
        assert np.allclose(np.sort(values), inside, atol=1e-11)
        assert np.abs(a @ vectors - vectors * values).max() < 1e-10


def test_eigenvalues_beside_a_crowded_end():
    a = symmetric(np.concatenate([[64.0, 32 + 1e-6], 32 - 1e-6 * np.arange(1, 80)]))
    values, vectors = feast.eigenpairs(a, 32.0, 64.1, 2)
    assert np.allclose(np.sort(values), [32 + 1e-6, 64], atol=1e-11)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-10


def test_inertia_counts():
    for name, values in SPECTRA.items():
        inertia = feast.Inertia(symmetric(values, 5))
        for shift in (1e-5, 0.37, 0.99, 2.2, 3.7, 8.1, 1e4):
            assert inertia.above(shift) == (values > shift).sum(), (name, shift)


def exact(vectors):
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = n * x - s
    v = np.array([[float(Fraction(int(c), n**3)) for c in line] for line in centred.T @ centred])
    return n, [int((row * row).sum()) for row in centred], (centred / n).astype(float), v


def check(got, vectors, wanted):
    n, deviation, centred, v = exact([x for _, x in vectors])
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1][:wanted], directions[:, ::-1][:, :wanted]
    place = {i: r for r, (i, _) in enumerate(vectors)}
    w = np.zeros((n, wanted))
    for row in got:
        r, c = place[row.vec_id], row.component - 1
        assert row.n == n and int(row.deviation) == deviation[r]
        assert row.explained == pytest.approx(values[c] / np.trace(v), rel=1e-9)
        w[r, c] = row.whitened
    assert len(got) == n * wanted
    signs = np.sign((w * (centred @ directions)).sum(axis=0))
    assert np.allclose(w, centred @ directions / np.sqrt(values) * signs, atol=1e-8)
    measured = np.abs(np.cov(w.T, bias=True).reshape(wanted, wanted) - np.eye(wanted)).max()
    errors = {row.identity_error for row in got}
    assert len(errors) == 1 and measured < 1e-9 and abs(errors.pop() - measured) < 1e-10


def test_whitened_rows_against_numpy(llm):
    r = np.random.default_rng(2)
    vectors = [(i, (r.standard_normal(9) * np.arange(1, 10) + 500).tolist()) for i in range(150)]
    unusable = [
        (900, None), (901, []), (902, [1.0] * 8 + [None]), (903, [float("nan")] * 9), (904, [float("inf")] * 9),
        (905, [1e30] * 9), (906, [1.0, 2.0]),
    ]
    check(whitening.whiten(table(llm, vectors + unusable), 32).collect(), vectors, 9)
    check(whitening.whiten(table(llm, vectors), 4).collect(), vectors, 4)


def test_large_entries_stay_exact(llm):
    r = random.Random(3)
    vectors = [(i, [float(r.randrange(-(2**23), 2**23) * 256), float(r.randrange(100)), 3.0]) for i in range(60)]
    got = whitening.whiten(table(llm, vectors), 2).collect()
    n, deviation, _, _ = exact([v for _, v in vectors])
    assert {(x.vec_id, int(x.deviation)) for x in got} == {(i, d) for (i, _), d in zip(vectors, deviation, strict=True)}


def test_rows_without_variance_repeated_rows_and_keys(llm):
    assert whitening.whiten(table(llm, [])).collect() == []
    assert whitening.whiten(table(llm, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(table(llm, [(1, [1.0, 2.0])] * 5)).collect() == []
    # One direction varies: one component, the same row twice, a NULL key.
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [1.0, 2.0]), (4, [2.0, 4.0])]
    got = whitening.whiten(table(llm, rows)).collect()
    assert sorted((x.vec_id or 0, x.component, x.n) for x in got) == [(0, 1, 4), (1, 1, 4), (1, 1, 4), (4, 1, 4)]
    assert got[0].explained == pytest.approx(1.0) and got[0].identity_error < 1e-12
    named = table(llm, rows).withColumn("vec_id", F.lit("a"))
    assert {x.vec_id for x in whitening.whiten(named).collect()} == {"a"}


def test_query_on_its_table(llm):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op11_whiten"](llm, folder)
    assert dict(got.dtypes)["deviation"] == "bigint" and dict(got.dtypes)["component"] == "int"
    vectors = [(x.vec_id, x.embedding) for x in llm.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(got.collect(), vectors, min(32, len(vectors[0][1])))
