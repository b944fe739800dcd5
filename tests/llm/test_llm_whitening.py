"""Whitening against a plain eigendecomposition, FEAST against known spectra."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import feast, whitening
from spanloom.llm.queries import op12_feast_whitening

VECTOR = "vec_id long, embedding array<float>"


def pairs(matrix, wanted):
    spaces = [feast.solve(matrix, *cut) for cut in feast.intervals(matrix, wanted)]
    return feast.combine(matrix, spaces, wanted)


@pytest.mark.parametrize("spectrum", [
    np.linspace(1, 50, 64), 2.0 ** -np.arange(40), np.r_[np.ones(40), np.full(10, 3.0), 7], np.r_[np.zeros(30), 1, 2], np.r_[5, 5 - 1e-11, np.linspace(0, 4, 70)], [4.0], [0.0, 0.0],
    np.r_[np.full(20, 1e6), np.linspace(1e-3, 1, 40)],
])
def test_feast_finds_the_leading_pairs(spectrum):
    rng = np.random.default_rng(1)
    n = len(spectrum)
    turn = np.linalg.qr(rng.standard_normal((n, n)))[0]
    matrix = (turn * spectrum) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = pairs(matrix, 32)
    top = np.sort(np.asarray(spectrum, float))[::-1]
    expected = top[:32][top[:32] > 1e-9 * max(top[0], 1e-300)]
    assert len(values) >= len(expected)
    assert np.allclose(values[: len(expected)], expected, rtol=1e-9, atol=1e-13 * max(top[0], 1))
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * values).max(initial=0) <= 1e-11 * max(top[0], 1)


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 10, 40):
        for _ in range(20):
            matrix = rng.integers(-3, 4, (n, n)).astype(float)
            matrix += matrix.T
            values, shift = np.linalg.eigvalsh(matrix), rng.normal() * 3
            assert feast.count_above(matrix, shift) == (values > shift).sum()


def plain(rows):
    """Brute force over all rows in exact fractions, decomposed by the library."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, x = len(kept), [v for _, v in kept]
    sums = [sum(c) for c in zip(*x)]
    wide = [[n * c - s for c, s in zip(v, sums)] for v in x]
    array = np.array(wide, dtype=object)
    cov = np.array([[float(Fraction(int(e), n**3)) for e in row] for row in array.T @ array])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    return kept, n, [sum(c * c for c in v) for v in wide], array.astype(float) / n, values, vectors, np.trace(cov)


def hold(found, rows):
    kept, n, deviations, centred, values, vectors, trace = plain(rows)
    k = min(32, int((values > 1e-9 * values[0]).sum()))
    assert len(found) == k * len(kept)
    table = {(r.vec_id, r.component): r for r in found}
    expected = centred @ vectors[:, :k] / np.sqrt(values[:k])
    got = np.array([[table[i, c + 1].whitened for c in range(k)] for i, _ in kept])
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < 1e-7
    assert all(table[i, 1].deviation == (d if d < 1 << 63 else None) for (i, _), d in zip(kept, deviations))
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    for c in range(k):
        assert math.isclose(table[kept[0][0], c + 1].explained, values[c] / trace, rel_tol=1e-6)
    cov = got.T @ got / n - np.outer(got.mean(axis=0), got.mean(axis=0))
    assert abs(np.abs(cov - np.eye(k)).max() - found[0].identity_error) < 1e-9 and found[0].identity_error < 1e-8


def test_whitening_matches_brute_force_and_skips_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(40) * np.linspace(0.1, 9, 40) + 3).astype(np.float32).tolist()) for i in range(500)]
    bad = [(1000, None), (1001, [None] + [1.0] * 39), (1002, [math.nan] * 40), (1003, [math.inf] * 40)]
    df = spark.createDataFrame(rows + bad, VECTOR).withColumn("total", F.lit("x")).withColumn("entries", F.lit(1)).repartition(5)
    hold(whitening.whiten(df).collect(), rows)


def test_few_large_or_no_vectors(spark):
    make = lambda rows: whitening.whiten(spark.createDataFrame(rows, VECTOR)).collect()
    assert make([]) == [] and make([(1, [1.0, 2.0])]) == [] and make([(1, []), (2, None)]) == [] and make([(1, [1.0]), (2, [1.0])]) == []
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [5e8, 3.0]), (4, [1.0])]
    found = make(rows)
    assert {r.vec_id for r in found} == {1, 2, 3}  # the shorter vector is left out
    hold(found, rows[:3])
    assert {r.deviation for r in make([(1, [1e11]), (2, [-1e11])])} == {None}


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    hold(op12_feast_whitening(spark, "/root/testdata/sf0.01").collect(), rows)
