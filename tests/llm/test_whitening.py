"""Operator 12 against numpy on whole numbers."""

import math

import numpy as np
import pytest

from treadle.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, id long, x string, `index` long"


def steps(vector):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in vector]


def expected(vectors, count=8):
    """Exact deviations by whole numbers; projections by numpy."""
    x = [steps(v) for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array(x, dtype=float) - np.array(sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:count], directions[:, ::-1][:, :count]
    return deviations, centred @ directions / np.sqrt(values), values, values / np.trace(centred.T @ centred / n)


def given(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, "x", 6) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("n, width, blocks", [(300, 12, None), (300, 12, 64), (90, 5, 64)])
def test_whitening_against_numpy(spark, monkeypatch, n, width, blocks):
    if blocks:  # several blocks of rows and of columns
        monkeypatch.setattr(whitening, "BLOCK_BYTES", 64 * 8 * 4)
        monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 4)
    own = np.random.default_rng(3)
    vectors = (own.normal(size=(n, width)) * np.linspace(0.1, 2, width)).astype(np.float32).tolist()
    vectors[1] = vectors[0]
    odd = [(None, None), (7001, []), (7002, [1.0] * (width - 1)), (7003, [float("nan")] + [0.0] * (width - 1)),
           (7004, [None] + [0.0] * (width - 1)), (7005, [float("inf")] + [0.0] * (width - 1))]
    got = whitening.whiten(spark, given(spark, [*enumerate(vectors), *odd]).repartition(5)).collect()
    count = min(8, width)
    deviations, projected, values, shares = expected(vectors, count)
    assert len(got) == n * count and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, count + 1))
    table = np.full((n, count), np.nan)
    for r in got:
        table[r.id, r.component - 1] = r.whitened
        assert r.deviation == deviations[r.id]
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    signs = np.sign((table * projected).sum(axis=0))
    assert np.abs(table - projected * signs).max() < 1e-8


def test_no_usable_vector(spark):
    assert whitening.whiten(spark, given(spark, [])).count() == 0
    assert whitening.whiten(spark, given(spark, [(1, None), (2, [])])).columns == [
        "id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_equal_vectors_and_null_ids(spark):
    got = whitening.whiten(spark, given(spark, [(None, [1.0, 2.0])] * 2 + [(3, [1.0, 2.0])])).collect()
    assert len(got) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(3, 0, None, 0.0, 0.0)}


def test_sums_beyond_a_long(spark):
    big = [3.0e30, -3.0e30, 1.0]
    got = {r.id: r.deviation for r in whitening.whiten(spark, given(spark, [(k, [v, 0.5]) for k, v in enumerate(big)]), count=1).collect()}
    assert got[0] is None and got[1] is None and set(got) == {0, 1, 2}
    x = [[2 ** 31 + 100_000, 100_512], [-(2 ** 31) + 100_000, 100_512], [100_000, 100_512]]
    exact = {k: sum((3 * a - s) ** 2 for a, s in zip(v, (300_000, 301_536))) for k, v in enumerate(x)}
    got = {r.id: r.deviation for r in whitening.whiten(
        spark, given(spark, [(0, [2.0 ** 21, 0.5]), (1, [-(2.0 ** 21), 0.5]), (2, [0.0, 0.5])]), count=1).collect()}
    assert got == {k: d if d < 2 ** 63 else None for k, d in exact.items()}
