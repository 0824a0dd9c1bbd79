import math

import numpy as np
import pytest

from marginwatch.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, component string"


def reference(vectors):
    x = np.floor(1024 * np.array(vectors, float)) + 100_000
    n, s = len(x), x.sum(axis=0)
    v = (x - s / n).T @ (x - s / n) / n
    e, u = np.linalg.eigh(v)
    return x, n, s, e[::-1], u[:, ::-1]


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("dim, n", [(48, 3000), (6, 400)])
def test_against_the_full_covariance(spark, dim, n):
    rng = np.random.default_rng(dim)
    v = rng.normal(size=(n, dim)) * np.linspace(0.4, 0.1, dim) + 0.05
    got = W.whiten(table(spark, enumerate(v)).repartition(3)).toPandas().sort_values(["vec_id", "component"])
    x, n, s, e, u = reference(v)
    k = min(8, dim)
    assert len(got) == n * k and list(got.component[:k]) == list(range(1, k + 1)) and set(got.n) == {n}
    mine = got.whitened.to_numpy().reshape(n, k)
    want = (x - s / n) @ u[:, :k] / np.sqrt(e[:k])
    assert np.abs(mine * np.sign((mine * want).sum(axis=0)) - want).max() < 1e-9
    assert np.abs(got.explained.to_numpy()[:k] / (e[:k] / e.sum()) - 1).max() < 1e-9
    assert np.abs(np.cov(mine.T, bias=True) - np.eye(k)).max() < 1e-9 and set(got.identity_error) == {got.identity_error.iloc[0]} and got.identity_error.iloc[0] < 1e-9
    xi = x.astype(int).astype(object)
    assert list(got.deviation[::k]) == ((n * xi - xi.sum(axis=0)) ** 2).sum(axis=1).tolist()


def test_few_passes_and_certificate(spark):
    rng = np.random.default_rng(3)
    rows = W.whole_numbers(table(spark, enumerate(rng.normal(size=(2000, 64)))), "vec_id", "embedding")
    passes = W.Passes(W.blocks_of(rows, 64), 64)
    values, q, off = W.leading_components(passes, 8)
    assert off <= W.ACCEPTED and passes.passes < 150 and np.abs(q.T @ q - np.eye(8)).max() < 1e-12
    assert np.allclose(values, reference(np.random.default_rng(3).normal(size=(2000, 64)))[3][:8], rtol=1e-12)


def test_odd_rows(spark):
    v = [[1.0, 2.0], [2.0, 1.0], [1.5, 7.0], [1.5, 7.0]]
    odd = [(10, None), (11, []), (12, [1.0, None]), (13, [math.nan, 1.0]), (14, [math.inf, 1.0]), (15, [1.0, 2.0, 3.0])]
    got = W.whiten(table(spark, [*enumerate(v), (3, v[3]), *odd])).collect()
    assert sorted({r.vec_id for r in got}) == [0, 1, 2, 3] and {r.n for r in got} == {5}
    assert len(got) == 10 and {r.component for r in got} == {1, 2}
    assert len({(r.whitened, r.component) for r in got if r.vec_id in (2, 3)}) == 2
    assert W.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert W.whiten(table(spark, odd[:2])).count() == W.whiten(table(spark, []).limit(0)).count() == 0
    line = W.whiten(table(spark, [(i, [i / 8, i / 4, 1.0]) for i in range(9)])).collect()  # one direction only
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12


def test_deviation_beyond_a_long_is_an_error(spark):
    with pytest.raises(Exception):
        W.whiten(table(spark, [(i, [1e9 * (i % 2), 1.0 * i]) for i in range(4000)])).collect()
