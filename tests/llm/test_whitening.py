"""Whitening against plain integer arithmetic and numpy."""

import math

import numpy as np
import pytest

from cyclelens.llm import entries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string"


def table(spark, vectors, ids=None):
    ids = ids or range(len(vectors))
    return spark.createDataFrame([(i, v, 1, 2, "c") for i, v in zip(ids, vectors)], SCHEMA)


def whole(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def judge(rows, vectors, ids, components=32):
    xs = [whole(v) for v in vectors]
    n, dims = len(xs), len(xs[0])
    sums = [sum(x[d] for x in xs) for d in range(dims)]
    assert {(r.row_id, r.n, r.deviation) for r in rows} == {
        (i, n, sum((n * x[d] - sums[d]) ** 2 for d in range(dims))) for i, x in zip(ids, xs)}
    centred = np.array([[x[d] - sums[d] / n for d in range(dims)] for x in xs])
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    by_id = {r.row_id: r for r in rows}
    made = np.array([[c.whitened for c in by_id[i].components] for i in ids], float)
    k = made.shape[1]
    assert k == min(components, dims)
    want = centred @ axes[:, ::-1][:, :k] / np.sqrt(values[::-1][:k])
    signs = np.sign((made * want).sum(axis=0))
    assert np.allclose(made, want * signs, atol=1e-6)
    error = np.abs(made.T @ made / n - np.outer(made.mean(0), made.mean(0)) - np.eye(k)).max()
    assert rows[0].identity_error < 1e-4 and abs(error - rows[0].identity_error) < 1e-9
    share = [c.explained for c in rows[0].components]
    assert np.allclose(share, values[::-1][:k] / np.trace(v), rtol=1e-4)
    assert [c.component for c in rows[0].components] == list(range(1, k + 1))


def test_whitening_of_the_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    given = df.collect()
    rows = whitening.whiten(df.repartition(5)).collect()
    judge(rows, [r.embedding for r in given], [r.vec_id for r in given])
    flat = entries.whitened(spark, sf_dir)
    assert flat.columns == ["vec_id", "n", "deviation", "identity_error", "component", "whitened", "explained"]
    assert flat.count() == 32 * len(given)


def test_negative_and_uneven_entries(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(0, 1, (300, 6)) * [0.1, 1, 5, 40, 900, 3] + [0, -3, 8, -500, 1e5, 0]).astype(np.float32).tolist()
    rows = whitening.whiten(table(spark, vectors).repartition(7)).collect()
    judge(rows, vectors, range(300))


def test_cross_products_are_exact():
    rng = np.random.default_rng(4)
    for high in (2, 300, 1 << 20, 1 << 53):
        block = rng.integers(-high, high, (70, 5))
        sums, products = whitening._block_sums(block)
        exact = block.astype(object)
        assert sums.tolist() == exact.sum(axis=0).tolist()
        assert products.tolist() == (exact.T @ exact).tolist()
    for value in (0, 5, -1, 7 << 90, -(3 << 120)):
        assert sum(x << 32 * k for k, x in enumerate(whitening._limbs(value))) == value


@pytest.mark.parametrize("many", [1, 3])
def test_odd_vectors(spark, many):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 1.0, -2.0], [0.25, 3.0, 1.0], [7.0, 0.0, 0.5], [0.25, 3.0, 1.0]] * many
    bad = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1.0, 2.0], [1.0] * 5]
    df = table(spark, good + bad, [None, 1, 1, 2] * many + [9] * len(bad))
    rows = whitening.whiten(df, components=2).collect()
    assert sorted((r.row_id or 0) for r in rows) == sorted([0, 1, 1, 2] * many)
    assert all(r.n == 4 * many and len(r.components) == 2 for r in rows)
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [[], None])).collect() == []


def test_flat_and_huge_vectors(spark):
    rows = whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).collect()
    assert all(r.deviation == 0 and r.identity_error == 0 for r in rows)
    assert all(c.whitened is None and c.explained == 0 for r in rows for c in r.components)
    rows = whitening.whiten(table(spark, [[3e38, 0.0], [-3e38, 1.0], [0.0, 2.0]])).collect()
    assert all(r.deviation is None or r.deviation >= 0 for r in rows) and len(rows) == 3
