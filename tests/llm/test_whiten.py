from fractions import Fraction

import numpy as np
import pytest

from renewlens.llm import whiten


@pytest.mark.parametrize("n", [1, 2, 3, 5, 40])
def test_eigenpairs_of_random_and_clustered_matrices(n):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    for values in (rng.uniform(0, 9, n), np.repeat(3.0, n), np.concatenate(([5.0] * min(n, 2), np.zeros(n - min(n, 2)))), 1 + np.arange(n) * 1e-9, np.zeros(n)):
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        got, vectors = whiten.eigenpairs(a, 4)
        want = np.sort(values)[::-1][:4]
        assert np.allclose(got, want, atol=1e-13 * 10)
        assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-13)
        assert np.allclose(a @ vectors, vectors * got, atol=1e-12)


def test_diagonal_matrix_splits():
    got, vectors = whiten.eigenpairs(np.diag([1.0, 4.0, 4.0, 2.0, 4.0]), 4)
    assert np.allclose(got, [4, 4, 4, 2]) and np.allclose(vectors.T @ vectors, np.eye(4))


def test_deviations_are_exact():
    rng = np.random.default_rng(0)
    for high in (100, 2**25, 2**40):
        x = rng.integers(-high, high, (5, 700))
        sums = [int(v) for v in rng.integers(-(2**60), 2**60, 700)]
        n = 10**11 + 7
        assert whiten.deviations(x, n, sums) == [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]


def brute(rows, k=4):
    """Fit list and exact covariance by fractions; numpy's own eigenvalues."""
    xs = {i: [int(np.floor(256 * float(c))) for c in v] for i, v in rows.items()}
    fit = sorted(set(map(tuple, xs.values())))
    n, width = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(width)]
    mean = [Fraction(s, n) for s in sums]
    v = np.array([[float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in fit) / n) for j in range(width)] for i in range(width)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return xs, n, sums, values, vectors, np.trace(v)


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(300, 6)) * [3, 2.5, 2, 1.5, 1, 0.5] + 7).astype(np.float32)
    x[100:200] = x[100]
    x[200:230] = x[200:230].round(1) + np.float32(0.0001)
    x[5] = 200.0
    rows = [(i, v.tolist(), 1, [0.0]) for i, v in enumerate(x)]
    good = {i: v for i, v in enumerate(x)}
    rows += [(1, None, 1, None), (2, [], 1, None), (3, [None] * 6, 1, None), (4, [1.0] * 5 + [float("nan")], 1, None), (5, [float("inf")] * 6, 1, None), (6, [1.0] * 5, 1, None)]
    rows += [(None, x[0].tolist(), 1, None), (7, x[7].tolist(), 1, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, whitened array<double>")
    got = whiten.whiten(df).collect()
    xs, n, sums, values, vectors, trace = brute(good)
    assert len(got) == 302
    seen = set()
    for r in got:
        i = 0 if r.vec_id is None else r.vec_id
        seen.add(r.vec_id)
        assert r.n == n and int(r.deviation) == sum((n * v - s) ** 2 for v, s in zip(xs[i], sums))
        want = (np.array(xs[i]) - np.array(sums) / n) @ vectors / np.sqrt(values)
        assert np.allclose(np.abs(r.whitened), np.abs(want), rtol=1e-9, atol=1e-9)
        assert np.allclose(r.explained, values / trace, rtol=1e-12) and r.identity_error < 1e-9
    assert seen == {None, *range(300)}
    w = np.array([r.whitened for r in got if r.vec_id is not None])
    unit = np.array([xs[r.vec_id] for r in got if r.vec_id is not None])
    _, first = np.unique(unit, axis=0, return_index=True)
    assert np.allclose(np.cov(w[first].T, bias=True), np.eye(4), atol=1e-9)


def test_no_variance_few_dimensions_and_no_rows(spark):
    schema = "vec_id string, embedding array<double>"
    same = whiten.whiten(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, 2.0])], schema)).collect()
    assert [(r.vec_id, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in sorted(same)] == [(i, 1, 0, [None, None], [None, None], None) for i in "ab"]
    line = whiten.whiten(spark.createDataFrame([("a", [0.0, 0.0, 1e30]), ("b", [1.0, 1.0, 1e30])], schema)).collect()
    assert [[abs(round(w, 9)) if w is not None else None for w in r.whitened] for r in line] == [[1.0, None, None]] * 2
    assert line[0].explained == [1.0, 0.0, 0.0] and line[0].identity_error < 1e-9
    assert whiten.whiten(spark.createDataFrame([("a", None), ("b", [])], schema)).collect() == []


def test_query_has_a_row_a_component(spark, tmp_path):
    from renewlens.llm.queries import op12_whitening

    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 8)))] + [(99, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op12_whitening(spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(got.dtypes)["deviation"] == "bigint" and dict(got.dtypes)["component"] == "int"
    assert sorted((r.vec_id, r.component) for r in got.collect()) == [(i, c) for i in range(50) for c in (1, 2, 3, 4)]
