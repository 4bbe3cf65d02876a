import numpy as np
import pytest
from corpus_fixtures import sf  # noqa: F401
from regpanel.llm import op11_whitening as w


def frame(spark, v, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], [float(c) for c in r], 0) for i, r in enumerate(v)],
                                 "vec_id long, embedding array<double>, component int")


def brute(v, components):
    """Whitened values, deviations and explained parts by numpy over the whole table."""
    x = np.floor(64 * np.asarray(v, dtype=np.float64)) + 1_000_000
    values, u = np.linalg.eigh(np.cov(x.T, bias=True))
    values, u = values[::-1][:components], u[:, ::-1][:, :components]
    whole = [[int(c) for c in r] for r in x]
    sums = [sum(c) for c in zip(*whole)]
    deviation = [sum((len(x) * c - s) ** 2 for c, s in zip(r, sums)) for r in whole]
    return (x - x.mean(axis=0)) @ u / np.sqrt(values), deviation, values / np.trace(np.cov(x.T, bias=True))


def check(got, v, components):
    want, deviation, explained = brute(v, components)
    got = got.sort_values(["vec_id", "component"])
    assert got.component.tolist() == list(range(1, components + 1)) * len(v)
    mine = got.whitened.to_numpy().reshape(len(v), components)
    sign = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine - want * sign).max() < 1e-7
    assert got.deviation.to_numpy().reshape(len(v), components)[:, 0].tolist() == deviation
    assert np.abs(got.explained.to_numpy().reshape(len(v), components)[0] / explained - 1).max() < 1e-9
    assert (got.n == len(v)).all() and got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) + 5
    check(w.whitened_rows(frame(spark, v).repartition(7), 8).toPandas(), v, 8)


def test_table_of_the_driver(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    v = np.array(df.toPandas().sort_values("vec_id").embedding.tolist(), dtype=np.float64)
    check(w.whitened_rows(df).toPandas(), v, 32)


@pytest.mark.parametrize("matrix", [np.eye(9), np.diag([5.0] * 4 + [2.0] * 5), np.ones((6, 6)) + np.eye(6), np.diag([3.0, 3 + 1e-13, 3 - 1e-13, 1]),
                                    np.array([[2.0]]), np.array([[2.0, 1], [1, 2]]), np.kron(np.eye(3), np.array([[2, 1, 0], [1, 2, 1], [0, 1, 2]]))])
def test_equal_and_close_eigenvalues(matrix):
    values, u = w.leading_components(matrix.astype(np.longdouble), len(matrix))
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1]).max() < 1e-13
    assert np.abs(u.T @ u - np.eye(len(matrix))).max() < 1e-13
    assert np.abs(matrix @ u - u * values).max() < 1e-13


def test_a_random_matrix_in_extended_precision():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(40, 40)).astype(np.longdouble)
    a = a + a.T
    values, u = w.leading_components(a, 25)
    assert np.abs(a @ u - u * values).max() < 1e-15 and np.abs(u.T @ u - np.eye(25)).max() < 1e-17
    assert np.allclose(values.astype(float), np.linalg.eigvalsh(a.astype(float))[::-1][:25])


def test_sturm_count():
    d, b = np.array([2.0, 2, 2, 2]), np.array([1.0, 1, 1])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(b, 1) + np.diag(b, -1))
    at = np.array([-1, 0.5, 1.5, 2.5, 5])
    assert w.sturm_count(d, b, at).tolist() == [(values < x).sum() for x in at]


def test_sums_are_exact_at_any_size(spark):
    big = 2.0 ** 43
    v = [[big, -big], [-big, 1.0], [0.25, big], [big, big]]
    got = w.whitened_rows(frame(spark, v), 2).toPandas()
    assert got.deviation.isna().all() and got.identity_error.max() < 1e-4 and len(got) == 8
    rows, width = w.integer_rows(frame(spark, v), "vec_id", "embedding")
    assert w.column_sums(rows, width) == (4, [sum(int(64 * c) + 1_000_000 if c != 0.25 else 1_000_016 for c in column) for column in zip(*v)])


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
            (6, [None, 1.0], 1), (7, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (8, [], 1), (9, [1e300, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int")
    got = w.whitened_rows(df).toPandas()
    assert sorted(got.vec_id.fillna(-1).tolist()) == sorted([0, 1, 1, 3, -1] * 2) and set(got.n) == {5}
    assert w.whitened_rows(df.limit(0)).collect() == []


def test_without_rank(spark):
    # Equal vectors have no component; three vectors on a line have one.
    assert w.whitened_rows(frame(spark, [[1.0, 2.0]] * 5)).collect() == []
    got = w.whitened_rows(frame(spark, [[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]])).toPandas()
    assert set(got.component) == {1} and got.explained.iloc[0] == pytest.approx(1.0)
