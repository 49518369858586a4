import numpy as np
import pytest
from pyspark.sql import functions as F

from peerscore.llm import whitening
from peerscore.llm.whitening import leading_eigenpairs, minres, whiten


def plain(x, k):
    """Eigenvalues, vectors and whitened rows by a dense decomposition."""
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (n * fit - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, s, e, u, float((c * c).sum() / n)


@pytest.fixture()
def table_of(spark):
    def make(rows, **extra):
        return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, x string").repartition(3)

    return make


def test_minres_solves_each_column_with_its_own_operator():
    r = np.random.default_rng(3)
    a, shift = r.normal(size=(12, 12)), np.array([0.0, 30.0, -3.0])
    a, b = a + a.T, r.normal(size=(12, 3))
    x = minres(lambda z: a @ z - z * shift, b, 14)
    for j in range(3):
        assert np.allclose((a - shift[j] * np.eye(12)) @ x[:, j], b[:, j], atol=1e-6)
    assert not minres(lambda z: a @ z, np.zeros((12, 2)), 3).any()


@pytest.mark.parametrize("dim,k,rows", [(1, 3, 9), (5, 16, 40), (40, 16, 300), (300, 6, 900)])
def test_eigenpairs_reach_double_precision(dim, k, rows):
    x = np.random.default_rng(dim).normal(size=(rows, dim)) * np.exp(-np.arange(dim) / 60)
    a = x.T @ x
    e, u = leading_eigenpairs(lambda c: a @ c, dim, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    assert len(e) == min(dim, k) and np.allclose(e, want, rtol=0, atol=1e-12 * want[0])
    assert np.linalg.norm(a @ u - u * e, axis=0).max() < 1e-12 * want[0]
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12


def test_equal_eigenvalues_are_all_found():
    a = np.diag([7.0] * 5 + [3.0] * 5 + [1.0] * 30)
    e, u = leading_eigenpairs(lambda c: a @ c, 40, 8)
    assert np.allclose(e, [7] * 5 + [3] * 3) and np.abs(u.T @ u - np.eye(8)).max() < 1e-12


def test_whiten_equals_the_dense_decomposition(table_of):
    r = np.random.default_rng(5)
    v = (r.normal(size=(300, 24)) * np.linspace(1, 0.2, 24)).astype(np.float32)
    rows = [(k, x.tolist()) for k, x in enumerate(v)] + [(900 + k, v[k % 7].tolist()) for k in range(60)]  # copies count once
    rows += [(None, v[3].tolist()), (5, v[9].tolist()), (800, None), (801, [1.0] * 23 + [None]), (802, [float("nan")] + [0.0] * 23), (803, [float("inf")] + [0.0] * 23)]
    got = whiten(table_of(rows)).toPandas()
    good = [(i, x) for i, x in rows if x is not None and None not in x and np.isfinite(x).all()]
    x = np.floor(64 * np.array([x for _, x in good], np.float64)).astype(np.int64) + 1_000_000
    n, s, e, u, trace = plain(x, 16)
    assert len(got) == 16 * len(good) and set(got["n"]) == {n} == {300}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
    shares = got.groupby("component")["explained"].agg(["min", "max"])
    assert np.allclose(shares["min"], e / trace, rtol=1e-9) and (shares["min"] == shares["max"]).all()
    want = ((n * x - s) / n) @ u / np.sqrt(e)
    wanted_deviation = sorted(zip([-1 if i is None else i for i, _ in good], ((n * x - s) ** 2).sum(axis=1).tolist()))
    one = got[got["component"] == 1]
    assert sorted(zip(one["vec_id"].fillna(-1).astype(int), one["deviation"])) == wanted_deviation
    for c in range(16):
        mine = np.sort(got[got["component"] == c + 1]["whitened"].to_numpy())
        assert min(np.abs(mine - np.sort(sign * want[:, c])).max() for sign in (1, -1)) < 1e-7
    by_id = got[got["vec_id"] == 17].sort_values("component")["whitened"].to_numpy()
    assert np.allclose(np.abs(by_id), np.abs(want[17]), atol=1e-8)


def test_few_distinct_rows_give_only_components_with_variance(table_of):
    rows = [(k, [float(k % 3), 1.0, 2.0, float(k % 3 == 0)]) for k in range(90)]
    got = whiten(table_of(rows))
    assert {r["component"] for r in got.collect()} == {1, 2} and {r["n"] for r in got.collect()} == {3}


def test_odd_tables(table_of, spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whiten(table_of([])).columns == names and whiten(table_of([])).count() == 0
    assert whiten(table_of([(1, None), (2, []), (3, [None])])).count() == 0
    assert whiten(table_of([(1, [1.0, 2.0])] * 9)).count() == 0  # one distinct vector has no variance
    mixed = [(k, [float(k), float(k * k % 7)]) for k in range(20)] + [(100 + k, [float(k), 0.5, float(k % 3)]) for k in range(10)]
    by_dim = {r["n"]: r["c"] for r in whiten(table_of(mixed)).groupBy("n").agg(F.count("*").alias("c")).collect()}
    assert by_dim == {20: 40, 10: 20}  # each length for itself; a constant dimension has no component


def test_long_differences_stay_exact():
    x = np.array([[1 << 40, 3], [5, -(1 << 41)]])
    sums = np.array([(1 << 62) + 11, -7], object)
    assert whitening.squared_length(whitening.differences(x, 1 << 30, sums)) == [
        ((1 << 70) - (1 << 62) - 11) ** 2 + (3 * (1 << 30) + 7) ** 2, (5 * (1 << 30) - (1 << 62) - 11) ** 2 + (-(1 << 71) + 7) ** 2]
    small = whitening.differences(np.array([[4, 9]]), 3, np.array([10, 30], object))
    assert small.tolist() == [[2, -3]] and whitening.squared_length(small) == [13]


def test_blocks_hold_every_row_once():
    import pyarrow as pa

    x = np.arange(3 * 5000).reshape(-1, 3)
    batches = [pa.RecordBatch.from_arrays([pa.array(x[a : a + 777].tolist(), pa.list_(pa.int64()))], names=["x"]) for a in range(0, 5000, 777)]
    blocks = [b for b in whitening._blocks(iter(batches), 3)]
    sizes = [b.column("n")[0].as_py() for b in blocks]
    back = np.concatenate([np.frombuffer(b.column("data")[0].as_py(), "<i8") for b in blocks]).reshape(-1, 3)
    assert (back == x).all() and max(sizes) <= whitening.BLOCK_ROWS
