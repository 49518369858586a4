import numpy as np
import pytest
from pyspark.sql import functions as F

from peerscore.llm import ann, mips, vectors


@pytest.fixture()
def make_vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], "vec_id long, embedding array<float>, score double, rank int").repartition(3)

    return make


def sample(n, dim=16, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    x[n // 2 : n // 2 + 30] = x[3]  # copies
    return [(i, v.tolist()) for i, v in enumerate(x)]


ODD = [
    (9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] + [1.0] * 15), (9004, [float("inf")] + [1.0] * 15),
    (9005, [None] + [1.0] * 15), (None, [1.0] * 16), (9006, [1.0, 2.0]), (9010, [3.0, 4.0]),
]


def plain(rows, zero):
    """Usable rows by vector length."""
    out = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and (zero or any(v)):
            out.setdefault(len(v), {})[i] = np.array(v, np.float32).astype(float)
    return out


def brute_distance(rows, k, every):
    out = {}
    for by_id in plain(rows, False).values():
        ids = np.array(sorted(by_id))
        x = np.stack([by_id[i] for i in ids])
        for q in ids[ids % every == 0]:
            d = np.sqrt(((x - by_id[q]) ** 2).sum(axis=1))
            order = [o for o in np.lexsort((ids, d)) if ids[o] != q][:k]
            out[int(q)] = [(int(ids[o]), d[o]) for o in order]
    return out


def collect(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("rows_per_block", [8192, 150])
def test_recall_and_exact_scores(make_vectors, monkeypatch, rows_per_block):
    monkeypatch.setattr(vectors, "CANDIDATE_ROWS", rows_per_block)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 10)
    rows = sample(600) + ODD + [(5, sample(600)[5][1])]
    got = collect(ann.nearest_neighbours(make_vectors(rows), F.col("vec_id") % 10 == 0))
    want = brute_distance(rows, 10, 10)
    assert got.keys() == {q for q, w in want.items() if w}
    hits = total = 0
    for q, w in want.items():
        truth = dict(w)
        assert len(got.get(q, [])) == len(w)
        hits += sum(i in truth for i, _ in got.get(q, []))
        total += len(w)
        assert [s for _, s in got.get(q, [])] == sorted(s for _, s in got.get(q, []))
        assert all(i not in truth or np.isclose(s, truth[i], rtol=1e-12, atol=0) for i, s in got.get(q, []))
    assert hits / total >= 0.95


def test_copies_and_ties_go_to_the_smaller_id(make_vectors):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(100, [0.0, 5.0])]
    got = collect(ann.nearest_neighbours(make_vectors(rows), F.col("vec_id") == 10))
    assert got[10] == [(i, 0.0) for i in range(10)]


def brute_products(rows, k, every):
    out = {}
    for by_id in plain(rows, True).values():
        ids = np.array(sorted(by_id))
        x = np.floor(64 * np.stack([by_id[i] for i in ids])).astype(np.int64)
        for q in np.flatnonzero(ids % every == 0):
            s = x @ x[q]
            order = [o for o in np.lexsort((ids, -s)) if o != q][:k]
            out[int(ids[q])] = [(int(ids[o]), int(s[o])) for o in order]
    return out


@pytest.mark.parametrize("slab,seeds,per_block", [(1024, 512, 8192), (16, 40, 150), (16, 0, 8192)])
def test_products_are_exact(make_vectors, monkeypatch, slab, seeds, per_block):
    monkeypatch.setattr(mips, "SLAB", slab)
    monkeypatch.setattr(mips, "SEEDS", max(seeds, 1))
    monkeypatch.setattr(vectors, "CANDIDATE_ROWS", per_block)
    rng = np.random.default_rng(4)
    rows = [(i, (np.array(v) * rng.choice([0.1, 1, 3])).tolist()) for i, v in sample(500)] + ODD
    got = collect(mips.top_inner_products(make_vectors(rows), F.col("vec_id") % 20 == 0))
    assert got == {q: w for q, w in brute_products(rows, 20, 20).items() if w}


def test_ids_that_carry_several_vectors_count_once(make_vectors, monkeypatch):
    monkeypatch.setattr(mips, "SEEDS", 64)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(100)]
    rows += [(i, (3 * rng.normal(size=6) + 4).tolist()) for i in range(60)]  # longer ones for the same ids
    table = make_vectors(rows)
    rows = [(i, min(v for k, v in rows if k == i)) for i in range(100)]  # the smallest vector counts
    got = collect(mips.top_inner_products(table, F.col("vec_id") % 20 == 0))
    assert got == brute_products(rows, 20, 20) and all(len(w) == 20 for w in got.values())
    near = collect(ann.nearest_neighbours(table, F.col("vec_id") % 10 == 0))
    want = brute_distance(rows, 10, 10)
    assert {q: len(w) for q, w in near.items()} == {q: len(w) for q, w in want.items()}
    assert sum(i in dict(want[q]) for q, w in near.items() for i, _ in w) >= 0.95 * sum(map(len, want.values()))


def test_slabs_are_pruned():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 8)) * np.geomspace(100, 0.01, 4000)[:, None]
    x = np.floor(x)
    seen = []
    real = np.nonzero

    def counted(mask):
        seen.append(mask.shape)
        return real(mask)

    try:
        np.nonzero = counted
        mips.top_products(np.array([-1]), x[:1], np.arange(4000), x, np.eye(8), np.array([-np.inf]), 5, 2)
    finally:
        np.nonzero = real
    assert len(seen) < 4


def test_empty_tables(make_vectors):
    none = make_vectors([])
    assert ann.nearest_neighbours(none, F.col("vec_id") % 100 == 0).count() == 0
    assert mips.top_inner_products(none, F.col("vec_id") % 20 == 0).count() == 0
    only = make_vectors([(0, [1.0, 2.0])])
    assert ann.nearest_neighbours(only, F.col("vec_id") == 0).count() == 0
    assert mips.top_inner_products(only, F.col("vec_id") == 0).count() == 0
