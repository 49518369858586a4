"""Exact top-k inner products over norm-sorted vectors (operator 10).

Vectors are rotated by the right singular vectors of all of them (from the summed Gram matrix), so
the first coordinates carry most of every inner product. In a block, vectors are taken by descending
length, ``SLAB`` at a time. A query skips a slab, and all after it, when the product of lengths
cannot reach its current k-th score; inside a slab, the partial sum over the first ``head`` rotated
coordinates plus the product of the residual lengths (Cauchy-Schwarz) bounds each score, and only
vectors whose bound reaches the k-th score are multiplied in full, in integers. All blocks start
from the k-th score among the ``SEEDS`` longest vectors, so they prune from the first slab on.

Components become ``floor(scale * x)``. Nulls and odd rows: vectors that are NULL, empty or hold NULL
or non-finite components take no part, as do NULL ids; zero vectors do take part. Vectors meet only
vectors of their own length. Rows that repeat an id count once (the smallest vector). Equal scores go
to the smaller id. An empty table gives no rows. Scores must fit a 64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscore.llm.vectors import ranked, search_blocks, usable

SLAB = 1024
SEEDS = 512


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length: right singular vectors (columns, strongest first) of all vectors of that length."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            by_length: dict[int, list] = {}
            for v in b.column("vector").to_numpy(zero_copy_only=False):
                by_length.setdefault(len(v), []).append(v)
            for d, vs in by_length.items():
                x = np.stack(vs)
                total[d] = total.get(d, 0) + x.T @ x
        for d, g in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d, np.int32)), pa.array(np.arange(d * d, dtype=np.int32)), pa.array(g.reshape(-1))], names=["dim", "cell", "part"])

    cells = vectors.select("vector").mapInArrow(gram, "dim int, cell int, part double").groupBy("dim", "cell").agg(F.sum("part").alias("total"))
    grams: dict[int, np.ndarray] = {}
    for r in cells.collect():  # the square of the vector length in numbers, whatever the table's size
        grams.setdefault(r["dim"], np.zeros(r["dim"] ** 2))[r["cell"]] = r["total"]
    return {d: np.linalg.eigh(g.reshape(d, d))[1][:, ::-1].copy() for d, g in grams.items()}


def _best(found: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    score, ids = (np.concatenate(c) for c in zip(*found, strict=True))
    top = np.lexsort((ids, -score))[:k]
    return score[top], ids[top]


def top_products(
    query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, rotation: np.ndarray, floor: np.ndarray, k: int, head: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query: scores and ids of its ``k`` best rows of ``x``, without rows that score below ``floor``."""
    length = np.sqrt((x * x).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    x, ids, length = x[order], ids[order], length[order]
    rx, rq = x @ rotation, q @ rotation
    q_length = np.sqrt((q * q).sum(axis=1))
    x_rest, q_rest = (np.sqrt((r[:, head:] ** 2).sum(axis=1)) for r in (rx, rq))
    xi, qi = x.astype(np.int64), q.astype(np.int64)
    kth = floor.astype(np.float64)
    best = [(np.zeros(0, np.int64), np.zeros(0, ids.dtype)) for _ in query_ids]
    active = np.arange(len(q))
    for at in range(0, len(x), SLAB):
        slack = 1e-9 * (1 + q_length * length[at])  # rounding of the rotated sums
        active = active[(q_length * length[at] + slack)[active] >= kth[active]]
        if not len(active):
            break
        end = min(at + SLAB, len(x))
        bound = rq[active, :head] @ rx[at:end, :head].T + np.outer(q_rest[active], x_rest[at:end])
        row, col = np.nonzero((bound + slack[active][:, None] >= kth[active][:, None]) & (query_ids[active][:, None] != ids[at:end][None, :]))
        cuts = np.searchsorted(row, np.arange(len(active) + 1))
        for r, a in enumerate(active.tolist()):
            mine = at + col[cuts[r] : cuts[r + 1]]
            if len(mine):
                best[a] = _best([best[a], (xi[mine] @ qi[a], ids[mine])], k)
                if len(best[a][0]) == k:
                    kth[a] = max(kth[a], best[a][0][-1])
    return best


def top_inner_products(
    vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, k: int = 20, head: int = 16
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (integer inner product) for every row that ``queries`` selects."""
    rows = vectors.where(F.col(id_col).isNotNull() & usable(vector_col, zero=True)).select(
        F.col(id_col).alias("vec_id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("vector")
    )
    rotation = rotations(rows)
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    longest = rows.select("vec_id", "vector").orderBy(length.desc(), "vec_id").limit(SEEDS).select("vec_id").distinct()
    # a repeated id counts with its smallest vector here as in the blocks, so all rows of these ids are read
    own = rows.join(F.broadcast(longest), "vec_id", "left_semi").groupBy("vec_id", F.size("vector").alias("dim")).agg(F.min("vector").alias("vector"))
    seeds: dict[int, dict] = {}
    for r in own.collect():  # at most SEEDS ids
        seeds.setdefault(r["dim"], {})[r["vec_id"]] = r["vector"]
    shared = vectors.sparkSession.sparkContext.broadcast((rotation, seeds))

    def best(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> pd.DataFrame:
        rotation, seeds = shared.value
        floor = np.full(len(q), -np.inf)
        known = seeds.get(q.shape[1], {})
        if len(known) > k:  # the k-th score among some rows is a lower bound of the k-th among all
            products = np.array([*known.values()]) @ q.T
            own = np.array([*known])[:, None] == query_ids[None, :]
            floor = np.partition(np.where(own, -np.inf, products), len(known) - k, axis=0)[len(known) - k]
        out = [pd.DataFrame({"query_id": a, "vec_id": i, "score": s}) for a, (s, i) in zip(query_ids, top_products(query_ids, q, ids, x, rotation[q.shape[1]], floor, k, head), strict=True)]
        return pd.concat(out)

    return ranked(search_blocks(rows, queries, best, "long"), k, descending=True)
