"""Approximate nearest neighbours by collision-counting hashing (operator 4).

Each of ``projections`` random directions keeps the vectors of a block as one array sorted by their
projection. A query opens a window around its own projection in every array and widens all windows
together (virtual rehashing: each round's half-width is ``growth`` times the last). A vector that
lies in at least ``share`` of the windows is a candidate, and its true distance is computed. A vector
at distance ``s`` projects about ``s / sqrt(dim)`` away, so a query stops once ``k`` candidates lie
within ``half-width * sqrt(dim) / margin``, or when its windows hold everything; every query returns
``k`` neighbours if there are so many.

Nulls and odd rows: vectors that are NULL, empty, zero or hold NULL or non-finite components take no
part, as do NULL ids. Vectors meet only vectors of their own length. Rows that repeat an id count once
(the smallest vector). Equal distances go to the smaller id; copies of a vector enter every window
together, so none of them is lost. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscore.llm.vectors import ranked, search_blocks, usable


class SortedProjections:
    """One sorted array a direction over the rows of ``x``."""

    def __init__(self, x: np.ndarray, projections: int) -> None:
        self.x = x
        directions = np.random.default_rng(11).normal(size=(projections, x.shape[1]))
        self.directions = directions / np.linalg.norm(directions, axis=1, keepdims=True)
        at = x @ self.directions.T
        self.order = np.argsort(at, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(at.T, self.order, axis=1)
        self.scale = float(np.median(np.abs(self.sorted - np.median(self.sorted, axis=1, keepdims=True)))) or 1.0

    def nearest(self, q: np.ndarray, skip: int, k: int, share: float, margin: float, growth: float) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and distances of about the ``k`` nearest rows (``skip``: the query's own row or -1)."""
        n, m = len(self.x), len(self.directions)
        at, need = self.directions @ q, int(np.ceil(share * m))
        hits = np.zeros(n, np.int16)
        lo = np.array([np.searchsorted(s, a) for s, a in zip(self.sorted, at, strict=True)])
        hi = lo.copy()
        half = self.scale
        rows, dist = np.zeros(0, np.int64), np.zeros(0)
        done = np.zeros(n, bool)
        if skip >= 0:
            done[skip] = True
        while True:
            for j in range(m):
                s, order = self.sorted[j], self.order[j]
                left, right = np.searchsorted(s, at[j] - half), np.searchsorted(s, at[j] + half, "right")
                hits[order[left : lo[j]]] += 1
                hits[order[hi[j] : right]] += 1
                lo[j], hi[j] = min(left, lo[j]), max(right, hi[j])
            whole = bool((lo == 0).all() and (hi == n).all())
            new = np.flatnonzero((hits >= need) & ~done)
            if len(new):
                done[new] = True
                rows = np.concatenate((rows, new))
                dist = np.concatenate((dist, np.sqrt(((self.x[new] - q) ** 2).sum(axis=1))))
            if whole or (len(rows) >= k and np.partition(dist, k - 1)[k - 1] * margin <= half * self.x.shape[1] ** 0.5):
                return rows, dist
            half *= growth


def nearest_neighbours(
    vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    projections: int = 48, share: float = 0.7, margin: float = 1.25, growth: float = 1.2,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (Euclidean distance) for every row that ``queries`` selects."""

    def best(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> pd.DataFrame:
        index = SortedProjections(x, projections)
        own = np.searchsorted(ids, query_ids).clip(0, len(ids) - 1)
        out = []
        for query, v, o in zip(query_ids, q, own, strict=True):
            rows, dist = index.nearest(v, int(o) if ids[o] == query else -1, k, share, margin, growth)
            top = np.lexsort((ids[rows], dist))[:k]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[rows[top]], "score": dist[top]}))
        return pd.concat(out)

    rows = vectors.where(F.col(id_col).isNotNull() & usable(vector_col, zero=False)).select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    return ranked(search_blocks(rows, queries, best, "double"), k, descending=False)
