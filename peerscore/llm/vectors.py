"""Block-wise search of a query set against all vectors, shared by the vector operators.

Vectors are dealt to candidate blocks and queries to query blocks by a hash of their id, both of
bounded size; every pair of blocks is one task. Each task returns the best rows of its block for its
queries, and a window per query merges the blocks' best.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

CANDIDATE_ROWS = 8192
QUERY_ROWS = 1024


def usable(vector: str, zero: bool) -> Column:
    """Non-NULL, non-empty vectors of finite components; the zero vector only if ``zero``."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    ok = F.col(vector).isNotNull() & (F.size(vector) > 0) & finite
    return ok if zero else ok & F.exists(vector, lambda x: x != 0)


def as_matrix(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their vectors; of rows that repeat an id the smallest vector counts."""
    ids = part["vec_id"].to_numpy()
    x = np.stack(part["vector"].to_numpy()).astype(np.float64)
    order = np.lexsort((*x.T[::-1], ids))
    ids, x = ids[order], x[order]
    first = np.concatenate(([True], ids[1:] != ids[:-1]))
    return ids[first], np.ascontiguousarray(x[first])


def blocks_of(n: int, size: int) -> int:
    return max(1, -(-n // size))


def search_blocks(
    vectors: DataFrame, queries: Column, best: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pd.DataFrame], score_type: str
) -> DataFrame:
    """Rows ``query_id, vec_id, score`` of every pair of a query block and a candidate block.

    ``vectors`` has ``vec_id`` and ``vector``; ``queries`` says which rows are queries. Vectors meet
    only vectors of their own length. ``best(query_ids, queries, ids, candidates)`` returns a
    frame of those three columns.
    """
    vectors = vectors.withColumn("dim", F.size("vector")).withColumn("is_query", queries)
    n, q = vectors.agg(F.count("*"), F.sum(F.col("is_query").cast("long"))).first()
    nb, qb = blocks_of(n, CANDIDATE_ROWS), blocks_of(q or 0, QUERY_ROWS)
    own = F.pmod(F.xxhash64("vec_id"), F.lit(nb))
    mine = F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(qb))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    columns = ["vec_id", "vector", "dim"]
    candidates = vectors.select(*columns, own.alias("block"), every(qb).alias("part"), F.lit(False).alias("asks"))
    asking = vectors.where("is_query").select(*columns, every(nb).alias("block"), mine.alias("part"), F.lit(True).alias("asks"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        asks = part["asks"].to_numpy()
        if not asks.any() or asks.all():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best(*as_matrix(part[asks]), *as_matrix(part[~asks]))

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    met = candidates.unionByName(asking).groupBy("dim", "block", "part")
    return met.applyInPandas(run, f"query_id {id_type}, vec_id {id_type}, score {score_type}")


def ranked(found: DataFrame, k: int, descending: bool) -> DataFrame:
    """The ``k`` best rows of each query with their rank; ties to the smaller id."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score") if descending else F.asc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
