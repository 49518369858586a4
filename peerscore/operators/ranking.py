"""In-group dense ranks, in one physical shape for every type and group size.

All ranks of a call are computed together:

1. The rows are stored once (reliable checkpoint) with a row id, and the ranked columns go to a long
   form: (row id, group keys, rank number, value), one typed value column per data type.
2. The distinct (rank, group, value) triples, reduced before the shuffle, are range-partitioned on
   exactly that order, so any group, however large, spreads over as many partitions as it needs and
   equal values never part. They are sorted and numbered inside each partition and stored once.
3. A value's rank is its number inside its partition and group, plus the counts of the group's
   earlier partitions (one row per group and partition).
4. Ranks go back by a join on (rank, group, value) between two shuffled sides, so adaptive execution
   splits a value that many rows share, and (for several columns) by the row id.

NULL is a value, as in a window: last of a descending rank, first (rank 1, shifting the others) of an
ascending one. A NULL group is a group. NaN is the largest number. Ranks are bigint.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscore.session import stored, stored_table

ROW_ID = "__rk_row"
_NAME, _AT, _PART, _HASH = "__rk_name", "__rk_at", "__rk_part", "__rk_hash"


@dataclass(frozen=True)
class RankSpec:
    """``out`` = dense rank of ``value`` inside the group; 1 = highest if ``descending``."""

    value: str
    out: str
    descending: bool


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    never_null = (_NAME, _PART, _HASH)  # plain equality joins on one expression a key instead of two
    pairs = [(k, left[k], right[f"__rt_{k}"]) for k in keys]
    return reduce(and_, [a == b if k in never_null else a.eqNullSafe(b) for k, a, b in pairs])


def _hashed_alike(kind: T.DataType) -> bool:
    """True if equal values of the type have equal hashes (0.0 and -0.0, and all NaN, do; collated text may not)."""
    if isinstance(kind, T.StructType):
        return all(_hashed_alike(f.dataType) for f in kind.fields)
    return kind == T.StringType() or isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys of ``left`` stay.

    A hash of the keys is the first join key: rows then sort by one number that nearly always decides, where
    the keys themselves (a rank's number, the group) mostly tie.  The keys are still compared.
    """
    names = [k for k in keys if _hashed_alike(left.schema[k].dataType) and left.schema[k].dataType == right.schema[k].dataType]
    if names:
        left, right = (df.withColumn(_HASH, F.xxhash64(*names)) for df in (left, right))
        keys = [_HASH, *keys]
    r = right.select([F.col(c).alias(f"__rt_{c}") if c in keys else F.col(c) for c in right.columns])
    return left.join(r, _same(left, r, keys), how).drop(_HASH, *[f"__rt_{k}" for k in keys])


def dense_rank_table(long: DataFrame, keys: Sequence[str], values: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Ascending and descending dense rank of every distinct (keys, values) row.

    Columns: ``keys``, ``values``, ``__rk_up`` and ``__rk_down``. Rows are ordered by ``values``
    inside ``keys``, NULL first when ascending.
    """
    keys, values = list(keys), list(values)
    distinct = long.select(*keys, *values).distinct()
    order = [F.col(c).asc_nulls_first() for c in keys + values]
    n = partitions or int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = distinct.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # consecutive numbers inside a partition, with the partition's number in the upper bits
    placed = stored(placed.withColumn(_AT, F.monotonically_increasing_id()).withColumn(_PART, F.spark_partition_id()))
    # stored, so that its size is known: few groups are broadcast and the values stay where they are, many are shuffled
    parts = stored_table(placed.groupBy(*keys, _PART).agg(F.min(_AT).alias("__rk_first"), F.count(F.lit(1)).alias("__rk_n")))
    group = Window.partitionBy(*keys)
    before = F.sum("__rk_n").over(group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumns({"__rk_before": F.coalesce(before, F.lit(0)), "__rk_total": F.sum("__rk_n").over(group)})
    up = F.col(_AT) - F.col("__rk_first") + F.col("__rk_before") + F.lit(1)
    ranked = _join_null_safe(placed, parts.drop("__rk_n"), [*keys, _PART])
    return ranked.select(*keys, *values, up.alias("__rk_up"), (F.col("__rk_total") - up + F.lit(1)).alias("__rk_down"))


def ranks_by_row(rows: DataFrame, row_id: str, specs: Sequence[RankSpec], group_cols: Sequence[str],
                 partitions: int | None = None) -> DataFrame:
    """``row_id`` and one dense-rank column per spec.  ``rows`` is read twice: pass a stored frame."""
    types = list(dict.fromkeys(rows.schema[s.value].dataType.simpleString() for s in specs))
    value_of = {t: f"__rk_v{i}" for i, t in enumerate(types)}

    def entry(i: int, s: RankSpec) -> Column:
        own = rows.schema[s.value].dataType.simpleString()
        typed = [(F.col(s.value) if t == own else F.lit(None).cast(t)).alias(c) for t, c in value_of.items()]
        return F.struct(F.lit(i).alias(_NAME), *typed)

    group = {g: f"__rk_g{i}" for i, g in enumerate(group_cols)}
    long = rows.select(row_id, *[F.col(g).alias(a) for g, a in group.items()], F.inline(F.array(*[entry(i, s) for i, s in enumerate(specs)])))
    keys, values = [_NAME, *group.values()], list(value_of.values())
    ranked = _join_null_safe(long, dense_rank_table(long, keys, values, partitions), [*keys, *values])
    down = [i for i, s in enumerate(specs) if s.descending]
    rank = F.when(F.col(_NAME).isin(down), F.col("__rk_down")).otherwise(F.col("__rk_up")) if down else F.col("__rk_up")
    # a row's ranks lie in as many partitions: nothing combines before the shuffle, so narrow rows are shuffled as they are
    ranked = ranked.select(row_id, _NAME, rank.alias("__rk_rank")).repartition(row_id)
    return ranked.groupBy(row_id).agg(*[F.max(F.when(F.col(_NAME) == i, F.col("__rk_rank"))).alias(s.out) for i, s in enumerate(specs)])


def with_row_id(df: DataFrame) -> DataFrame:
    """``df`` stored once with a row id that later uses find unchanged."""
    return stored(df.withColumn(ROW_ID, F.monotonically_increasing_id()))


def add_dense_ranks(df: DataFrame, specs: Sequence[RankSpec], group_cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Add one dense-rank column per spec, inside ``group_cols`` (none: over the whole frame)."""
    if len({s.value for s in specs}) == 1:  # one column: its table is joined on the value, without row ids
        rows, keys, value = stored(df), list(group_cols), specs[0].value
        table = dense_rank_table(rows.withColumn(_NAME, F.lit(0)), [_NAME, *keys], [value], partitions).drop(_NAME)
        ranks = [F.col("__rk_down" if s.descending else "__rk_up").alias(s.out) for s in specs]
        return _join_null_safe(rows, table, [*keys, value]).select(*df.columns, *ranks)
    rows = with_row_id(df)
    ranks = ranks_by_row(rows, ROW_ID, specs, group_cols, partitions)
    return rows.join(ranks, ROW_ID).select(*df.columns, *[s.out for s in specs])


def rank_desc(df: DataFrame, value: str, out: str, group_cols: Sequence[str]) -> DataFrame:
    """Higher is better: the largest value gets rank 1, NULL the last."""
    return add_dense_ranks(df, [RankSpec(value, out, True)], group_cols)


def rank_asc(df: DataFrame, value: str, out: str, group_cols: Sequence[str]) -> DataFrame:
    """Lower is better: the smallest value gets rank 1, a NULL comes before it."""
    return add_dense_ranks(df, [RankSpec(value, out, False)], group_cols)


def rank_global(df: DataFrame, value: str, out: str, descending: bool = True) -> DataFrame:
    """Dense rank over the whole frame without an unpartitioned window."""
    return add_dense_ranks(df, [RankSpec(value, out, descending)], [])


def top_k_values(df: DataFrame, value: str, k: int, group_cols: Sequence[str], descending: bool = True, salts: int = 32) -> DataFrame:
    """Rows that hold one of the ``k`` best distinct values of their group, ties included, without ranking the others (O3).

    Two bounded selections: inside (group, salt) the rows beyond the ``k`` best values are dropped, before the
    exchange too (the filter on the rank becomes a group limit there), so of each group at most ``k``
    values a salt and input partition are shuffled, and no task holds a group.  The ``k``-th value of what is left of
    a group is its limit; the rows that reach it are found by a join with these limits, one row a
    group.  NULL values rank last, as in :func:`rank_desc`, or first (:func:`rank_asc`); NULL groups are groups.
    """
    keys = list(group_cols)
    best = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts))
    few = df.select(*keys, value).withColumn("__tk_salt", salt)
    few = few.withColumn("__tk_rank", F.dense_rank().over(Window.partitionBy(*keys, "__tk_salt").orderBy(best)))
    few = few.where(F.col("__tk_rank") <= k).select(*keys, value).distinct()
    few = few.withColumn("__tk_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(best))).where(F.col("__tk_rank") <= k)
    limits = few.select(*keys, value)  # at most k rows a group
    return _join_null_safe(df, limits, [*keys, value]).select(*df.columns)


def top_k_per_group(df: DataFrame, rank_col: str, k: int) -> DataFrame:
    """Rows whose in-group rank is at most ``k`` (O3); the rank is a stored column, so this is a plain filter."""
    return df.where(F.col(rank_col) <= k)
