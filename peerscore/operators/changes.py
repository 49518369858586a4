"""Upserts that rewrite only what changed (S3, S4), and group extremes kept up to date.

A table stored here is partitioned by its own partition columns and a bucket of its key
(``bucket=00003-of-00016``: the number of buckets is part of the value, so a stored table
names its layout).  A batch is compared with the stored rows of the partitions it meets, column
by column; rows that are equal in every column are left out, and only the partitions
that hold a new or different row are read in full and rewritten.  A repeated batch writes nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscore.operators.upsert import _file_system, _named, _same_key, dedup_last, path_exists
from peerscore.session import stored

BUCKET = "bucket"
# so many partitions of a batch are named in the filter of the stored table; with more, a semi join finds them
NAMED_PARTITIONS = 2000


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with the bucket label of its key; a NULL key part is a value."""
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    return df.withColumn(BUCKET, F.format_string("%05d-of-%05d", number, F.lit(buckets)))


def stored_buckets(table: DataFrame) -> int | None:
    """The number of buckets a stored table was written with; ``None`` for an empty one."""
    row = table.select(BUCKET).first()
    return int(row[0].rsplit("-", 1)[1]) if row else None


def changed_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` (one per key) that ``target`` lacks or holds with another value in any column.

    NULL equals NULL, in keys and in values; NaN equals NaN.
    """
    rest = [c for c in batch.columns if c not in keys]
    old = _named(target.select(*batch.columns)).withColumn("__ch_hit", F.lit(True))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__up_k_{c}")) for c in rest], F.lit(True))
    joined = batch.join(old, _same_key(batch, list(keys)), "left")
    return joined.where(F.col("__ch_hit").isNull() | ~same).select(*batch.columns)


def partitions_of(table: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows of ``table`` in the partitions listed by ``parts`` (stored, one row a partition).

    Up to ``NAMED_PARTITIONS`` partitions become a filter that prunes the stored folders.
    A NULL partition value is a value.
    """
    cols = parts.columns
    few = parts.limit(NAMED_PARTITIONS + 1).collect()
    if len(few) <= NAMED_PARTITIONS:
        named = [reduce(and_, [F.col(c).eqNullSafe(F.lit(r[c])) for c in cols]) for r in few]
        return table.where(reduce(or_, named, F.lit(False)))
    return table.join(_named(parts), _same_key(table, cols), "left_semi")


def write_partitions(spark, rows: DataFrame, path: str, cols: Sequence[str], touched: DataFrame) -> None:
    """Replace the partitions listed in ``touched`` by ``rows``; one that has no row left is removed."""
    frozen = stored(rows)
    w = frozen.repartition(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.partitionBy(*cols).parquet(path)
    left = frozen.select(*cols).distinct()
    empty = touched.join(_named(left), _same_key(touched, list(cols)), "left_anti")
    fs, p = _file_system(spark, path)
    for r in empty.toLocalIterator():
        folder = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if r[c] is None else r[c]}" for c in cols)
        fs.delete(p(f"{path.rstrip('/')}/{folder}"), True)


def read_bucketed(spark, path: str, like: DataFrame) -> DataFrame:
    """The stored table with the column types of ``like``; the bucket stays as a column."""
    return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in like.schema.fields], BUCKET)


def upsert_changed(spark, path: str, source: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = (),
                   partition_cols: Sequence[str] = (), buckets: int = 16, columns: Sequence[str] | None = None) -> DataFrame:
    """Upsert ``source`` into the bucketed table at ``path``; returns the rows that were new or different.

    The last batch row of a key wins, by ``order_by``.  ``keys`` must name the partition columns, since a key
    lives in one partition.  ``columns`` are the stored ones (default: all of ``source``).  A stored
    table keeps the number of buckets it was created with.  An empty batch, or one that repeats stored rows, writes nothing.
    """
    keys, cols = list(keys), [*partition_cols, BUCKET]
    if not set(partition_cols) <= set(keys):
        raise ValueError("the partition columns must be part of the key")
    columns = list(columns or source.columns)
    order_names = [f"__up_ord{i}" for i in range(len(order_by))]
    src = source.select(*columns, *[(F.col(o) if isinstance(o, str) else o).alias(n) for o, n in zip(order_by, order_names)])
    batch = dedup_last(src, keys, order_names).select(*columns)
    table = read_bucketed(spark, path, batch) if path_exists(spark, path) else None
    buckets = (stored_buckets(table) if table is not None else None) or buckets
    batch = stored(with_bucket(batch, keys, buckets))
    if table is None:
        changed = batch
    else:
        met = partitions_of(table, stored(batch.select(*cols).distinct()))
        changed = stored(changed_rows(met, batch, [*keys, BUCKET]))
    touched = stored(changed.select(*cols).distinct())
    if not touched.isEmpty():
        rows = changed
        if table is not None:
            old = partitions_of(table, touched)
            rows = old.join(_named(changed.select(*keys)), _same_key(old, keys), "left_anti").unionByName(changed)
        write_partitions(spark, rows, path, cols, touched)
    return changed.drop(BUCKET)


# ---------- group extremes ----------

def extremes_state(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """One row a group: its row count ``n`` and ``min_<c>`` / ``max_<c>`` of every column; a NULL group is a group."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(*group_cols).agg(*aggs)


def merge_extremes(state: DataFrame, added: DataFrame, removed: DataFrame, current: DataFrame,
                   cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """``state`` after ``removed`` rows left and ``added`` rows came; equal to a fresh state of ``current``.

    A replaced row is in both.  The batch is aggregated before it meets the state, by a union and one
    grouping, one row a group and side.  Only groups that lost a row holding an extreme are
    aggregated again, from ``current`` (the table after the change); a group without rows goes.
    """
    keys = list(group_cols)
    gone = extremes_state(removed, cols, keys).withColumn("n", -F.col("n"))
    for c in cols:
        gone = gone.withColumnsRenamed({f"min_{c}": f"__out_min_{c}", f"max_{c}": f"__out_max_{c}"})
    sides = state.unionByName(extremes_state(added, cols, keys)).unionByName(gone, allowMissingColumns=True)
    ends = []
    for c in cols:
        for p in ("", "__out_"):
            ends += [F.min(f"{p}min_{c}").alias(f"{p}min_{c}"), F.max(f"{p}max_{c}").alias(f"{p}max_{c}")]
    merged = sides.groupBy(*keys).agg(F.sum("n").alias("n"), *ends)
    lost = [F.coalesce(F.col(f"__out_min_{c}") <= F.col(f"min_{c}"), F.lit(False))
            | F.coalesce(F.col(f"__out_max_{c}") >= F.col(f"max_{c}"), F.lit(False)) for c in cols]
    merged = stored(merged.where(F.col("n") > 0).withColumn("__lost", reduce(or_, lost, F.lit(False))))
    again = merged.where("__lost").select(*keys)
    fresh = extremes_state(current.join(_named(again), _same_key(current, keys), "left_semi"), cols, keys)
    return merged.where(~F.col("__lost")).select(*state.columns).unionByName(fresh.select(*state.columns))
