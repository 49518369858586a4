"""Key, foreign-key and completeness audits of the model.

The declared keys are not enforced on write; these operators report violations
as DataFrames.  All are aggregations or anti joins — no row is collected.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.schemas import FOREIGN_KEYS, TABLE_KEYS


def audit_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (map-side combined count)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def audit_orphans(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
                  parent_cols: Sequence[str]) -> DataFrame:
    """Child rows whose foreign key has no parent row (anti join)."""
    p = parent.select(*[F.col(p).alias(c) for c, p in zip(child_cols, parent_cols)]).distinct()
    return child.join(p, list(child_cols), "left_anti")


def audit_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any key column."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.where(cond)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: number of NULL values — one aggregation, then a long (column, n_null) form."""
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0)).alias("n_null")) for c in cols]
    return counts.select(F.inline(F.array(*pairs)))


def audit_null_features(df: DataFrame, cols: Sequence[str], keys: Sequence[str] | None = None) -> DataFrame:
    """With ``keys``: rows with a NULL feature, plus the list of NULL columns; without: per-column counts."""
    if keys is None:
        return null_counts(df, cols)
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    return df.select(*keys, names.alias("null_columns")).where(F.size("null_columns") > 0)


def snapshot_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count per key, e.g. per (group, snapshot) (A2)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def audit_model(model: dict[str, DataFrame]) -> DataFrame:
    """The declared keys of the whole model (J7): ``table``, ``rule``, ``violations``.

    One row per table for its primary key (``duplicate key``, ``null key``) and per
    foreign key (``orphan``); NULL foreign keys refer to nothing and are not orphans.
    """
    counts = []

    def count(df: DataFrame, table: str, rule: str) -> None:
        counts.append(df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), "violations"))

    for table, keys in TABLE_KEYS.items():
        if table in model:
            rows = model[table].select(*keys)
            count(audit_duplicate_keys(rows, keys), table, "duplicate key")
            count(audit_null_keys(rows, keys), table, "null key")
    for table, (cols, parent, parent_cols) in FOREIGN_KEYS.items():
        if table in model and parent in model:
            refers = model[table].select(*cols).dropna()
            count(audit_orphans(refers, model[parent], cols, parent_cols), table, f"orphan of {parent}")
    return reduce(DataFrame.unionByName, counts)
