"""Re-rank only what a batch of changed rows can alter.

A rank, a scaled value or a group trend depends on the rows of one (group, snapshot) and on nothing
else, so changed model rows are mapped to these keys, the keys are ranked, and their rows replace the
stored ones.  The ranking is stored by snapshot and a bucket of the group; partitions without
such a key are neither read nor written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.operators.assemble import assemble_wide
from peerscore.operators.changes import (
    BUCKET,
    partitions_of,
    read_bucketed,
    stored_buckets,
    with_bucket,
    write_partitions,
)
from peerscore.operators.upsert import path_exists, with_audit
from peerscore.plans.scorecard import rank_range, rank_terms, score_terms
from peerscore.schemas import GROUP_FEATURE_TABLES, GROUP_ID, GROUP_KEYS, SNAPSHOT, SUBJECT_FEATURE_TABLES, SUBJECT_ID
from peerscore.session import stored

LAYOUT = [SNAPSHOT, BUCKET]


def affected_keys(model: dict[str, DataFrame], changes: dict[str, DataFrame], ranking: DataFrame | None = None) -> DataFrame:
    """Distinct (group, snapshot) keys whose ranking the changed rows can alter.

    ``changes`` maps a table of the model to its new, changed or removed rows (their keys suffice).  Subject
    features reach their group through the base table; with a stored ``ranking``, the group that
    a subject was ranked in before counts too, so a subject that moved or went alters both groups.  The
    dimension takes no part in a score.  Rows with a NULL snapshot or group are never ranked.
    """
    found, subjects = [], []
    for name, rows in changes.items():
        if name in GROUP_FEATURE_TABLES:
            found.append(rows.select(*GROUP_KEYS))
        elif name == "subject":
            if GROUP_ID in rows.columns:
                found.append(rows.select(*GROUP_KEYS))
            subjects.append(rows.select(F.col("id").alias(SUBJECT_ID), SNAPSHOT))
        elif name in SUBJECT_FEATURE_TABLES:
            subjects.append(rows.select(SUBJECT_ID, SNAPSHOT))
    if subjects:
        wanted = reduce(DataFrame.unionByName, subjects).distinct()
        base = model["subject"].select(F.col("id").alias(SUBJECT_ID), *GROUP_KEYS)
        for known in [base, *([ranking.select(SUBJECT_ID, *GROUP_KEYS)] if ranking is not None else [])]:
            found.append(known.join(wanted, [SUBJECT_ID, SNAPSHOT], "left_semi").select(*GROUP_KEYS))
    if not found:
        return model["subject"].select(*GROUP_KEYS).limit(0)
    return reduce(DataFrame.unionByName, found).dropna().distinct()


def rank_keys(model: dict[str, DataFrame], keys: DataFrame) -> DataFrame:
    """Ranking rows of the (group, snapshot) ``keys`` (stored) only: the same plan as a full run.

    The dates of the keys prune the stored partitions of every dated table before the keys themselves
    filter the subjects and the group tables.
    """
    days = stored(keys.select(SNAPSHOT).distinct())
    part = {n: partitions_of(df, days) if SNAPSHOT in df.columns else df for n, df in model.items()}
    for name in ["subject", *GROUP_FEATURE_TABLES]:
        part[name] = part[name].join(keys, GROUP_KEYS, "left_semi")
    return rank_terms(score_terms(assemble_wide(part, store_groups=True)))


def rank_changes_and_store(spark, model: dict[str, DataFrame], path: str, changes: dict[str, DataFrame] | None = None,
                           buckets: int = 16, clock=None) -> DataFrame:
    """Bring the ranking at ``path`` up to date after ``changes`` to the model; returns the stored table.

    Without a stored ranking, or without ``changes``, everything is ranked.  All rows of an affected key are replaced,
    also those of subjects that are gone.  ``model`` holds the changed rows already.
    """
    have = path_exists(spark, path)
    if not have or changes is None:
        ranked = with_bucket(with_audit(rank_range(model), set_added=False, clock=clock), [GROUP_ID], buckets)
        ranked.repartition(*LAYOUT).write.mode("overwrite").partitionBy(*LAYOUT).parquet(path)
        return spark.read.parquet(path).drop(BUCKET).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
    table = spark.read.parquet(path).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
    buckets = stored_buckets(table) or buckets
    keys = stored(affected_keys(model, changes, table))
    if not keys.isEmpty():
        ranked = stored(with_bucket(with_audit(rank_keys(model, keys), set_added=False, clock=clock), [GROUP_ID], buckets))
        touched = stored(with_bucket(keys, [GROUP_ID], buckets).select(*LAYOUT).distinct())
        old = partitions_of(read_bucketed(spark, path, ranked.drop(BUCKET)), touched)
        kept = old.join(keys, GROUP_KEYS, "left_anti").select(*ranked.columns)
        write_partitions(spark, kept.unionByName(ranked), path, LAYOUT, touched)
    return spark.read.parquet(path).drop(BUCKET).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
