"""The daily scorecard job as an incremental stream (the reference runs it once a day from a scheduler).

New rows land in the stored model, whose dated tables are partitioned by snapshot.  File
streams over all of them, triggered with ``availableNow``, pick up exactly the files
not processed before (progress lives in the stream checkpoint); each micro-batch ranks the
snapshots that got new files in any table — base rows, or features that arrive after them —
against the stored model and upserts the result into the ranking table, replacing only
those snapshot partitions.  Re-running with no new files does nothing, and a batch that
is re-run after a failure rewrites the same partitions with the same rows (the
upsert is idempotent), so the sink is effectively exactly-once.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscore.plans.scorecard import rank_and_store
from peerscore.schemas import MODEL_TABLES, SNAPSHOT, table_schema
from peerscore.session import stored
from peerscore.sources.tables import read_model


def rank_batch(spark: SparkSession, batch: DataFrame, model_root: str, ranking_path: str):
    """Rank the snapshots present in ``batch`` and upsert them into ``ranking_path``."""
    days = stored(batch.select(SNAPSHOT).where(F.col(SNAPSHOT).isNotNull()).distinct())
    bounds = days.agg(F.min(SNAPSHOT).alias("lo"), F.max(SNAPSHOT).alias("hi")).first()
    if bounds is None or bounds.lo is None:
        return
    model = dict(read_model(spark, model_root))
    # only the dates of this batch (a snapshot filter range plus a semi join on the batch's dates)
    model["subject"] = model["subject"].join(days, SNAPSHOT, "left_semi")
    rank_and_store(spark, model, ranking_path, bounds.lo, bounds.hi)


def arrivals(spark: SparkSession, model_root: str) -> DataFrame:
    """The snapshots of new files in any dated table of the stored model."""
    streams = []
    for name in MODEL_TABLES:
        schema = table_schema(name)
        if SNAPSHOT in schema.names:
            folder = os.path.join(model_root, name)
            streams.append(spark.readStream.schema(schema).option("basePath", folder).parquet(folder).select(SNAPSHOT))
    return reduce(DataFrame.unionByName, streams)


def run_daily(spark: SparkSession, model_root: str, ranking_path: str, checkpoint: str) -> None:
    """Process every snapshot that arrived since the last run, then stop (``availableNow``)."""
    query = (
        arrivals(spark, model_root)
        .writeStream.foreachBatch(lambda df, _epoch: rank_batch(spark, df, model_root, ranking_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
