"""Session helpers: a local session for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
from typing import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "peerscore") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC clock)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used for reliable checkpoints.

    Order: a checkpoint folder already set on the context, else the one named by
    ``spark.checkpoint.dir`` (what a cluster configures). Only a local master may go
    without: it gets a scratch folder. Elsewhere a missing setting is an error, since
    a machine's own folder would not be seen by the other machines.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="peerscore-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder: its lineage is cut, so later uses read it.

    Spark deletes a checkpoint when its frame is no longer used, given
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` (``local_session`` sets it).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_table(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` computed once into a compressed column store under the shared checkpoint folder.

    For wide rows that are read several times: each use reads only its columns and, with ``partition_by``, its
    folders, where a checkpoint is read whole.  Spark does not delete it; :func:`temporary_tables` does.
    """
    path = scratch_path(df.sparkSession, "table")
    if _temporary:
        _temporary[-1].append(path)
    # files of few rows: a scan packs them by size, and compressed rows that cost much work would all be one task's
    df.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


FILE_ROWS = 10_000
_temporary: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession):
    """Deletes at its end the tables that :func:`stored_table` wrote meanwhile; nothing lazy may outlive it."""
    _temporary.append([])
    try:
        yield
    finally:
        for path in _temporary.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"
