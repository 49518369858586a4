"""Table scans and sinks (S1, S2, S8, S9, S10) and storage of the model by snapshot."""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscore.schemas import MODEL_TABLES, SNAPSHOT
from peerscore.sources.splits import scan_by_predicates


def scan_table(
    spark: SparkSession,
    table: str,
    fmt: str = "parquet",
    path: str | None = None,
    columns: Sequence[str] | None = None,
    where=None,
    jdbc: dict | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    schema: T.StructType | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read a table.

    ``fmt='parquet'`` (or any file source) reads ``path``; ``fmt='jdbc'`` reads
    ``table`` through the connection options in ``jdbc`` (url, driver, user,
    password passed by the caller) and, given ``partition_column`` with bounds
    and ``num_partitions``, splits the read into parallel range queries.
    ``predicates`` (see ``splits.equal_depth_predicates``) split the read instead:
    one query, or one filtered scan, for each of them.
    ``columns`` and ``where`` are pushed to the source by the optimizer.
    """
    if fmt == "jdbc" and predicates:
        settings = dict(jdbc or {})
        df = spark.read.jdbc(settings.pop("url"), table, predicates=list(predicates), properties=settings)
    elif fmt == "jdbc":
        reader = spark.read.format("jdbc").options(**(jdbc or {})).option("dbtable", table)
        if partition_column is not None:
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", str(lower_bound))
                .option("upperBound", str(upper_bound))
                .option("numPartitions", str(num_partitions or 1))
            )
        df = reader.load()
    else:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.load(path or table)
        if predicates:
            df = scan_by_predicates(df, predicates)
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = df.select(*columns)
    return df


def save_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_cols: Sequence[str] | None = None, jdbc: dict | None = None) -> None:
    """Write a table (S2): a path for file formats, a table name for JDBC."""
    if fmt == "jdbc":
        df.write.format("jdbc").options(**(jdbc or {})).option("dbtable", target).mode(mode).save()
        return
    w = df.write.format(fmt).mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(target)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files holding one JSON array of records each (S8), read with a declared schema, one task a file.

    ``json_arrays.scan_json_array`` reads large files by one task a split.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def append_json_lines(df: DataFrame, root: str, run_date: _dt.date, date_format: str = "%d-%m-%Y") -> str:
    """Append records as JSON lines under a folder named by the run date (S9); returns the folder."""
    out = f"{root.rstrip('/')}/dt={run_date.strftime(date_format)}"
    df.write.mode("append").json(out)
    return out


def run_snapshot(cur_date: str | _dt.date | None = None) -> _dt.date:
    """The snapshot a run processes (S10): the given date or, by default, today."""
    if cur_date is None:
        return _dt.date.today()
    if isinstance(cur_date, _dt.date):
        return cur_date
    return _dt.date.fromisoformat(cur_date)


def write_model(model: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Store every dated table partitioned by snapshot (so date filters prune files)."""
    for name in MODEL_TABLES:
        df = model[name]
        if SNAPSHOT in df.columns:
            df.write.mode(mode).partitionBy(SNAPSHOT).parquet(f"{root}/{name}")
        else:
            df.write.mode(mode).parquet(f"{root}/{name}")


def read_model(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Model tables stored by ``write_model``; the snapshot column comes back as a DATE."""
    out = {}
    for name in MODEL_TABLES:
        df = spark.read.parquet(f"{root}/{name}")
        if SNAPSHOT in df.columns:
            df = df.withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
        out[name] = df
    return out


SUBJECT_SIDE = ["subject", "subject_risk", "subject_growth", "subject_credit", "subject_portfolio"]


def _subject_key(name: str) -> str:
    return "id" if name == "subject" else "subject_id"


def write_model_bucketed(spark: SparkSession, model: dict[str, DataFrame], root: str, buckets: int,
                         database: str = "peerscore_model") -> None:
    """Store the subject-side tables bucketed on (subject, snapshot) so their joins need no shuffle.

    Each bucket file is sorted by snapshot, so a date filter still skips row groups
    (the min/max statistics of a sorted column); group-side tables are small and
    stay partitioned by snapshot.  Table definitions go to the session catalog
    (a metastore on a cluster); ``read_model_bucketed`` re-registers them if absent.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in MODEL_TABLES:
        df = model[name]
        if name in SUBJECT_SIDE:
            key = _subject_key(name)
            (df.write.mode("overwrite").format("parquet").bucketBy(buckets, key, SNAPSHOT).sortBy(SNAPSHOT, key)
             .option("path", f"{root}/{name}").saveAsTable(f"{database}.{name}"))
        elif SNAPSHOT in df.columns:
            df.write.mode("overwrite").partitionBy(SNAPSHOT).parquet(f"{root}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{root}/{name}")


def read_model_bucketed(spark: SparkSession, root: str, buckets: int,
                        database: str = "peerscore_model") -> dict[str, DataFrame]:
    """The model written by ``write_model_bucketed``; subject-side tables come back bucketed."""
    from peerscore.schemas import table_schema

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out = {}
    for name in MODEL_TABLES:
        if name in SUBJECT_SIDE:
            if not spark.catalog.tableExists(f"{database}.{name}"):
                cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(name).fields)
                key = _subject_key(name)
                spark.sql(
                    f"CREATE TABLE {database}.{name} ({cols}) USING parquet "
                    f"CLUSTERED BY ({key}, {SNAPSHOT}) SORTED BY ({SNAPSHOT}, {key}) INTO {buckets} BUCKETS "
                    f"LOCATION '{root}/{name}'"
                )
            out[name] = spark.table(f"{database}.{name}")
        else:
            df = spark.read.parquet(f"{root}/{name}")
            if SNAPSHOT in df.columns:
                df = df.withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
            out[name] = df
    return out
