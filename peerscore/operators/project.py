"""Projections and filters over model tables."""

from __future__ import annotations

import datetime as _dt
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscore.schemas import GROUP_ID, SNAPSHOT


def snapshot_lit(snapshot) -> Column:
    """A snapshot as a DATE literal; ``None`` means today (the job's clock)."""
    if snapshot is None:
        return F.current_date()
    if isinstance(snapshot, Column):
        return snapshot
    if isinstance(snapshot, (_dt.date, _dt.datetime)):
        return F.lit(snapshot.strftime("%Y-%m-%d")).cast("date")
    return F.lit(str(snapshot)).cast("date")


def snapshot_filter(df: DataFrame, snapshot, col: str = SNAPSHOT) -> DataFrame:
    """Rows of one snapshot date (P1); prunes partitions of a table stored by snapshot."""
    return df.where(F.col(col) == snapshot_lit(snapshot))


def snapshot_range(df: DataFrame, start=None, end=None, col: str = SNAPSHOT) -> DataFrame:
    """Rows with start <= snapshot <= end; open ends allowed."""
    if start is not None:
        df = df.where(F.col(col) >= snapshot_lit(start))
    if end is not None:
        df = df.where(F.col(col) <= snapshot_lit(end))
    return df


def group_filter(df: DataFrame, group_id, col: str = GROUP_ID) -> DataFrame:
    """Rows of one group (P2); the value is cast to the column type, never compared as text."""
    return df.where(F.col(col) == F.lit(group_id).cast(df.schema[col].dataType))


def point_lookup(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (P3): a batch of point lookups as a semi join."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Prefix every column except those in ``keep``."""
    keep = set(keep)
    return df.select([F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def family_columns(columns: Sequence[str], contains: str, exclude: Sequence[str] = (),
                   not_at_start: bool = True) -> list[str]:
    """Names containing ``contains`` (after position 0 if ``not_at_start``) and none of ``exclude`` (P5)."""
    out = []
    for c in columns:
        pos = c.find(contains)
        if pos < 0 or (not_at_start and pos == 0):
            continue
        if any(x in c for x in exclude):
            continue
        out.append(c)
    return out


def select_family(df: DataFrame, contains: str, keep: Sequence[str] = (), exclude: Sequence[str] = (),
                  not_at_start: bool = True) -> DataFrame:
    """Project ``keep`` plus the column family chosen by name pattern (P5)."""
    return df.select(*keep, *family_columns(df.columns, contains, exclude, not_at_start))


def starts_with_columns(columns: Sequence[str], prefix: str) -> list[str]:
    return [c for c in columns if c.startswith(prefix)]


def nan_to_zero(df: DataFrame) -> DataFrame:
    """NaN -> 0 in float/double columns (P6); NULL, integers and decimals untouched."""
    targets = [f for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not targets:
        return df
    zero = {t: F.lit(0.0).cast(t) for t in {f.dataType for f in targets}}
    return df.withColumns({f.name: F.when(F.isnan(f.name), zero[f.dataType]).otherwise(F.col(f.name)) for f in targets})


def groups_without_data(groups: DataFrame, base: DataFrame, snapshot=None,
                        group_key: str = "id", base_group: str = GROUP_ID) -> DataFrame:
    """Groups of the dimension with no base row at ``snapshot`` (P10); all dates if ``None``."""
    present = base if snapshot is None else snapshot_filter(base, snapshot)
    present = present.select(F.col(base_group).alias(group_key)).distinct()  # a large group is one row from here on
    return groups.join(present, group_key, "left_anti")
