"""Group min/max and min-max rescaling of feature columns."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.functions.scoring import min_max_scale


def group_min_max(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """One row per group with ``min_<c>`` and ``max_<c>`` (A3); map-side combined."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    if not group_cols:
        return df.agg(*aggs)
    return df.groupBy(*group_cols).agg(*aggs)


def with_group_min_max(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str], extremes: DataFrame | None = None) -> DataFrame:
    """Attach ``__min_<c>`` / ``__max_<c>`` of each group to every row.

    The extremes are combined before the shuffle and joined back, so no task holds a
    group. A NULL group is a group.  ``extremes`` are those of :func:`group_min_max`, if they are stored already.
    """
    stats = group_min_max(df, cols, group_cols) if extremes is None else extremes
    stats = stats.select(
        *group_cols,
        *[F.col(f"min_{c}").alias(f"__min_{c}") for c in cols],
        *[F.col(f"max_{c}").alias(f"__max_{c}") for c in cols],
    )
    if not group_cols:
        # one row of aggregates: attach it as literals instead of joining on a constant
        row = stats.first()
        return df.withColumns({c: F.lit(row[c]) for c in stats.columns})
    r = stats.select(*[F.col(c).alias(f"__jk_{c}") if c in group_cols else F.col(c) for c in stats.columns])
    cond = [df[k].eqNullSafe(r[f"__jk_{k}"]) for k in group_cols]
    return df.join(r, cond, "left").drop(*[f"__jk_{k}" for k in group_cols])


def min_max_scale_cols(
    df: DataFrame,
    cols: Sequence[str],
    lo: float,
    hi: float,
    group_cols: Sequence[str],
    prefix: str = "f_scaled_",
) -> DataFrame:
    """Add ``<prefix><c>`` = c rescaled to [lo, hi] inside its group."""
    return tiered_scale(df, [(cols, (lo, hi))], group_cols, prefix)


def tiered_scale(
    df: DataFrame,
    tiers: Sequence[tuple[Sequence[str], tuple[float, float]]],
    group_cols: Sequence[str],
    prefix: str = "f_scaled_",
    extremes: DataFrame | None = None,
) -> DataFrame:
    """Min-max scale several column sets, each to its own target range.

    ``df`` feeds both the aggregate and the join; pass a stored frame when it is
    expensive to compute, and its stored ``extremes`` to have a small table joined without a shuffle of ``df``.
    """
    all_cols = [c for cols, _ in tiers for c in cols]
    df = with_group_min_max(df, all_cols, group_cols, extremes)
    scaled = {}
    for cols, (lo, hi) in tiers:
        for c in cols:
            scaled[f"{prefix}{c}"] = min_max_scale(c, F.col(f"__min_{c}"), F.col(f"__max_{c}"), lo, hi)
    return df.withColumns(scaled).drop(*[f"__min_{c}" for c in all_cols], *[f"__max_{c}" for c in all_cols])
