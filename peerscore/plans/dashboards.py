"""Dashboard queries: subject vs group by horizon (C3) and join coverage (C4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.operators.assemble import coverage_fanout, feature_side
from peerscore.operators.project import snapshot_lit
from peerscore.operators.ranking import RankSpec, add_dense_ranks
from peerscore.operators.reshape import domain_position, union_all_branches, unpivot_pairs
from peerscore.schemas import GROUP_ID, GROUP_KEYS, GROWTH, HORIZONS, SNAPSHOT, SUBJECT_ID, SUBJECT_KEYS


def growth_pairs(model: dict[str, DataFrame], subject_id=None) -> DataFrame:
    """Subject growth ⋈ base (subject, date) ⋈ group growth (group, date)."""
    sg = feature_side(model["subject_growth"], GROWTH, "subject")
    if subject_id is not None:
        sg = sg.where(F.col(SUBJECT_ID) == F.lit(subject_id))
    base = model["subject"].select(F.col("id").alias(SUBJECT_ID), SNAPSHOT, GROUP_ID)
    gg = feature_side(model["group_growth"], GROWTH, "group")
    return sg.join(base, SUBJECT_KEYS).join(gg, GROUP_KEYS)


def _numbered(pairs: DataFrame, position: str) -> DataFrame:
    """The growth pairs with the dense rank of their (subject, snapshot) as ``position``."""
    rows = pairs.select(*SUBJECT_KEYS, *[c for pair in GROWTH.pairs for c in pair], F.struct(*SUBJECT_KEYS).alias("__pair"))
    return add_dense_ranks(rows, [RankSpec("__pair", position, False)], []).drop("__pair")


def horizon_comparison(model: dict[str, DataFrame], subject_id=None, snapshot=None, ordered: bool = True,
                       as_union: bool = False, position: str | None = None) -> DataFrame:
    """One row per (subject, snapshot, horizon): subject value and group value.

    ``subject_id`` / ``snapshot`` narrow it to the dashboard's single subject and
    date; by default all subjects and dates.  Rows are ordered by subject, date and
    horizon in its natural order (O2).  ``position`` names a column for the dense rank of
    the rows in that order.  A pair has one row for each horizon, so the pairs are ranked,
    not their rows: the k-th pair's row of the i-th of n horizons is at (k - 1) * n + i.
    """
    pairs = growth_pairs(model, subject_id)
    ids = [SUBJECT_ID, SNAPSHOT]
    if position is not None:
        if snapshot is not None:
            pairs = pairs.where(F.col(SNAPSHOT) == snapshot_lit(snapshot))
        pairs, ids = _numbered(pairs, position), [*ids, position]
    long = (union_all_branches if as_union else unpivot_pairs)(pairs, ids, GROWTH)
    if snapshot is not None:
        long = long.where(F.col(SNAPSHOT) == snapshot_lit(snapshot))
    if position is not None:
        at = (F.col(position) - 1) * len(GROWTH.columns) + domain_position("horizon", GROWTH.columns)
        long = long.select(*[c for c in long.columns if c != position], at.alias(position))
    if ordered:
        long = long.orderBy(SUBJECT_ID, SNAPSHOT, domain_position("horizon", HORIZONS))
    return long


__all__ = ["horizon_comparison", "coverage_fanout", "growth_pairs"]
