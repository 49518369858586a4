"""Peer-group scorecard: score every subject against its group and rank it.

One declarative plan for all groups (and, for a backfill, all dates): the group
is a key of the plan, never a driver loop.  Every score term is a native
expression; group extremes are combined before the shuffle and dense ranks are
range-partitioned, so a group of any size spreads over the cluster.  The
assembled frame and the scored rows are each stored once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.functions.scoring import composite_score, growth_trend, horizontal_sum, ordinal_encode, pct_change_sum
from peerscore.operators.assemble import assemble_wide
from peerscore.operators.project import nan_to_zero, snapshot_lit
from peerscore.operators.ranking import ROW_ID, RankSpec, add_dense_ranks, ranks_by_row, with_row_id
from peerscore.operators.scaling import group_min_max, tiered_scale
from peerscore.session import stored, stored_table
from peerscore.schemas import (
    CREDIT,
    CREDIT_TIERS,
    GROUP_ID,
    GROUP_KEYS,
    GROWTH,
    PORTFOLIO,
    RISK,
    RISK_ORDINAL_DEFAULT,
    RISK_ORDINALS,
    SNAPSHOT,
    SUBJECT_ID,
)

# component ranks: (value column, output, higher value is better)
RANK_SPECS = [
    RankSpec("asset_value", "asset_value_rank", True),
    RankSpec("expense_ratio", "expense_ratio_rank", False),
    RankSpec(RISK.subject_col("sharpe"), "sharpe_ratio_rank", True),
    RankSpec(RISK.subject_col("alpha"), "alpha_rank", True),
    RankSpec(RISK.subject_col("beta"), "beta_rank", False),
    RankSpec(RISK.subject_col("std_dev"), "std_dev_rank", False),
    RankSpec(RISK.subject_col("mean"), "mean_rank", True),
]
SCALED_TIERS = [([CREDIT.subject_col(c) for c in cols], rng) for cols, rng in CREDIT_TIERS]
SCALED_COLS = [f"f_scaled_{c}" for cols, _ in SCALED_TIERS for c in cols]
# --- fixed values: the twelve terms of the composite score, in summation order ---
SCORE_TERMS = [
    "risk_rank", "asset_value_rank", "expense_ratio_rank", "sharpe_ratio_rank", "alpha_rank",
    "beta_rank", "std_dev_rank", "mean_rank", "trend_growth", "credit_rating_trend",
    "portfolio_agg_trend", "f_total",
]
# --- end of fixed values ---
RANKING_COLUMNS = [SUBJECT_ID, "name", GROUP_ID, "rating", SNAPSHOT, "total_rank", "total_rank_int", "group_rank"]
SCORE_DIGITS = 6


def score_terms(wide: DataFrame, group_cols=GROUP_KEYS) -> DataFrame:
    """Keys, labels, all twelve peer-relative terms and ``total_rank`` for an assembled wide frame.

    The four terms of a row by itself are computed before the frame is stored, so that of the wide frame
    only the ranked and scaled columns are stored and carried through the joins.
    """
    own = {
        "trend_growth": growth_trend(GROWTH.subject_cols, GROWTH.group_cols),
        "credit_rating_trend": pct_change_sum(CREDIT.pairs),
        "portfolio_agg_trend": pct_change_sum(PORTFOLIO.pairs),
        "risk_rank": ordinal_encode("risk", RISK_ORDINALS, RISK_ORDINAL_DEFAULT),
    }
    scaled = [c for cols, _ in SCALED_TIERS for c in cols]
    peer = [s.value for s in RANK_SPECS] + scaled
    keep = dict.fromkeys([SUBJECT_ID, "name", GROUP_ID, "rating", SNAPSHOT, *group_cols, *peer])
    rows = with_row_id(nan_to_zero(wide).select(*keep, *[c.alias(n) for n, c in own.items()]))
    df = tiered_scale(rows, SCALED_TIERS, group_cols, extremes=stored_table(group_min_max(rows, scaled, group_cols)) if group_cols else None)
    df = df.join(ranks_by_row(rows, ROW_ID, RANK_SPECS, group_cols), ROW_ID).drop(ROW_ID)
    df = df.withColumn("f_total", horizontal_sum(SCALED_COLS))
    return df.withColumn("total_rank", F.round(composite_score(SCORE_TERMS), SCORE_DIGITS))


def rank_terms(scored: DataFrame, group_cols=GROUP_KEYS, descending: bool = True) -> DataFrame:
    """Ranking rows: in-group dense rank of ``total_rank`` (W3; 1 = highest when descending)."""
    out = scored.select(
        SUBJECT_ID, "name", GROUP_ID, "rating", SNAPSHOT, "total_rank",
        F.round("total_rank").try_cast("bigint").alias("total_rank_int"),
    )
    out = add_dense_ranks(out, [RankSpec("total_rank", "group_rank", descending)], group_cols)
    return out.select(*RANKING_COLUMNS)


def rank_range(model: dict[str, DataFrame], start=None, end=None) -> DataFrame:
    """Rank every subject inside its group for every snapshot in [start, end]."""
    return rank_terms(score_terms(assemble_wide(model, start, end, store_groups=True)))


def rank_snapshot(model: dict[str, DataFrame], snapshot=None) -> DataFrame:
    """Rank one snapshot, all groups (C1); ``snapshot=None`` is today."""
    d = snapshot_lit(snapshot)
    return rank_range(model, d, d)


def rank_all_snapshots(model: dict[str, DataFrame]) -> DataFrame:
    """Rank the whole history at once (C2), replacing one run per date."""
    return rank_range(model)


def rank_snapshot_sorted(ranking: DataFrame) -> DataFrame:
    """Presentation order (O1): ascending total score, as the job printed it."""
    return ranking.orderBy(F.col("total_rank").asc_nulls_last(), SUBJECT_ID)


def rerank_stored(ranking: DataFrame, snapshot=None, group_id=None) -> DataFrame:
    """Re-rank stored results by the integer score (W4); optional date and group filters."""
    df = ranking
    if snapshot is not None:
        df = df.where(F.col(SNAPSHOT) == snapshot_lit(snapshot))
    if group_id is not None:
        df = df.where(F.col(GROUP_ID) == F.lit(group_id).cast(df.schema[GROUP_ID].dataType))
    return add_dense_ranks(df.drop("group_rank"), [RankSpec("total_rank_int", "group_rank", True)], GROUP_KEYS)


RANKING_KEYS = [SUBJECT_ID, GROUP_ID, SNAPSHOT]


def rank_and_store(spark, model: dict[str, DataFrame], path: str, start=None, end=None, clock=None) -> DataFrame:
    """Rank [start, end] and upsert it into the ranking table at ``path``.

    Keyed on (subject, group, snapshot). The ranked rows are stored once; only the
    snapshot partitions of the date range are read and rewritten; ``modified`` is
    stamped on every written row.  Returns the stored table.
    """
    from peerscore.operators.project import snapshot_range
    from peerscore.operators.upsert import path_exists, upsert, with_audit, write_upsert

    ranked = stored(with_audit(rank_range(model, start, end), set_added=False, clock=clock))
    if path_exists(spark, path):
        kept = spark.read.parquet(path).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
        kept = snapshot_range(kept, start, end).select(*ranked.columns)
        ranked = upsert(kept, ranked, RANKING_KEYS, partition_cols=[SNAPSHOT])
    write_upsert(spark, ranked, path, [SNAPSHOT])
    return spark.read.parquet(path).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
