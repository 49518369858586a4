"""Assembly joins of the dated model.

Subject feature tables join the base on (subject_id, snapshot): every side is
hash-partitioned on the same keys, so the four joins run in one stage after one
exchange per table.  Group tables join on (group_id, snapshot); they hold one row
per group and date, and adaptive execution broadcasts them when their measured
size allows, otherwise keeps a shuffled join (with skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.operators.project import snapshot_range
from peerscore.schemas import (
    GROUP_FEATURE_TABLES,
    GROUP_ID,
    GROUP_KEYS,
    SNAPSHOT,
    SUBJECT_FEATURE_TABLES,
    SUBJECT_ID,
    SUBJECT_KEYS,
    FeatureFamily,
)
from peerscore.session import stored_table

BASE_COLUMNS = ["name", "rating", "asset_value", GROUP_ID, "expense_ratio", "risk"]


def _dated(df: DataFrame, start, end) -> DataFrame:
    return snapshot_range(df, start, end)


def feature_side(table: DataFrame, family: FeatureFamily, side: str) -> DataFrame:
    """Keys plus the family's value columns renamed ``s_<family>_<c>`` or ``g_<family>_<c>``."""
    if side == "subject":
        return table.select(SUBJECT_ID, SNAPSHOT, *[F.col(c).alias(family.subject_col(c)) for c in family.columns])
    return table.select(GROUP_ID, SNAPSHOT, *[F.col(c).alias(family.group_col(c)) for c in family.columns])


def base_frame(model: dict[str, DataFrame], start=None, end=None, columns=BASE_COLUMNS) -> DataFrame:
    return _dated(model["subject"], start, end).select(F.col("id").alias(SUBJECT_ID), *columns, SNAPSHOT)


def assemble_subject(model: dict[str, DataFrame], start=None, end=None, base: DataFrame | None = None) -> DataFrame:
    """Base ⋈ the four subject feature tables on (subject_id, snapshot), inner."""
    df = base if base is not None else base_frame(model, start, end)
    for name, fam in SUBJECT_FEATURE_TABLES.items():
        df = df.join(feature_side(_dated(model[name], start, end), fam, "subject"), SUBJECT_KEYS, "inner")
    return df


def assemble_dimension(df: DataFrame, group_dim: DataFrame) -> DataFrame:
    """Left join of the undated group dimension on group id only (J2): a missing row keeps the subject."""
    dim = group_dim.select(F.col("id").alias(GROUP_ID), "category", "category_code")
    return df.join(dim, GROUP_ID, "left")


def assemble_group(df: DataFrame, model: dict[str, DataFrame], start=None, end=None) -> DataFrame:
    """Inner joins of the four group feature tables on (group_id, snapshot).

    The group tables are joined to each other first, so ``df`` meets one small side
    in one join, whose skewed partitions adaptive execution can split.
    """
    return df.join(group_side(model, start, end, with_dimension=False), GROUP_KEYS, "inner")


def group_side(model: dict[str, DataFrame], start=None, end=None, with_dimension: bool = True) -> DataFrame:
    """The four group feature tables joined on (group_id, snapshot), plus the dimension (left, on group id).

    All of these are small (one row per group and date), so the dimension is joined
    here instead of onto the large subject frame: equivalent, because every group
    table holds exactly one row per key, and the large frame is then shuffled once,
    on (group_id, snapshot).
    """
    side = None
    for name, fam in GROUP_FEATURE_TABLES.items():
        f = feature_side(_dated(model[name], start, end), fam, "group")
        side = f if side is None else side.join(f, GROUP_KEYS, "inner")
    if with_dimension:
        dim = model["group_dim"].select(F.col("id").alias(GROUP_ID), "category", "category_code")
        side = side.join(dim, GROUP_ID, "left")
    return side


def assemble_wide(model: dict[str, DataFrame], start=None, end=None, with_dimension: bool = True, store_groups: bool = False) -> DataFrame:
    """The ten-way assembly (J4): one row per subject and snapshot that has all eight
    dated feature rows; a subject without a dimension row is kept.

    With ``store_groups`` the group side is computed once and stored.  Its size is then known when the large frame is planned
    (that of a join is guessed as a product), so that few groups are broadcast and the frame is not shuffled for them.
    """
    groups = group_side(model, start, end, with_dimension)
    return assemble_subject(model, start, end).join(stored_table(groups) if store_groups else groups, GROUP_KEYS, "inner")


def _key_counts(df: DataFrame, keys: list[str], out: str, rename: dict[str, str] | None = None) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    for a, b in (rename or {}).items():
        counted = counted.withColumnRenamed(a, b)
    return counted


def coverage_fanout(model: dict[str, DataFrame], start=None, end=None) -> DataFrame:
    """Rows produced per (subject, snapshot) by the dashboard coverage join (J5 + A1).

    The subject tables join on (subject, date) but the two group tables join on
    the group alone, so each subject row fans out over the group's whole history.
    The count is computed as a product of per-key counts — the fan-out itself is
    never materialised.  The per-group factor (dimension rows x group-growth rows
    x group-risk rows) is one small table; the subject side is summed on its own
    partitioning first, so a hot group never gathers the large frame in one task.
    """
    base = _dated(model["subject"], start, end).select(F.col("id").alias(SUBJECT_ID), SNAPSHOT, GROUP_ID)
    df = base
    for name in ["subject_risk", "subject_growth", "subject_credit"]:
        df = df.join(_key_counts(_dated(model[name], start, end), SUBJECT_KEYS, f"n_{name}"), SUBJECT_KEYS)
    per_subject = df.groupBy(SUBJECT_ID, SNAPSHOT, GROUP_ID).agg(
        F.sum(F.col("n_subject_risk") * F.col("n_subject_growth") * F.col("n_subject_credit")).alias("n_s")
    )
    per_group = (
        _key_counts(model["group_dim"], ["id"], "n_dim", {"id": GROUP_ID})
        .join(_key_counts(model["group_growth"], [GROUP_ID], "n_gg"), GROUP_ID)
        .join(_key_counts(model["group_risk"], [GROUP_ID], "n_gr"), GROUP_ID)
        .select(GROUP_ID, (F.col("n_dim") * F.col("n_gg") * F.col("n_gr")).alias("n_g"))
    )
    return (
        per_subject.join(per_group, GROUP_ID)
        .groupBy(SUBJECT_ID, SNAPSHOT)
        .agg(F.sum(F.col("n_s") * F.col("n_g")).alias("n_rows"))
    )
