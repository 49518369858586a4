"""Data model of the scorecard: feature families, table keys and declared schemas.

Subjects belong to one group per snapshot date.  Five dated tables describe a
subject (base attributes plus four feature families), five describe a group
(an undated dimension plus the same four families).  Every operator in the
package refers to columns through these specs instead of searching names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column names of the declared model (must stay as is) ---
HORIZONS = ["3m", "6m", "1y", "3y", "5y", "7y", "10y"]
CREDIT_BUCKETS = ["aaa", "a1plus", "sov", "cash_equivalent", "aa", "a_and_below", "unrated_and_others"]
RISK_MEASURES = ["mean", "std_dev", "sharpe", "sortino", "beta", "alpha"]
PORTFOLIO_AGGS = ["num_securities", "modified_duration", "average_maturity", "ytm", "avg_cr"]
# risk label -> ordinal code; anything else (NULL and '' included) is 3
RISK_ORDINALS = {"Low": 1, "Moderately Low": 2}
RISK_ORDINAL_DEFAULT = 3
# credit-quality tiers: (bucket columns, target range)
CREDIT_TIERS = [
    (["aaa"], (91.0, 100.0)),
    (["cash_equivalent", "sov", "a1plus"], (81.0, 90.0)),
    (["aa"], (71.0, 80.0)),
]
# --- end of fixed values ---

SNAPSHOT = "snapshot"
SUBJECT_ID = "subject_id"
GROUP_ID = "group_id"
GROUP_KEYS = [GROUP_ID, SNAPSHOT]
SUBJECT_KEYS = [SUBJECT_ID, SNAPSHOT]


@dataclass(frozen=True)
class FeatureFamily:
    """A named set of value columns that exists once per subject and once per group."""

    name: str
    columns: tuple[str, ...]

    def subject_col(self, c: str) -> str:
        return f"s_{self.name}_{c}"

    def group_col(self, c: str) -> str:
        return f"g_{self.name}_{c}"

    @property
    def subject_cols(self) -> list[str]:
        return [self.subject_col(c) for c in self.columns]

    @property
    def group_cols(self) -> list[str]:
        return [self.group_col(c) for c in self.columns]

    @property
    def pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.subject_cols, self.group_cols))


GROWTH = FeatureFamily("growth", tuple(HORIZONS))
CREDIT = FeatureFamily("credit", tuple(CREDIT_BUCKETS))
RISK = FeatureFamily("risk", tuple(RISK_MEASURES))
PORTFOLIO = FeatureFamily("portfolio", tuple(PORTFOLIO_AGGS))
FAMILIES = [RISK, GROWTH, CREDIT, PORTFOLIO]

# table name -> (family, key column) for the dated feature tables
SUBJECT_FEATURE_TABLES = {
    "subject_risk": RISK,
    "subject_growth": GROWTH,
    "subject_credit": CREDIT,
    "subject_portfolio": PORTFOLIO,
}
GROUP_FEATURE_TABLES = {
    "group_growth": GROWTH,
    "group_risk": RISK,
    "group_portfolio": PORTFOLIO,
    "group_credit": CREDIT,
}
MODEL_TABLES = ["subject", *SUBJECT_FEATURE_TABLES, "group_dim", *GROUP_FEATURE_TABLES]

# primary keys, as declared by the model
TABLE_KEYS = {
    "subject": ["id", SNAPSHOT],
    **{t: [SUBJECT_ID, SNAPSHOT] for t in SUBJECT_FEATURE_TABLES},
    "group_dim": ["id"],
    **{t: [GROUP_ID, SNAPSHOT] for t in GROUP_FEATURE_TABLES},
    "ranking": [SUBJECT_ID, GROUP_ID, SNAPSHOT],
}
# foreign keys: child table -> (child columns, parent table, parent columns)
FOREIGN_KEYS = {
    **{t: ([SUBJECT_ID, SNAPSHOT], "subject", ["id", SNAPSHOT]) for t in SUBJECT_FEATURE_TABLES},
    **{t: ([GROUP_ID], "group_dim", ["id"]) for t in GROUP_FEATURE_TABLES},
    "ranking": ([SUBJECT_ID], "subject", ["id"]),
}

VALUE = T.DoubleType()

SUBJECT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("asset_value", T.LongType()),
    T.StructField(GROUP_ID, T.IntegerType()),
    T.StructField("expense_ratio", VALUE),
    T.StructField("house", T.StringType()),
    T.StructField("risk", T.StringType()),
    T.StructField("risk_grade", T.StringType()),
    T.StructField("return_grade", T.StringType()),
    T.StructField("top_holdings", T.StringType()),
    T.StructField(SNAPSHOT, T.DateType(), False),
    T.StructField("modified", T.TimestampType()),
])

GROUP_DIM_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("category", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("first_seen", T.DateType(), False),
    T.StructField("modified", T.TimestampType()),
])

RANKING_SCHEMA = T.StructType([
    T.StructField(SUBJECT_ID, T.LongType(), False),
    T.StructField("name", T.StringType()),
    T.StructField(GROUP_ID, T.IntegerType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("total_rank", T.DoubleType()),
    T.StructField("total_rank_int", T.LongType()),
    T.StructField("group_rank", T.LongType()),
    T.StructField(SNAPSHOT, T.DateType(), False),
    T.StructField("modified", T.TimestampType()),
])


def feature_schema(family: FeatureFamily, key: str, key_type: T.DataType = T.LongType()) -> T.StructType:
    """Declared schema of a dated feature table (subject or group side)."""
    return T.StructType(
        [T.StructField(key, key_type, False)]
        + [T.StructField(c, VALUE) for c in family.columns]
        + [T.StructField(SNAPSHOT, T.DateType(), False), T.StructField("modified", T.TimestampType())]
    )


def table_schema(name: str) -> T.StructType:
    if name == "subject":
        return SUBJECT_SCHEMA
    if name == "group_dim":
        return GROUP_DIM_SCHEMA
    if name == "ranking":
        return RANKING_SCHEMA
    if name in SUBJECT_FEATURE_TABLES:
        return feature_schema(SUBJECT_FEATURE_TABLES[name], SUBJECT_ID)
    if name in GROUP_FEATURE_TABLES:
        return feature_schema(GROUP_FEATURE_TABLES[name], GROUP_ID, T.IntegerType())
    raise KeyError(name)
