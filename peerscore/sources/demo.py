"""Derive the eleven-table scorecard model from the TPC-H-like test tables.

Subjects are parts, groups are part types and a snapshot is the last day of a
ship year.  Every metric is built from integer cents, so sums, minima and
maxima combine exactly: the subject-level partial statistics are computed in
one aggregation of ``lineitem`` (map-side combined, one shuffle) and the group
tables are a second, tiny re-aggregation of those partials — ``lineitem`` is
scanned once for all ten dated tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscore.schemas import (
    CREDIT,
    GROUP_ID,
    GROWTH,
    PORTFOLIO,
    RISK,
    SNAPSHOT,
    SUBJECT_ID,
)

# --- fixed values: mapping of the test tables onto the model ---
GROUP_CODES = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}
# (l_returnflag, l_linestatus) pairs feeding the first six credit buckets; the seventh is 0
CREDIT_FLAG_PAIRS = [("A", "F"), ("A", "O"), ("N", "F"), ("N", "O"), ("R", "F"), ("R", "O")]
# risk label by p_size % 3
RISK_LABELS = ["Low", "Moderately Low", "High"]
RATING_MODULUS = 6
# --- end of fixed values ---

N_HORIZONS = len(GROWTH.columns)


def read_tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def cents(c: Column) -> Column:
    """Whole cents, halves away from zero: ``round`` of a double, which goes by decimals, without its price."""
    x = c * 100
    near = F.rint(x)  # halves to even
    return F.when(F.abs(x - near) == 0.5, F.signum(x) * F.floor(F.abs(x) + 0.5)).otherwise(near).cast("long")


def _avg(sum_col: str, n_col: str) -> Column:
    """Average of integer cents, truncated to whole cents, in units (two decimals)."""
    return F.when(F.col(n_col) > 0, F.expr(f"{sum_col} div {n_col}").cast("double") / F.lit(100.0)).otherwise(
        F.lit(0.0)
    )


def _units(c: str) -> Column:
    return F.col(c).cast("double") / F.lit(100.0)


# combiner of every partial statistic: how two partials of the same key merge
STAT_COMBINERS: dict[str, str] = {
    "n": "sum",
    "price_sum": "sum",
    "price_min": "min",
    "price_max": "max",
    "qty_sum": "sum",
    "disc_sum": "sum",
    "tax_sum": "sum",
    **{f"h{k}_sum": "sum" for k in range(1, N_HORIZONS + 1)},
    **{f"h{k}_n": "sum" for k in range(1, N_HORIZONS + 1)},
    **{f"q{i}_sum": "sum" for i in range(len(CREDIT_FLAG_PAIRS))},
}


def line_stats(lineitem: DataFrame) -> DataFrame:
    """Partial statistics per (part, snapshot): one pass, combinable aggregates only."""
    li = lineitem.select(
        F.col("l_partkey").alias("part"),
        F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(31)).alias(SNAPSHOT),
        cents(F.col("l_extendedprice")).alias("pc"),
        cents(F.col("l_quantity")).alias("qc"),
        cents(F.col("l_discount")).alias("dc"),
        cents(F.col("l_tax")).alias("tc"),
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
    )
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.sum("pc").alias("price_sum"),
        F.min("pc").alias("price_min"),
        F.max("pc").alias("price_max"),
        F.sum("qc").alias("qty_sum"),
        F.sum("dc").alias("disc_sum"),
        F.sum("tc").alias("tax_sum"),
    ]
    for k in range(1, N_HORIZONS + 1):
        hit = F.col("l_linenumber") == k
        aggs.append(F.sum(F.when(hit, F.col("pc")).otherwise(F.lit(0))).alias(f"h{k}_sum"))
        aggs.append(F.sum(F.when(hit, F.lit(1)).otherwise(F.lit(0))).alias(f"h{k}_n"))
    for i, (flag, status) in enumerate(CREDIT_FLAG_PAIRS):
        hit = (F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)
        aggs.append(F.sum(F.when(hit, F.col("qc")).otherwise(F.lit(0))).alias(f"q{i}_sum"))
    return li.groupBy("part", SNAPSHOT).agg(*aggs)


def combine_stats(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Merge partial statistics to a coarser key (e.g. subject -> group)."""
    fns = {"sum": F.sum, "min": F.min, "max": F.max}
    return stats.groupBy(*keys).agg(*[fns[how](c).alias(c) for c, how in STAT_COMBINERS.items()])


def growth_table(stats: DataFrame, key: str) -> DataFrame:
    return stats.select(
        key,
        *[_avg(f"h{k}_sum", f"h{k}_n").alias(h) for k, h in enumerate(GROWTH.columns, start=1)],
        SNAPSHOT,
        F.col(SNAPSHOT).cast("timestamp").alias("modified"),
    )


def credit_table(stats: DataFrame, key: str) -> DataFrame:
    shares = [
        F.when(F.col("qty_sum") > 0, F.expr(f"(10000 * q{i}_sum) div qty_sum").cast("double") / F.lit(100.0))
        .otherwise(F.lit(0.0))
        .alias(CREDIT.columns[i])
        for i in range(len(CREDIT_FLAG_PAIRS))
    ]
    rest = [F.lit(0.0).alias(c) for c in CREDIT.columns[len(CREDIT_FLAG_PAIRS):]]
    return stats.select(key, *shares, *rest, SNAPSHOT, F.col(SNAPSHOT).cast("timestamp").alias("modified"))


def portfolio_table(stats: DataFrame, key: str) -> DataFrame:
    values = {
        "num_securities": F.col("n").cast("double"),
        "modified_duration": _avg("qty_sum", "n"),
        "average_maturity": _avg("disc_sum", "n"),
        "ytm": _avg("tax_sum", "n"),
        "avg_cr": F.lit(0.0),
    }
    return stats.select(
        key, *[values[c].alias(c) for c in PORTFOLIO.columns], SNAPSHOT,
        F.col(SNAPSHOT).cast("timestamp").alias("modified"),
    )


def risk_table(stats: DataFrame, key: str) -> DataFrame:
    values = {
        "mean": _avg("price_sum", "n"),
        "std_dev": (F.col("price_max") - F.col("price_min")).cast("double") / F.lit(100.0),
        "sharpe": _avg("disc_sum", "n"),
        "sortino": _avg("tax_sum", "n"),
        "beta": _avg("qty_sum", "n"),
        "alpha": _units("price_max"),
    }
    return stats.select(
        key, *[values[c].alias(c) for c in RISK.columns], SNAPSHOT,
        F.col(SNAPSHOT).cast("timestamp").alias("modified"),
    )


def group_id_of(p_type: Column) -> Column:
    expr = reduce(
        lambda acc, kv: acc.when(p_type == kv[0], F.lit(kv[1])),
        list(GROUP_CODES.items())[1:],
        F.when(p_type == list(GROUP_CODES)[0], F.lit(GROUP_CODES[list(GROUP_CODES)[0]])),
    )
    return expr.cast("int")


def risk_label_of(size: Column) -> Column:
    m = F.pmod(size, F.lit(len(RISK_LABELS)))
    return F.element_at(F.array(*[F.lit(x) for x in RISK_LABELS]), (m + 1).cast("int"))


def subject_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Partial statistics per (subject, snapshot) with the part attributes attached."""
    part = tables["part"].select(
        F.col("p_partkey").alias("part"), "p_name", "p_brand", "p_type", "p_size",
    )
    return line_stats(tables["lineitem"]).join(part, "part").withColumn(GROUP_ID, group_id_of(F.col("p_type")))


def build_model(tables: dict[str, DataFrame], checkpoint_stats: bool = False) -> dict[str, DataFrame]:
    """The eleven model tables (see FIXTURES.md §3) as lazily evaluated DataFrames.

    With ``checkpoint_stats`` the subject-level partial statistics and those of the groups are written once
    to the shared checkpoint folder, so storing all ten tables aggregates
    ``lineitem`` once instead of once per table, and joins know how small the group tables are.
    """
    s = subject_stats(tables)
    if checkpoint_stats:
        from peerscore.session import checkpoint_dir

        checkpoint_dir(s.sparkSession)
        s = s.checkpoint(eager=True)
    subj = s.withColumnRenamed("part", SUBJECT_ID)
    grp = combine_stats(s, [GROUP_ID, SNAPSHOT])
    if checkpoint_stats:
        from peerscore.session import stored_table

        grp = stored_table(grp)  # one row a group and snapshot, of which five tables are made

    subject = s.select(
        F.col("part").alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("/subjects/"), F.col("part").cast("string"), F.lit("/"),
                 F.regexp_replace(F.lower("p_name"), " ", "-")).alias("link"),
        F.pmod(F.col("p_size"), F.lit(RATING_MODULUS)).cast("int").alias("rating"),
        F.expr("price_sum div 100").alias("asset_value"),
        F.col(GROUP_ID),
        _avg("disc_sum", "n").alias("expense_ratio"),
        F.col("p_brand").alias("house"),
        risk_label_of(F.col("p_size")).alias("risk"),
        F.lit("Average").alias("risk_grade"),
        F.lit("Average").alias("return_grade"),
        F.lit("[]").alias("top_holdings"),
        F.col(SNAPSHOT),
        F.col(SNAPSHOT).cast("timestamp").alias("modified"),
    )
    group_dim = (
        grp.groupBy(GROUP_ID)
        .agg(F.min(SNAPSHOT).alias("first_seen"))
        .join(
            tables["part"].select(group_id_of(F.col("p_type")).alias(GROUP_ID), F.col("p_type")).distinct(),
            GROUP_ID,
        )
        .select(
            F.col(GROUP_ID).alias("id"),
            F.initcap(F.lower("p_type")).alias("category"),
            F.substring("p_type", 1, 3).alias("category_code"),
            "first_seen",
            F.col("first_seen").cast("timestamp").alias("modified"),
        )
    )
    return {
        "subject": subject,
        "subject_risk": risk_table(subj, SUBJECT_ID),
        "subject_growth": growth_table(subj, SUBJECT_ID),
        "subject_credit": credit_table(subj, SUBJECT_ID),
        "subject_portfolio": portfolio_table(subj, SUBJECT_ID),
        "group_dim": group_dim,
        "group_growth": growth_table(grp, GROUP_ID),
        "group_risk": risk_table(grp, GROUP_ID),
        "group_portfolio": portfolio_table(grp, GROUP_ID),
        "group_credit": credit_table(grp, GROUP_ID),
    }


def testdata_model(spark: SparkSession, sf_dir: str, checkpoint_stats: bool = False) -> dict[str, DataFrame]:
    return build_model(read_tables(spark, sf_dir, ["lineitem", "part"]), checkpoint_stats)
