"""Plan-shape regressions for the scale properties claimed in the README."""

import re

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from peerscore.operators import assemble, reshape
from peerscore.plans import dashboards, registry, scorecard
from peerscore.schemas import HORIZONS
from peerscore.sources.tables import read_model, write_model

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, model):
    import tempfile

    root = tempfile.mkdtemp(prefix="peerscore-plan-")
    write_model(model, root)
    return read_model(spark, root)


def test_snapshot_filter_reaches_every_table(spark, stored):
    plan = _plan(assemble.assemble_wide(stored, "1998-12-31", "1998-12-31"))
    scans = re.findall(r"FileScan parquet [^\n]*", plan)
    dated = [s for s in scans if "snapshot" in s]
    assert dated and all("PartitionFilters: [isnotnull(snapshot" in s for s in dated)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_cartesian_or_python(spark, name):
    plan = _plan(registry.QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", ["audit_duplicate_keys", "group_min_max", "snapshot_counts"])
def test_aggregations_combine_map_side(spark, name):
    plan = _plan(registry.QUERIES[name](spark, SF))
    assert re.search(r"partial_(max|min|count)", plan), name


def _scans(df, table):
    return _plan(df).count(f"{table}.parquet")


@pytest.mark.parametrize("name", ["rank_all_snapshots", "assemble_wide", "horizon_comparison", "capture_records", "audit_model"])
def test_a_query_aggregates_lineitem_once(spark, name, monkeypatch):
    """Every action of the query, not only the last plan, reads ``lineitem`` in one scan."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    scans, checkpoint = [], Classic.checkpoint

    def counted(self, eager=True):
        scans.append(_scans(self, "lineitem"))
        return checkpoint(self, eager)

    monkeypatch.setattr(Classic, "checkpoint", counted)
    df = registry.QUERIES[name](spark, SF)
    assert sum(scans) + _scans(df, "lineitem") == 1


def test_no_window_holds_a_group(spark, stored):
    """The windows left add up one row per group and partition, never the rows of a group."""
    plan = _plan(scorecard.rank_all_snapshots(stored))
    windows = re.findall(r"Window \[[^\n]*", plan)
    assert windows and all("sum(__rk_n" in w for w in windows)
    assert "SinglePartition" not in plan and "dense_rank" not in plan


def test_group_extremes_are_combined_before_the_shuffle(spark):
    plan = _plan(registry.QUERIES["min_max_scale"](spark, SF))
    assert "partial_min" in plan and "Window" not in plan


def test_base_rows_are_distinct_before_the_anti_join(spark):
    plan = _plan(registry.QUERIES["groups_without_data"](spark, SF))
    assert "LeftAnti" in plan and plan.count("HashAggregate") >= 2


def test_small_group_tables_do_not_shuffle_the_subjects(spark, stored):
    """The stored group side and the stored group extremes are joined where the rows lie: one exchange of rows, by row id."""
    wide = assemble.assemble_wide(stored, store_groups=True)
    assert "hashpartitioning(group_id" not in _plan(wide)
    assert "hashpartitioning(group_id" not in _plan(scorecard.score_terms(wide))


def test_horizon_positions_rank_pairs_not_their_rows(spark, monkeypatch):
    """What is stored on the way to the positions has a row a pair, not one for each of its horizons."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    sizes, checkpoint = [], Classic.checkpoint

    def counted(self, eager=True):
        out = checkpoint(self, eager)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(Classic, "checkpoint", counted)
    n = registry.QUERIES["horizon_comparison"](spark, SF).count()
    assert n > 0 and max(sizes) * len(HORIZONS) == n


@pytest.mark.parametrize("snapshot", [None, "1998-12-31"])
@pytest.mark.parametrize("as_union", [False, True])
def test_horizon_positions_are_dense_ranks(spark, snapshot, as_union):
    """As ranked over the rows themselves: a repeated (subject, date) ties, other dates do not count, unmatched rows neither."""
    days = ["1997-12-31", "1998-12-31", "1999-12-31"]
    date = F.col("snapshot").cast("date")
    subject = [(i, i % 2, d) for i in (30, 4, 100, 7) for d in days if (i, d) != (4, days[1])] + [(7, 1, days[1]), (5, None, days[0])]
    growth = [(i, *[float(i * k) for k in range(7)], d) for i in (30, 4, 100, 7, 8) for d in days]
    groups = [(g, *[float(g + k) for k in range(7)], d) for g in (0, 1) for d in days if (g, d) != (0, days[2])]
    model = {
        "subject": spark.createDataFrame(subject, "id long, group_id int, snapshot string"),
        "subject_growth": spark.createDataFrame(growth, ["subject_id", *HORIZONS, "snapshot"]),
        "group_growth": spark.createDataFrame(groups, ["group_id", *HORIZONS, "snapshot"]).withColumn("group_id", F.col("group_id").cast("int")),
    }
    model = {n: df.withColumn("snapshot", date) for n, df in model.items()}
    plain = dashboards.horizon_comparison(model, snapshot=snapshot, ordered=False, as_union=as_union)
    order = Window.orderBy("subject_id", "snapshot", reshape.domain_position("horizon", HORIZONS))
    want = plain.withColumn("at", F.dense_rank().over(order).cast("bigint"))
    got = dashboards.horizon_comparison(model, snapshot=snapshot, ordered=False, as_union=as_union, position="at")
    assert got.columns == want.columns and got.schema["at"].dataType == want.schema["at"].dataType
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted(map(tuple, want.collect()), key=repr) and len({r[-1] for r in rows}) < len(rows)
