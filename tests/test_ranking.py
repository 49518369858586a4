"""Dense ranks against a plain definition: ties, NULLs, NaN, hot groups and values, every type."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from peerscore.operators.ranking import RankSpec, add_dense_ranks, rank_asc, rank_desc, rank_global, top_k_per_group


def py_dense(rows, desc):
    """(group, value) -> rank; NULL is the smallest value, NaN the largest."""
    key = lambda v: (0, 0) if v is None else (2, 0) if isinstance(v, float) and math.isnan(v) else (1, v)
    groups = {}
    for g, v in rows:
        groups.setdefault(g, set()).add(key(v))
    order = {g: {v: i for i, v in enumerate(sorted(vals, reverse=desc), start=1)} for g, vals in groups.items()}
    return [order[g][key(v)] for g, v in rows]


def check(spark, rows, schema, partitions=4):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], schema)
    got = {r.id: (r.up, r.down) for r in add_dense_ranks(df, [RankSpec("v", "up", False), RankSpec("v", "down", True)], ["g"], partitions).collect()}
    up, down = py_dense(rows, False), py_dense(rows, True)
    assert got == {i: (up[i], down[i]) for i in range(len(rows))}


def _data(n=3000, seed=3):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        g = 0 if rnd.random() < 0.5 else rnd.choice([1, 2, 3, None])  # group 0 holds half of the rows
        v = None if rnd.random() < 0.05 else 0.0 if rnd.random() < 0.3 else float(rnd.randint(0, 900))
        out.append((g, v))
    return out


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_matches_the_definition(spark, partitions):
    check(spark, _data(), "id long, g int, v double", partitions)


def test_every_type(spark):
    big = 2**53
    check(spark, [(1, big + k) for k in range(6)] + [(1, None), (2, -big)], "id long, g int, v long")
    check(spark, [(1, Decimal("123456789012345678.01")), (1, Decimal("123456789012345678.02")), (1, None)], "id long, g int, v decimal(20,2)")
    check(spark, [(None, s) for s in ["b", "a", "", None, "B", "a"]], "id long, g int, v string")
    check(spark, [(1, v) for v in [float("nan"), float("inf"), -0.5, None, float("nan")]], "id long, g int, v double")


def test_hot_null_group_and_hot_value(spark):
    rows = [(None, 0.0 if i % 3 else float(i)) for i in range(600)] + [(7, 1.0)]
    check(spark, rows, "id long, g int, v double", 8)


def test_ranks_of_different_types_share_one_call(spark):
    rows = [(i, i % 3, float(i % 17), f"s{i % 11}", i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g int, v double, s string, n long")
    specs = [RankSpec("v", "rv", True), RankSpec("s", "rs", False), RankSpec("n", "rn", True)]
    w = lambda c, d: F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc(c) if d else F.asc(c))).cast("long")
    want = df.select("id", w("v", True).alias("rv"), w("s", False).alias("rs"), w("n", True).alias("rn"))
    got = add_dense_ranks(df, specs, ["g"]).select("id", "rv", "rs", "rn")
    assert got.schema == want.schema or [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_null_takes_rank_one_ascending_and_the_last_descending(spark):
    df = spark.createDataFrame([(1, None), (2, 0.5), (3, 0.7)], "id long, v double").withColumn("g", F.lit(1))
    assert {r.id: r.r for r in rank_asc(df, "v", "r", ["g"]).collect()} == {1: 1, 2: 2, 3: 3}
    assert {r.id: r.r for r in rank_desc(df, "v", "r", ["g"]).collect()} == {1: 3, 2: 2, 3: 1}


def test_rank_global(spark):
    rows = [v for _, v in _data(1000)]
    df = spark.createDataFrame(list(enumerate(rows)), "id long, v double")
    exp = py_dense([(0, v) for v in rows], True)
    assert {r.id: r.r for r in rank_global(df, "v", "r").collect()} == dict(enumerate(exp))


def test_empty_frame_and_top_k(spark):
    df = spark.createDataFrame([], "id long, g int, v double")
    assert rank_desc(df, "v", "r", ["g"]).count() == 0
    df = spark.createDataFrame([(i, i % 2, float(i % 9)) for i in range(60)], "id long, g int, v double")
    top = top_k_per_group(rank_desc(df, "v", "r", ["g"]), "r", 2).collect()
    assert top and all(r.r <= 2 for r in top)


def test_rank_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    rows_st = st.lists(st.tuples(st.sampled_from([0, 1, 2, None]),
                                 st.one_of(st.none(), st.integers(-20, 20).map(float))), min_size=1, max_size=40)

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(rows=rows_st, partitions=st.sampled_from([1, 2, 8]))
    def run(rows, partitions):
        check(spark, rows, "id long, g int, v double", partitions)

    run()


def test_top_k_values_equal_a_plain_dense_rank(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from peerscore.operators.ranking import top_k_values

    r = random.Random(8)
    rows = [(k, r.choice(["a"] * 6 + ["b", None]), r.choice([None, *range(40)])) for k in range(3000)]
    df = spark.createDataFrame([(k, g, None if v is None else float(v)) for k, g, v in rows], "id long, g string, v double").repartition(5)
    for down in (True, False):
        order = F.desc_nulls_last("v") if down else F.asc_nulls_first("v")
        want = df.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(order))).where("r <= 4").select("id")
        got = top_k_values(df, "v", 4, ["g"], descending=down, salts=3)
        assert got.columns == df.columns
        assert sorted(x.id for x in got.collect()) == sorted(x.id for x in want.collect())


def test_top_k_values_shuffle_only_the_best_of_a_hot_group(spark):
    """Of 60,000 rows of one group, at most k values (and the next one) a salt and input partition are shuffled."""
    from peerscore.operators.ranking import top_k_values

    df = spark.range(60_000, numPartitions=4).selectExpr("id", "'hot' as g", "cast((id * 7919) % 60000 as double) as v")
    best = top_k_values(df, "v", 5, ["g"], salts=8)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan
    assert sorted(r.v for r in best.collect()) == [59995.0, 59996.0, 59997.0, 59998.0, 59999.0]
    metrics = best._jdf.queryExecution().executedPlan()
    written = []

    def walk(node):
        node = node.executedPlan() if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else node
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            node = node.plan()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec" and "__tk_salt" in node.toString().split("\n")[0]:
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(metrics)
    assert written and max(written) <= (5 + 1) * 8 * 4  # a group limit passes the row that opens rank k + 1


def test_ranks_are_joined_by_one_number_first(spark):
    """Rows sort by a hash of rank number, group and value, not by the rank number, which nearly always ties."""
    import re

    df = spark.createDataFrame([(i, i % 2, float(i % 9), i % 4) for i in range(60)], "id long, g int, v double, w int")
    had = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = add_dense_ranks(df, [RankSpec("v", "a", True), RankSpec("w", "b", False)], ["g"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", had)
    first = re.findall(r"Sort \[(?:__rt_)?(__rk_\w+)#", plan)
    assert first.count("__rk_hash") >= 4  # both sides of both joins; windows over the counts sort by the rank number
    # a row's ranks are not combined before their shuffle, where they cannot meet
    assert "partial_max" not in plan[plan.index("REPARTITION_BY_COL"):]


def test_zeros_of_both_signs_and_nan_share_a_rank(spark):
    rows = [(1, 0.0), (1, -0.0), (1, float("nan")), (1, -float("nan")), (None, -0.0), (None, 0.0), (None, None), (1, 2.0)]
    check(spark, rows, "id long, g int, v double", 3)
    df = spark.createDataFrame([(0.0, 0.0, 1), (-0.0, -0.0, 2)], "g double, v double, n int")
    got = add_dense_ranks(df, [RankSpec("v", "a", True), RankSpec("n", "b", True)], ["g"]).collect()
    assert sorted((r.n, r.a, r.b) for r in got) == [(1, 1, 2), (2, 1, 1)]
