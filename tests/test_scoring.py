"""Score terms against independent Python oracles written from the formulas."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from peerscore.functions.scoring import growth_trend, min_max_scale, ordinal_encode, pct_change_sum

H = 7


def py_growth(s, g):
    beats = sum(1 for a, b in zip(s, g) if a > b)
    trend = 0
    for i in range(H - 1):
        d = s[i] - s[i + 1]
        trend += 1 if d > 0 else (-1 if d < 0 else 0)
    return (H - beats) + (H - trend)


def py_pct(pairs):
    tot = Decimal(0)
    for s, g in pairs:
        if g != 0:
            tot += (Decimal(s) - Decimal(g)) / Decimal(g) * 100
    return int(tot)


def _frame(spark, rows, n):
    cols = [f"s{i}" for i in range(n)] + [f"g{i}" for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)), cols


def test_growth_trend_matches_oracle(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        vals = [round(rnd.uniform(-20, 40), 2) if rnd.random() > 0.2 else 0.0 for _ in range(2 * H)]
        if rnd.random() < 0.2:  # ties
            vals[1] = vals[0]
        rows.append(tuple(vals))
    rows += [tuple([5.0] * 14), tuple(list(range(7)) + [0.0] * 7), tuple(list(range(7, 0, -1)) + [9.0] * 7)]
    df, cols = _frame(spark, [tuple(float(x) for x in r) for r in rows], H)
    got = df.select(growth_trend(cols[:H], cols[H:]).alias("t")).collect()
    for r, g in zip(rows, got):
        assert g.t == py_growth(r[:H], r[H:])
        assert 1 <= g.t <= 20


def test_growth_trend_range_edges(spark):
    df, cols = _frame(spark, [tuple([5.0] * 14), tuple([float(i) for i in range(7)] + [0.0] * 7),
                              tuple([float(i) for i in range(7, 0, -1)] + [99.0] * 7)], H)
    got = [r.t for r in df.select(growth_trend(cols[:H], cols[H:]).alias("t")).collect()]
    # all equal: nothing beaten, no trend -> 14; rising horizons beating the group -> 1+...; falling, never beating
    assert got[0] == 14
    assert got[1] == (7 - 6) + (7 - (-6))
    assert got[2] == (7 - 0) + (7 - 6)


def test_pct_change_sum_matches_decimal_oracle(spark):
    rnd = random.Random(11)
    n = 5
    rows = []
    for _ in range(2000):
        s = [round(rnd.uniform(0, 100), 2) for _ in range(n)]
        g = [round(rnd.uniform(-50, 100), 2) if rnd.random() > 0.3 else 0.0 for _ in range(n)]
        rows.append(tuple(s + g))
    # borders: 33.33..% + 66.66..% = exactly 100; negative sum truncates toward zero
    rows.append((4.0, 5.0, 0, 0, 0, 3.0, 3.0, 0, 0, 0))
    rows.append((1.0, 0, 0, 0, 0, 3.0, 0, 0, 0, 0))
    df, cols = _frame(spark, [tuple(float(x) for x in r) for r in rows], n)
    got = df.select(pct_change_sum(list(zip(cols[:n], cols[n:]))).alias("p")).collect()
    bad = [(r, g.p) for r, g in zip(rows, got)
           if g.p != py_pct([(Decimal(str(a)), Decimal(str(b))) for a, b in zip(r[:n], r[n:])])]
    assert not bad, bad[:3]
    assert got[-2].p == 100
    assert got[-1].p == -66


def test_pct_change_zero_group_contributes_zero(spark):
    df = spark.createDataFrame([(10.0, 0.0), (None, 0.0), (10.0, None)], "s double, g double")
    got = [r.p for r in df.select(pct_change_sum([("s", "g")]).alias("p")).collect()]
    assert got == [0, 0, None]


def test_min_max_scale_constant_and_range(spark):
    df = spark.createDataFrame([(1.0, 1.0, 3.0), (3.0, 1.0, 3.0), (2.0, 2.0, 2.0)], "x double, lo double, hi double")
    got = [r.v for r in df.select(min_max_scale("x", F.col("lo"), F.col("hi"), 91.0, 100.0).alias("v")).collect()]
    assert got[0] == 91.0 and got[1] == 100.0 and got[2] == 95.5


def test_ordinal_encode(spark):
    df = spark.createDataFrame([("Low",), ("Moderately Low",), ("High",), ("",), (None,)], "risk string")
    got = [r.c for r in df.select(ordinal_encode("risk", {"Low": 1, "Moderately Low": 2}, 3).alias("c")).collect()]
    assert got == [1, 2, 3, 3, 3]


def test_growth_trend_null_propagates(spark):
    df, cols = _frame(spark, [tuple([1.0] * 13 + [None])], H)
    assert df.select(growth_trend(cols[:H], cols[H:]).alias("t")).first().t is None


def test_wrong_arity_raises():
    with pytest.raises(ValueError):
        growth_trend(["a"], ["b", "c"])


def test_pct_change_beyond_int_is_kept(spark):
    df = spark.createDataFrame([(1.0e9, 0.01), (1.0e300, 1.0)], "s double, g double")
    got = [r.p for r in df.select(pct_change_sum([("s", "g")]).alias("p")).collect()]
    assert got == [9_999_999_999_900, None]  # only what no bigint holds is NULL, without failing the job


def test_pct_change_sum_equals_the_rounded_sum_beside_integers(spark):
    from pyspark.sql import functions as F

    from peerscore.functions.scoring import pct_change_sum

    near = [k + d for k in (-3, -1, 0, 1, 2, 10**6) for d in (-2e-6, -1e-6, -6e-7, -5e-7, -4e-7, 0.0, 4e-7, 5e-7, 6e-7, 1e-6, 0.25)]
    rows = [(1.0 + x / 100.0, 1.0) for x in near] + [(float("nan"), 1.0), (float("inf"), 1.0), (1e300, 1.0), (None, 1.0), (5.0, 0.0)]
    df = spark.createDataFrame(rows, "s double, g double")
    plain = F.round(F.when(F.col("g") == 0, F.lit(0.0)).otherwise((F.col("s") - F.col("g")) / F.col("g") * 100.0), 6).try_cast("bigint")
    got = df.select(pct_change_sum([("s", "g")]).alias("a"), plain.alias("b"))
    assert [r.a for r in got.collect()] == [r.b for r in got.collect()]


def test_growth_trend_sums_an_array(spark):
    """Unrolled, its comparisons made the generated method of the assembly too long to be compiled."""
    from peerscore.functions.scoring import growth_trend

    df = spark.createDataFrame([(1.0, 3.0, 2.0, 2.0), (None, 1.0, 1.0, 1.0)], "a double, b double, c double, d double")
    got = df.select(growth_trend(["a", "b"], ["c", "d"]).alias("t"))
    assert dict(got.dtypes)["t"] == "int" and [r.t for r in got.collect()] == [4, None]
    assert "aggregate(array(" in got._jdf.queryExecution().executedPlan().toString()


def test_cents_are_rounded_half_up(spark):
    from pyspark.sql import functions as F

    from peerscore.sources.demo import cents

    xs = [0.0, -0.0, 0.005, -0.005, 0.015, 0.025, -0.025, 1.005, 0.49999999999999994 / 100, 901.13, 104949.5, -7.125, 7.125, 1e12 + 0.125]
    df = spark.createDataFrame([(x,) for x in [*xs, None]], "x double")
    rows = df.select(cents(F.col("x")).alias("a"), F.round(F.col("x") * 100).cast("long").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]
