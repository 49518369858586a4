"""Split scan of JSON arrays (S8) and equal-depth scan splits (S1), against plain readings."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscore.sources import json_arrays, splits
from peerscore.sources import tables as src

_PART = T.StructType().add("b", T.StringType())
_OBJECT = T.StructType().add("a", T.LongType()).add("t", T.ArrayType(_PART))
SCHEMA = T.StructType().add("id", T.LongType()).add("s", T.StringType()).add("o", _OBJECT)


@pytest.fixture()
def small_splits(spark):
    """Files are split every 97 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield 97
    for k in names:
        spark.conf.unset(k)


def _records(seed, n):
    rnd = random.Random(seed)
    odd = ["{", "}", '"', "\\", "[", "]", ",", "é", "語", "\n", "\t", " ", "x", "}{", '\\"', '"}', "\\\\"]
    text = lambda: "".join(rnd.choices(odd, k=rnd.choice([0, 1, 5, 40, 300])))
    out = []
    for i in range(n):
        r = {"id": i}
        if rnd.random() < 0.8:
            r["s"] = text()
        if rnd.random() < 0.6:
            r["o"] = {"a": rnd.randrange(9), "t": [{"b": text()} for _ in range(rnd.randrange(4))]}
        out.append(r)
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("seed", "form"), [(0, {}), (1, {"indent": 2}), (2, {"separators": (",", ":"), "ensure_ascii": False})])
def test_split_scan_equals_whole_file_scan(spark, tmp_dir, small_splits, seed, form):
    for part in range(3):
        os.makedirs(f"{tmp_dir}/in/part={part}", exist_ok=True)
        with open(f"{tmp_dir}/in/part={part}/a.json", "w", encoding="utf-8") as f:
            json.dump(_records(10 * seed + part, 15 * part), f, **form)
    got = json_arrays.scan_json_array(spark, f"{tmp_dir}/in", SCHEMA)
    want = src.read_json_array(spark, f"{tmp_dir}/in", SCHEMA)
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)
    made = sorted(r["id"] for part in range(3) for r in _records(10 * seed + part, 15 * part))
    assert sorted(r["id"] for r in got.collect()) == made


def test_one_file_is_read_by_many_tasks(spark, tmp_dir, small_splits):
    with open(f"{tmp_dir}/a.json", "w", encoding="utf-8") as f:
        json.dump(_records(1, 60), f)
    pieces = json_arrays._pieces(spark, f"{tmp_dir}/a.json")
    size = os.path.getsize(f"{tmp_dir}/a.json")
    assert pieces.select("__block").distinct().count() > size / small_splits / 8
    assert pieces.rdd.getNumPartitions() >= size // small_splits


@pytest.mark.parametrize(
    ("text", "ids"),
    [
        ("", []), ("[]", []), (" \n ", []), ("[ ]\n", []), ('{"id": 3}', [3]), ('﻿[{"id": 3}, {"id": 4}]', [3, 4]), ('﻿[{"id": 3}, {"id": 4}', [3, 4]),
        ('[{"id": 1}, {"id": 2', [1, None]),  # ends inside a record
        ('[{"id": 1}, {"id": 2, "s": "a} {', [1, None]),  # ends inside a string
        ('[{"id": 1}, {"id": 2, "o": {"a": 1}', [1, None]),  # ends after an inner brace
        ('[{"id": 1}, {"id": oops}, {"id": 3}]', [1, None, 3]),  # one bad record
        ('[{"id": 1}]}', [1, None]),  # a brace too many
    ],
)
def test_edges_of_json_arrays(spark, tmp_dir, text, ids):
    with open(f"{tmp_dir}/a.json", "w", encoding="utf-8") as f:
        f.write(text)
    for size in ("5", "1000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = [r["id"] for r in json_arrays.scan_json_array(spark, f"{tmp_dir}/a.json", SCHEMA).collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted(got, key=repr) == sorted(ids, key=repr), (size, text)


def _sizes(df, cuts):
    assert df.where(splits.split_number(cuts).isNull()).count() == 0
    met = [df.where(p).count() for p in cuts]
    assert sum(met) == df.count()  # each row meets one predicate
    return met


def test_equal_depth_on_a_skewed_key(spark, tmp_dir):
    """A third of the rows hold one key, a tenth none; the rest rises steeply."""
    n = 40_000
    key = F.when(F.col("id") % 3 == 0, F.lit(777)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise((F.col("id") * F.col("id") / 1000).cast("long"))
    spark.range(n).select(key.alias("k"), "id").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    cuts = splits.equal_depth_predicates(df, "k", 10, tie="id")
    met = [m for m in _sizes(df, cuts) if m]
    assert max(met) <= 2 * n / 10 and len(met) >= 10
    alone = splits.equal_depth_predicates(df, "k", 10)
    assert max(_sizes(df, alone)) >= n / 3  # without a second column a value stays whole
    width = [df.where((F.col("k") >= a) & (F.col("k") < a + 160_000)).count() for a in range(0, 1_600_000, 160_000)]
    assert max(width) > 2 * n / 10  # what even widths give


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "decimal(12,2)", "double"])
def test_equal_depth_key_types(spark, kind):
    number = F.col("id") * 7 % 1000
    key = F.expr(f"cast(date_add(date'2020-01-01', cast(id * 7 % 1000 as int)) as {kind})") if kind in ("date", "timestamp_ntz") else number.cast(kind)
    df = spark.range(4000).select(key.alias("k"), "id")
    met = _sizes(df, splits.equal_depth_predicates(df, "k", 5))
    assert max(met) <= 2 * 4000 / 5


def test_equal_depth_edges(spark):
    none = spark.createDataFrame([], "k long, t long")
    assert splits.equal_depth_predicates(none, "k", 4) == ["1 = 1"]
    empty = spark.createDataFrame([(None, i) for i in range(50)], "k long, t long")
    assert sum(_sizes(empty, splits.equal_depth_predicates(empty, "k", 4, tie="t"))) == 50
    assert max(_sizes(empty, splits.equal_depth_predicates(empty, "k", 4, tie="t"))) <= 25
    same = spark.createDataFrame([(5, None)] * 50, "k long, t long")
    assert sum(_sizes(same, splits.equal_depth_predicates(same, "k", 4, tie="t"))) == 50
    one = spark.createDataFrame([(5, 1)], "k long, t long")
    assert sum(_sizes(one, splits.equal_depth_predicates(one, "k", 4))) == 1
    with pytest.raises(TypeError):
        splits.equal_depth_predicates(spark.createDataFrame([("a",), ("b",)] * 9, "k string"), "k", 2)


def test_predicates_reach_the_scan(spark):
    df = src.scan_table(spark, "events", path="/root/testdata/sf0.001/events.parquet", predicates=["event_id < 100", "event_id >= 100"], columns=["event_id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(event_id,100)" in plan and "GreaterThanOrEqual(event_id,100)" in plan
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
