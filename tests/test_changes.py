"""Change-only upserts, maintained group extremes and the incremental ranking."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from peerscore.operators.changes import changed_rows, extremes_state, merge_extremes, upsert_changed
from peerscore.plans import incremental, scorecard
from peerscore.schemas import GROUP_ID, GROUP_KEYS, SNAPSHOT

D1, D2 = dt.date(2023, 1, 5), dt.date(2023, 1, 6)
NAN = float("nan")


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_changed_rows_compare_null_and_nan(spark):
    s = "k int, v double, t string"
    old = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (3, NAN, None), (None, 4.0, "d"), (5, 5.0, None)], s)
    new = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (3, NAN, None), (None, 4.0, "d"), (5, 5.0, "x"), (6, None, None)], s)
    assert [r[0] for r in _rows(changed_rows(old, new, ["k"]))] == [2, 5, 6]


def test_a_repeated_batch_writes_no_file(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = [(i, D1 if i % 2 else D2, float(i)) for i in range(200)] + [(None, D1, None), (7, None, 1.0)]
    batch = spark.createDataFrame(rows, "k int, snapshot date, v double")
    keys, part = ["k", "snapshot"], ["snapshot"]
    assert upsert_changed(spark, path, batch, keys, partition_cols=part, buckets=8).count() == 202
    before = _files(path)
    assert upsert_changed(spark, path, batch, keys, partition_cols=part, buckets=8).count() == 0
    assert upsert_changed(spark, path, batch.limit(0), keys, partition_cols=part).count() == 0
    assert _files(path) == before
    # one changed and one equal row: one partition is rewritten, whatever bucket number the caller names
    late = spark.createDataFrame([(3, D1, 30.0, 2), (3, D1, 29.0, 1), (5, D1, 5.0, 1)], "k int, snapshot date, v double, o int")
    out = upsert_changed(spark, path, late, keys, ["o"], part, buckets=3, columns=["k", "snapshot", "v"])
    assert _rows(out) == [(3, D1, 30.0)]
    after = _files(path)
    assert len({os.path.dirname(f) for f in set(before.items()) ^ set(after.items()) for f in [f[0]]}) == 1
    got = {(r.k, r.snapshot): r.v for r in spark.read.parquet(path).collect()}
    assert got == {**{(k, d): v for k, d, v in rows}, (3, D1): 30.0}


def test_extremes_equal_a_fresh_state(spark):
    s = "g int, id int, v double, w double"
    base = [(g, g * 100 + i, float((i * 7) % 11), None if i % 3 else float(i)) for g in range(6) for i in range(12)]
    base += [(None, 900, 1.0, 2.0), (None, 901, 3.0, 4.0), (9, 950, 1.0, 1.0)]
    cols, keys = ["v", "w"], ["g"]
    gone = [r for r in base if r[1] in (105, 203, 900, 950, 308)]
    came = [(1, 105, 50.0, None), (2, 203, None, 1.0), (7, 700, 1.0, NAN), (3, 308, 5.0, 5.0)]
    left = [r for r in base if r not in gone] + came
    df = lambda r: spark.createDataFrame(r, s)
    state = extremes_state(df(base), cols, keys)
    got = merge_extremes(state, df(came), df(gone), df(left), cols, keys)
    assert repr(_rows(got)) == repr(_rows(extremes_state(df(left), cols, keys)))  # as text: NaN is not NaN in Python
    same = merge_extremes(state, df(base).limit(0), df(base).limit(0), df(base), cols, keys)
    assert repr(_rows(same)) == repr(_rows(state))


def test_incremental_ranking_equals_a_full_one(spark, model, tmp_dir):
    path = f"{tmp_dir}/ranking"
    day, group = dt.date(1998, 12, 31), model["subject"].where("snapshot = date'1998-12-31'").agg(F.min(GROUP_ID)).first()[0]
    own = model["subject"].where((F.col(SNAPSHOT) == F.lit(day)) & (F.col(GROUP_ID) == group)).select(F.col("id").alias("subject_id"), SNAPSHOT)
    late = model["subject_risk"].join(own, ["subject_id", SNAPSHOT], "left_semi")
    first = {**model, "subject_risk": model["subject_risk"].join(own, ["subject_id", SNAPSHOT], "left_anti")}
    incremental.rank_changes_and_store(spark, first, path, buckets=4)
    assert spark.read.parquet(path).where((F.col(GROUP_ID) == group) & (F.col(SNAPSHOT) == F.lit(day))).isEmpty()
    before = _files(path)
    got = incremental.rank_changes_and_store(spark, model, path, {"subject_risk": late}).drop("modified")
    full = scorecard.rank_all_snapshots(model)
    assert _rows(got.select(*full.columns)) == _rows(full)
    # only the one snapshot and bucket was written
    touched = {os.path.dirname(f) for f, _ in set(before.items()) ^ set(_files(path).items())}
    assert len(touched) == 1 and f"snapshot={day}" in touched.pop()
    # the rows leave again: the group loses its ranking, the others keep theirs
    back = incremental.rank_changes_and_store(spark, first, path, {"subject_risk": late}).drop("modified")
    rest = full.where((F.col(GROUP_ID) != group) | (F.col(SNAPSHOT) != F.lit(day)))
    assert _rows(back.select(*full.columns)) == _rows(rest)


def test_a_moved_subject_alters_both_groups(spark, model):
    ranking = scorecard.rank_all_snapshots(model)
    row = ranking.orderBy("snapshot", "subject_id").first()
    moved = spark.createDataFrame([(row.subject_id, row.group_id + 1000, row.snapshot)], "id bigint, group_id int, snapshot date")
    keys = incremental.affected_keys(model, {"subject": moved}, ranking)
    assert _rows(keys.select(*GROUP_KEYS)) == sorted([(row.group_id, row.snapshot), (row.group_id + 1000, row.snapshot)])
    assert incremental.affected_keys(model, {}).count() == 0
