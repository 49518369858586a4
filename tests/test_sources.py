"""Sources and sinks; the registered driver contract."""

import datetime as dt
import json

from pyspark.sql import functions as F

from peerscore.schemas import table_schema
from peerscore.sources import tables as src

SF = "/root/testdata/sf0.001"


def test_scan_pushdown(spark):
    df = src.scan_table(spark, "orders", path=f"{SF}/orders.parquet", columns=["o_orderkey", "o_totalprice"],
                        where=F.col("o_orderstatus") == "F")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderstatus" in plan
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["o_orderkey", "o_orderstatus", "o_totalprice"]
    assert df.count() > 0


def test_json_array_and_lines(spark, tmp_dir):
    path = f"{tmp_dir}/dump.json"
    rows = [{"id": 120, "category": "Banking", "category_code": "DT-BNK", "first_seen": "2023-01-03",
             "modified": "2023-01-06 10:00:00"}]
    with open(path, "w") as f:
        json.dump(rows, f, indent=2)
    df = src.read_json_array(spark, path, table_schema("group_dim"))
    r = df.first()
    assert r.id == 120 and r.first_seen == dt.date(2023, 1, 3)
    out = src.append_json_lines(df, f"{tmp_dir}/lines", dt.date(2023, 1, 6))
    assert out.endswith("dt=06-01-2023")
    assert spark.read.json(out).count() == 1


def test_model_roundtrip(spark, model, tmp_dir):
    src.write_model(model, f"{tmp_dir}/m")
    back = src.read_model(spark, f"{tmp_dir}/m")
    a = {tuple(r) for r in model["subject_growth"].drop("modified").collect()}
    b = {tuple(r) for r in back["subject_growth"].select(*model["subject_growth"].drop("modified").columns).collect()}
    assert a == b
    # a snapshot filter on the stored table prunes partitions
    plan = back["subject"].where(F.col("snapshot") == F.lit("1998-12-31").cast("date"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot" in plan


def test_run_snapshot():
    assert src.run_snapshot("2023-01-06") == dt.date(2023, 1, 6)
    assert src.run_snapshot(None) == dt.date.today()


def test_entry_contract(spark):
    import __spark_entry__ as e

    from peerscore.plans import registry

    assert set(registry.QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["subject_id", "name", "group_id", "rating", "snapshot", "total_rank", "total_rank_int",
                          "group_rank"]
    assert df.count() > 0


def test_bucketed_model_joins_without_shuffle(spark, model, tmp_dir):
    from peerscore.operators.assemble import assemble_subject

    src.write_model_bucketed(spark, model, f"{tmp_dir}/b", 4, database="pm_test")
    bucketed = src.read_model_bucketed(spark, f"{tmp_dir}/b", 4, database="pm_test")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = assemble_subject(bucketed)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        got = {tuple(r) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exp = {tuple(r) for r in assemble_subject(model).select(*df.columns).collect()}
    assert got == exp


def test_save_table_overwrite(spark, tmp_dir):
    path = f"{tmp_dir}/saved"
    first = spark.createDataFrame([(1, "2023-01-05"), (2, "2023-01-06")], "k int, snapshot string")
    src.save_table(first, path, partition_cols=["snapshot"])
    second = spark.createDataFrame([(3, "2023-01-06")], "k int, snapshot string")
    src.save_table(second, path, partition_cols=["snapshot"])  # plain overwrite replaces the whole table
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [3]
