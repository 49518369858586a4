"""The incremental daily runner ranks arriving snapshots once and upserts them."""

from pyspark.sql import functions as F

from peerscore.plans import scorecard
from peerscore.sources.tables import read_model, write_model
from peerscore.streaming.daily import run_daily


def test_daily_stream(spark, model, tmp_dir):
    root, out, ckpt = f"{tmp_dir}/model", f"{tmp_dir}/ranking", f"{tmp_dir}/ckpt"
    early = dict(model)
    early["subject"] = model["subject"].where(F.col("snapshot") <= F.lit("1997-12-31").cast("date"))
    write_model(early, root)
    run_daily(spark, root, out, ckpt)
    first = spark.read.parquet(out)
    assert {str(r.snapshot) for r in first.select("snapshot").distinct().collect()} == {
        "1995-12-31", "1996-12-31", "1997-12-31"}
    # later snapshots arrive: only they are processed and added
    late = model["subject"].where(F.col("snapshot") > F.lit("1997-12-31").cast("date"))
    late.write.mode("append").partitionBy("snapshot").parquet(f"{root}/subject")
    run_daily(spark, root, out, ckpt)
    got = {tuple(r) for r in spark.read.parquet(out).drop("modified")
           .withColumn("snapshot", F.col("snapshot").cast("date"))
           .select(*scorecard.RANKING_COLUMNS).collect()}
    exp = {tuple(r) for r in scorecard.rank_all_snapshots(read_model(spark, root)).collect()}
    assert got == exp
    run_daily(spark, root, out, ckpt)  # nothing new: unchanged
    assert spark.read.parquet(out).count() == len(exp)


def test_features_that_arrive_after_their_subjects(spark, model, tmp_dir):
    root, out, ckpt = f"{tmp_dir}/model", f"{tmp_dir}/ranking", f"{tmp_dir}/ckpt"
    day = F.lit("1996-12-31").cast("date")
    early = {k: v.where(F.col("snapshot") <= day) if "snapshot" in v.columns else v for k, v in model.items()}
    late = early["subject_risk"].where(F.col("snapshot") == day)
    early["subject_risk"] = early["subject_risk"].where(F.col("snapshot") < day)
    write_model(early, root)
    run_daily(spark, root, out, ckpt)
    days = lambda: {str(r.snapshot) for r in spark.read.parquet(out).select("snapshot").distinct().collect()}
    assert days() == {"1995-12-31"}
    late.write.mode("append").partitionBy("snapshot").parquet(f"{root}/subject_risk")
    run_daily(spark, root, out, ckpt)
    assert days() == {"1995-12-31", "1996-12-31"}
