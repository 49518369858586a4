"""Benchmark of the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The scorecard model is derived from the test tables and stored once, partitioned
by snapshot (as the daily job would find it); ``build_model`` times that step.
Each query is executed in full with the ``noop`` sink (no driver collect).
The bucketed-storage rows are reported for contrast, not part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from peerscore.operators import assemble, extract, ranking  # noqa: E402
from peerscore.plans import dashboards, registry, scorecard  # noqa: E402
from peerscore.session import checkpoint_dir, local_session  # noqa: E402
from peerscore.sources.demo import testdata_model  # noqa: E402
from peerscore.sources.tables import (  # noqa: E402
    read_model,
    read_model_bucketed,
    write_model,
    write_model_bucketed,
)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=max(8, 2 * int(CPUS)), app="peerscore-bench")
    spark.sparkContext.setLogLevel("ERROR")
    root = checkpoint_dir(spark)
    store = f"{root.rstrip('/')}/model-{os.getpid()}"

    # warm-up (JVM, code generation), not timed
    _run(spark.read.parquet(f"{SF_DIR}/region.parquet").groupBy("r_regionkey").count())

    times: dict[str, float] = {}
    times["build_model"] = _timed(lambda: write_model(testdata_model(spark, SF_DIR, checkpoint_stats=True), store))
    model = read_model(spark, store)
    rank_date = registry.RANK_DATE
    # one group of one snapshot holds half of the rows
    half = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    hot = model["subject"].withColumn("group_id", F.when(half, F.lit(1)).otherwise(F.col("group_id"))).withColumn(
        "snapshot", F.when(half, F.lit(rank_date).cast("date")).otherwise(F.col("snapshot")))

    headline = {
        "rank_snapshot": lambda: _run(scorecard.rank_snapshot(model, rank_date)),
        "rank_all_snapshots": lambda: _run(scorecard.rank_all_snapshots(model)),
        "horizon_comparison": lambda: _run(dashboards.horizon_comparison(model)),
        "coverage_fanout": lambda: _run(assemble.coverage_fanout(model)),
        "upsert_last_wins": lambda: _run(registry.upsert_last_wins(spark, SF_DIR)),
        "upsert_keep_first": lambda: _run(registry.upsert_keep_first(spark, SF_DIR)),
        "upsert_dated": lambda: _run(registry.upsert_dated(spark, SF_DIR)),
        "audit_duplicate_keys": lambda: _run(registry.audit_duplicate_keys(spark, SF_DIR)),
        "extract_links": lambda: _run(extract.extract_links(spark.read.parquet(f"{SF_DIR}/pages.parquet"))),
        "rank_from_testdata": lambda: _run(registry.rank_all_snapshots(spark, SF_DIR)),
        "rank_hot_group": lambda: _run(ranking.add_dense_ranks(hot, scorecard.RANK_SPECS[:2], ["group_id", "snapshot"])),
        "rank_and_store": lambda: scorecard.rank_and_store(spark, model, f"{root.rstrip('/')}/ranking-{os.getpid()}", rank_date, rank_date),
    }
    for name, fn in headline.items():
        times[name] = _timed(fn)
    contrast = {}
    # co-located storage: subject tables bucketed on (subject, snapshot); their joins need no shuffle
    bstore = f"{root.rstrip('/')}/model-bucketed-{os.getpid()}"
    contrast["build_model_bucketed"] = _timed(lambda: write_model_bucketed(spark, model, bstore, int(CPUS)))
    bucketed = read_model_bucketed(spark, bstore, int(CPUS))
    contrast["rank_all_snapshots_bucketed"] = _timed(lambda: _run(scorecard.rank_all_snapshots(bucketed)))

    rows = model["subject"].count()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_total",
        "value": total,
        "unit": "sec",
        "queries": {**times, **contrast},
        "sf": SF_DIR.rstrip("/").split("sf")[-1],
        "cpus": int(CPUS),
        "subject_rows": rows,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
