"""The dated job: rank a day, a range of days or the whole history and store the result.

    python -m peerscore.job --model ROOT --ranking PATH [--cur_date D | --start D --end D | --all]

Without a date the run's day is today.
"""

from __future__ import annotations

import argparse
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from peerscore.plans.scorecard import rank_and_store
from peerscore.sources.tables import read_model, run_snapshot


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Rank subjects inside their groups and store the ranking.")
    p.add_argument("--model", required=True, help="folder of the stored model")
    p.add_argument("--ranking", required=True, help="folder of the ranking table")
    p.add_argument("--cur_date", type=run_snapshot, help="the snapshot to rank (default: today)")
    p.add_argument("--start", type=run_snapshot, help="first snapshot of a range")
    p.add_argument("--end", type=run_snapshot, help="last snapshot of a range")
    p.add_argument("--all", action="store_true", help="the whole history")
    args = p.parse_args(argv)
    if sum((args.all, args.cur_date is not None, args.start is not None or args.end is not None)) > 1:
        p.error("give one of --cur_date, --start/--end and --all")
    return args


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Run the job; returns the stored ranking."""
    args = parse(argv)
    spark = spark or SparkSession.builder.appName("peerscore-job").getOrCreate()
    start, end = args.start, args.end
    if not args.all and start is None and end is None:
        start = end = run_snapshot(args.cur_date)
    return rank_and_store(spark, read_model(spark, args.model), args.ranking, start, end)


if __name__ == "__main__":
    main()
