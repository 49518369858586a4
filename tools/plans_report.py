"""Write PLANS.md: the physical plan outline of the flagship queries (run from the repo root).

    python tools/plans_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from peerscore.operators import assemble  # noqa: E402
from peerscore.plans import dashboards, scorecard  # noqa: E402
from peerscore.session import local_session, scratch_path  # noqa: E402
from peerscore.sources.demo import testdata_model  # noqa: E402
from peerscore.sources.tables import read_model, write_model  # noqa: E402


def outline(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    keep = []
    for line in plan.splitlines():
        if re.search(r"Exchange|Join|Window \[|HashAggregate|FileScan|Sort \[|Union|Broadcast|AdaptiveSparkPlan|"
                     r"AQEShuffleRead|ReusedExchange|Generate|TakeOrdered", line):
            line = re.sub(r"#\d+L?", "", line)
            keep.append(line[:200])
    return "\n".join(keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "plans")
    write_model(testdata_model(spark, sf), root)
    model = read_model(spark, root)
    parts = ["# Physical plans of the flagship queries", "",
             f"Generated by `tools/plans_report.py` on `{sf}` (model stored partitioned by snapshot); "
             "operator lines only, expression ids removed.", ""]
    cases = [
        ("rank_snapshot (C1), default settings", lambda: scorecard.rank_snapshot(model, "1998-12-31")),
        ("horizon_comparison (C3), default settings", lambda: dashboards.horizon_comparison(model)),
    ]
    for title, build in cases:
        parts += [f"## {title}", "", "```", outline(build()), "```", ""]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    parts += ["## assemble_wide (J4), broadcasts disabled (the large-scale shape)", "", "```",
              outline(assemble.assemble_wide(model)), "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
