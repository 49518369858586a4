"""Run registered Spark queries and their DuckDB oracles side by side (local copy of the gate).

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb


sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    from peerscore.session import local_session
    import __spark_entry__ as e

    spark = local_session(os.environ.get("CORES", "*"))
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as exc:  # report and go on
            print(f"{name:32s} SPARK ERROR {str(exc)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"{name:32s} spark={len(srows):8d} rows  (no oracle)  {t1 - t0:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
        except Exception as exc:
            print(f"{name:32s} ORACLE ERROR {str(exc)[:300]}")
            bad += 1
            continue
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        ok_cols = sorted(scols) == sorted(ocols)
        ok_rows = len(srows) == len(orows)
        ok_vals = ok_cols and rows_of(scols, srows) == rows_of(ocols, orows)
        status = "OK" if (ok_cols and ok_rows and ok_vals) else "MISMATCH"
        bad += status != "OK"
        print(f"{name:32s} spark={len(srows):8d} oracle={len(orows):8d} cols={ok_cols} vals={ok_vals} "
              f"{status} {t1 - t0:.1f}s")
        if status != "OK":
            if not ok_cols:
                print("   spark cols:", scols, "\n   oracle cols:", ocols)
            else:
                a, b = rows_of(scols, srows), rows_of(ocols, orows)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                print("   first diffs:", diff)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
