"""Run every registered query against its DuckDB oracle and print a table.

    python tests/run_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare, duck  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", os.environ.get("ORACLE_SESSION_TZ", "UTC")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, q in entry.queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = q(spark, sf_dir)
            if name in oracles:
                ok, msg = compare(df, con, oracles[name])
            else:
                ok, msg = True, f"{df.count()} rows (no oracle)"
        except Exception as e:  # report and go on
            ok, msg = False, f"{type(e).__name__}: {str(e)[:300]}"
        failed += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:24s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
