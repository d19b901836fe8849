"""Compare queries with their SQL: python tests/run_oracle.py [folder] [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from tests.compare import connect, difference


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or queries:
        start = time.time()
        try:
            result = queries[name](spark, folder).toArrow()
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name} {result.num_rows} {took:.2f}s")
                continue
            diff = difference(result, con.sql(oracles[name]).to_arrow_table())
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:600]}"
            if len(args) == 1:
                traceback.print_exc()
            result, took = None, time.time() - start
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok'}  {name} {result.num_rows if result else '-'} {took:.2f}s {diff or ''}", flush=True)
    print(f"{bad} failed of {len(args or queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
