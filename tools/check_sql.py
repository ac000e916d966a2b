"""Run registered queries on Spark and their SQL on DuckDB, and compare.

    python tools/check_sql.py [sf folder] [name prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from trovelake.registry import BOOK  # noqa: E402
from trovelake.sources.tables import COLUMNS  # noqa: E402


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in [*COLUMNS, "embeddings"]:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    bad = 0
    for name, entry in BOOK.items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = entry.run(spark, folder)
            got = canonical(df.columns, df.collect())
        except Exception as exc:  # report and go on with the other queries
            print(f"FAIL {name}: {type(exc).__name__} {str(exc)[:600]}", flush=True)
            bad += 1
            continue
        took = time.time() - start
        if entry.sql is None:
            print(f"rows {name}: {len(got[1])} rows, {took:.1f}s", flush=True)
            continue
        try:
            result = con.execute(entry.sql)
            want = canonical([d[0] for d in result.description], result.fetchall())
        except Exception as exc:
            print(f"FAIL {name}: SQL {str(exc)[:600]}", flush=True)
            bad += 1
            continue
        if got == want:
            note = "ok  " if got[1] else "ok? EMPTY"
            print(f"{note} {name}: {len(got[1])} rows, {took:.1f}s", flush=True)
        else:
            bad += 1
            only = [r for r in got[1] if r not in set(want[1])][:2]
            lost = [r for r in want[1] if r not in set(got[1])][:2]
            print(f"DIFF {name}: {len(got[1])} vs {len(want[1])} rows {got[0]} {want[0]}\n"
                  f"  spark only {only}\n  sql only   {lost}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
