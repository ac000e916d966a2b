"""Time headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and run RUNS times (once only when the time for all of them,
BENCH_SECONDS, is used up); its figure is the fastest run. A query that fails is
listed under ``errors`` and the others go on. Figures are also printed to the
error stream as they come, and a run that is told to end prints what it has.
"""

from __future__ import annotations

import json
import os
import signal
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trovelake.registry import BOOK  # noqa: E402
from trovelake.session import tune  # noqa: E402

HEADLINES = [
    "flt01_eq", "flt16_and_division", "flt18_acl", "flt22_time_range", "flt23_path_subtree",
    "act04_metaquery", "join02_batched_metaquery", "flt23_batched_subtree", "join04_avus",
    "join09_resource_location", "join13_descendants", "agg01_nested_avus",
    "agg02_checksum_conflict", "act01_list_object", "act03_contents", "act05_metamod_add",
    "act12_checksum_verify", "act18_move_collection", "snk03_upsert",
    "sql06_data_modified_partial", "str04_fold",
]
RUNS = 3
SECONDS = float(os.environ.get("BENCH_SECONDS", "600"))


def timed(spark: SparkSession, folder: str, name: str) -> float:
    start = time.perf_counter()
    BOOK[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def report(runs: dict[str, list[float]], errors: dict[str, str], folder: str,
           wall: float) -> None:
    seconds = {name: round(min(took), 3) for name, took in runs.items()}
    print(json.dumps({
        "metric": "sum of headline query times",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "median": round(statistics.median(seconds.values()), 3) if seconds else None,
        "runs": {name: [round(t, 3) for t in took] for name, took in runs.items()},
        "errors": errors, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "wall": round(wall, 1),
    }), flush=True)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = tune(
        SparkSession.builder.master(f"local[{cpus}]").appName("trovelake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    start = time.perf_counter()
    runs: dict[str, list[float]] = {}
    errors: dict[str, str] = {}

    def ended(*_) -> None:
        report(runs, errors, folder, time.perf_counter() - start)
        os._exit(0)

    signal.signal(signal.SIGTERM, ended)
    timed(spark, folder, HEADLINES[0])  # start the JVM's compilers before measuring
    for turn in range(RUNS):
        for name in HEADLINES:
            if name in errors or (turn and time.perf_counter() - start > SECONDS):
                continue
            try:
                took = timed(spark, folder, name)
            except Exception as problem:  # the others still have figures
                errors[name] = f"{type(problem).__name__}: {str(problem)[:200]}"
                print(f"{name} failed: {errors[name]}", file=sys.stderr, flush=True)
                continue
            runs.setdefault(name, []).append(took)
            print(f"{name} {took:.2f}s", file=sys.stderr, flush=True)
    report(runs, errors, folder, time.perf_counter() - start)
    spark.stop()


if __name__ == "__main__":
    main()
