"""Times the jobs of all layers: CSV to staging, dimensions, fact, marts.

Each layer is built from the stored layer below it, nothing is shared between
passes, and every row of a result is computed. The session keeps Spark's default code
cache. The cold pass, during which the JVM compiles, and a warm one are reported
side by side, with the number of Spark jobs; the headline is the warm one. The CSV
files are made from the order tables, which the cold pass counts in. One JSON line.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from starmill.plans.jobs import load_staging
from starmill.plans.marts import MARTS
from starmill.plans.workspace import Workspace
from starmill.sources.csv_files import CsvFolder, write_csv
from starmill.sources.zone import ParquetZone

PASSES = 3


def _compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def one_pass(spark: SparkSession, folder: str, csv: str, zone: str) -> dict[str, float]:
    ws = Workspace(spark, folder)
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("csv_to_staging", lambda: load_staging(spark, CsvFolder(csv), ParquetZone(zone)))
    timed("ods_mock_data", lambda: _compute(ws.staging))
    timed("dimensions", lambda: [_compute(df) for df in ws.dims.values()])
    timed("fact_sales", lambda: _compute(ws.fact))
    for name in MARTS:
        timed(name, lambda: _compute(ws.mart(name)))
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        start = time.perf_counter()
        write_csv(Workspace(spark, folder).staging, f"{scratch}/csv")
        fixture = {"write_csv_fixture": round(time.perf_counter() - start, 3)}
        passes, jobs = [], []
        for n in range(PASSES):
            spark.sparkContext.setJobGroup(f"pass-{n}", f"pass {n}")
            passes.append(one_pass(spark, folder, f"{scratch}/csv", f"{scratch}/zone"))
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"pass-{n}")))
    warm = passes[-1]
    print(json.dumps({
        "metric": "CSV to staging, star and marts, one pass, warm JVM, default code cache",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": {**fixture, **passes[0]},
        "cold_sec": round(sum(fixture.values()) + sum(passes[0].values()), 3),
        "second_pass": passes[1],
        "jobs_per_pass": jobs[-1],
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
