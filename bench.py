"""Time the registered queries and print one JSON line.

Reads the tables in $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS] (default 8). Every query
runs to its last row, into Spark's no-op sink. A query's time is the lower of two runs, planning
included, after one unrecorded query has started the JVM's machinery.
"""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("wayposts-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def scale(folder: str) -> float | str:
    try:
        return float(folder.removeprefix("sf"))
    except ValueError:
        return folder


def main() -> None:
    chosen = queries()
    if names := sys.argv[1:]:
        chosen = {name: chosen[name] for name in names}
    spark = session()
    seconds(spark, queries()["active_users"])
    times = {
        name: round(min(seconds(spark, query) for _ in range(RUNS)), 3)
        for name, query in chosen.items()
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": scale(Path(SF_DIR).name),
            }
        )
    )


if __name__ == "__main__":
    main()
