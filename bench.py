"""Time every query on $BENCH_SF_DIR with local[$BENCH_CPUS] and print one JSON line.

Each query is run once to warm up and then BENCH_RUNS times (2 by default); its number
is the median. Results are computed in full and thrown away.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from inkwell.plans.catalog import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
MEMORY = os.environ.get("BENCH_MEMORY", "4g")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", MEMORY)
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run, spark) -> float:
    start = time.perf_counter()
    run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    spark = session()
    times = {}
    for name in names or QUERIES:
        seconds(QUERIES[name], spark)
        runs = [seconds(QUERIES[name], spark) for _ in range(RUNS)]
        times[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "memory": MEMORY,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
