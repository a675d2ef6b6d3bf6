"""Time the registered queries on the tables in $BENCH_SF_DIR; print one JSON line.

Each query runs once to warm up and then three times. A run covers all that a
call does, measuring and writing included, and writes its rows to Spark's no-op
sink, so that every column of every row is produced. The figure is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from kudosflow.registry import queries
from kudosflow.session import build_session

HEADLINE = ["gold_best_review", "gold_reviewed_by_engaged"]
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_QUERIES", "").split()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(query) -> float:
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name, query in queries().items():
        if only and name not in only:
            continue
        run(query)
        seconds[name] = round(statistics.median(run(query) for _ in range(RUNS)), 3)
    headline = [seconds[name] for name in HEADLINE if name in seconds]
    print(
        json.dumps(
            {
                "metric": "both gold answers, median of three warm runs",
                "value": round(sum(headline), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
