"""Time every registered query; prints one JSON line.

Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS (best of, default 2) and
BENCH_QUERIES (comma separated names, default all).
"""

from __future__ import annotations

import json
import os
import time

from docflow import build_session
from docflow.plans.queries import QUERIES


def timed(run) -> float:
    began = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "docflow-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    best = {}
    for name in names:
        # The streaming queries run whole streams: once is enough.
        times = 1 if name.startswith("stream_") else runs
        best[name] = round(min(timed(lambda: QUERIES[name](spark, sf_dir)) for _ in range(times)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
