"""Time all queries on the sample tables and print one JSON line.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` the cores,
``BENCH_QUERIES`` an optional comma-separated choice. Each query runs once unmeasured, so that
code generation and the file cache are warm, and once measured: planning plus full execution of
every output column into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from tallyhouse.plans.queries import all_queries
from tallyhouse.session import open_session

def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    chosen = os.environ.get("BENCH_QUERIES", "").split(",")
    names = [name for name in chosen if name] or list(all_queries())
    spark = open_session(
        "tallyhouse-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        df = queries[name](spark, directory)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", directory)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
