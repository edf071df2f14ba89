"""Wall time of the business questions and the global windows, as one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.
Rows are materialised in full through the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind.catalog import ENTRIES  # noqa: E402
from tradewind.session import local_session  # noqa: E402

# query prefixes of the headline set: business questions, windows, cleaning, SCD
HEADLINE = ("BQ-", "WN-", "SD-", "DQ-18", "DQ-29")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def once(key: str) -> float:
        start = time.perf_counter()
        ENTRIES[key].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for key, entry in ENTRIES.items():
        if entry.id.startswith(HEADLINE):
            once(key)
            times[key] = round(statistics.median(once(key) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
