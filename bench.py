"""Time every query of the library and print one JSON line.

`BENCH_SF_DIR` names the data, `BENCH_CPUS` the cores, `BENCH_QUERIES` (comma
separated) names some queries only, `BENCH_RUNS` the runs per query, of which
the best counts.  Results go to the `noop` sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import time

from recordferry.plans.queries import queries
from recordferry.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def seconds(run, runs: int) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    registered = queries()
    names = os.environ.get("BENCH_QUERIES", ",".join(registered)).split(",")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    for name in ("match_report", "parties_load"):  # compile and touch what most queries use
        seconds(lambda: registered[name](spark, SF_DIR), 1)
    timings, rows = {}, {}
    for name in names:
        timings[name] = seconds(lambda: registered[name](spark, SF_DIR), runs)
        rows[name] = registered[name](spark, SF_DIR).count()
    print(json.dumps({
        "metric": "total seconds of all queries", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": SF_DIR.rsplit("sf", 1)[-1], "rows": rows,
        "rows_per_sec": {name: round(rows[name] / timings[name]) for name in names}}))
    spark.stop()


if __name__ == "__main__":
    main()
