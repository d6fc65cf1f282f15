"""Time every registered query on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

The shared split table is staged first and timed as ``stage_splits``. BENCH_KEYS
(comma separated) restricts the run while iterating.
"""

from __future__ import annotations

import json
import os
import time

from registry import QUERIES
from tastemill.plans.staging import splits
from tastemill.session import local_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", memory="16g")
    spark.range(1000).selectExpr("sum(id)").collect()
    wanted = os.environ.get("BENCH_KEYS")
    keys = wanted.split(",") if wanted else list(QUERIES)
    times = {}
    start = time.perf_counter()
    splits(spark, sf_dir)
    times["stage_splits"] = round(time.perf_counter() - start, 3)
    for key in keys:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
