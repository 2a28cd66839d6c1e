"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores. Each query gets one warm-up and the
median of three runs, evaluated in full into Spark's no-op sink (queries about writes do
their writing while they are called).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tierfold.checks.queries import QUERIES  # noqa: E402
from tierfold.session import build_session  # noqa: E402

HEADLINE = (
    "clean_patient",
    "clean_user",
    "identifier_concat",
    "timestamp_repair",
    "patient_user_join",
    "user_activity_agg",
    "merge_upsert",
    "append_partitioned",
    "merge_written",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, rows = {}, {}
    for name in HEADLINE:
        rows[name] = QUERIES[name](spark, sf_dir).count()  # warm-up
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
