"""Time the checked queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of cores, BENCH_QUERIES (comma
separated) a part of the queries. Every query is written to the noop sink, so all of its
rows are computed. The best of BENCH_RUNS runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import fixtures, registry  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def run(spark, name: str) -> float:
    started = time.perf_counter()
    registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(registry.QUERIES)
    run(spark, "merge_upsert")
    seconds = {name: round(min(run(spark, name) for _ in range(RUNS)), 3) for name in names}
    changes = fixtures.order_changes(spark, SF_DIR).count()
    result = {
        "metric": "total_elapsed_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "change_rows": changes,
        "rows_per_second": {
            n: round(changes / seconds[n]) for n in ("merge_upsert", "cow_state", "mor_snapshot", "stream_upsert")
            if n in seconds
        },
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
