"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times into a sink that keeps
nothing; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from boxtrail.queries import QUERIES, load_all  # noqa: E402
from boxtrail.session import build_session  # noqa: E402

HEADLINE = (
    "flag_relationship",
    "link_deboning",
    "link_origin",
    "trace_all",
    "trace_all_reset",
    "trace_period",
    "dedup_by_id",
    "upsert_by_id",
    "mark_processed",
    "sale_trace",
    "proc_sale_header",
    "ingest_animals",
    "ingest_mapped",
    "log_metrics",
)
RUNS = 3


def timed(spark, key: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "boxtrail-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    keys = sys.argv[1:] or HEADLINE
    seconds = {}
    for key in keys:
        timed(spark, key, sf_dir)
        seconds[key] = round(statistics.median(timed(spark, key, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "median seconds, all headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
