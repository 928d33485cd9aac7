"""Times the headline queries; prints one JSON line.

The given tables have one row group each, which one task reads; they are first
copied, untimed, into as many files as there are cores.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median
counts. Results are consumed by the no-op sink, so every column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pagesift.session import clear_stages, get_spark, new_path
from pagesift.testbed.queries import QUERIES

HEADLINE = ("simhash", "near_pairs", "near_groups", "child_labels", "article_labels_run", "duplicate_run")


def in_many_files(spark, sf_dir: str, files: int) -> str:
    """A copy of the tables that the headline queries read."""
    path = new_path(spark, "bench")
    for name in ("documents", "pages", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{path}/{name}.parquet")
    return path


def main(names) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    given, sf_dir = sf_dir, in_many_files(spark, sf_dir, int(cpus))
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(given.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    clear_stages(spark)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
