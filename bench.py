"""Seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (default 3):
median of the repeats after one warm-up run, whole result materialized; heavy entries are measured once.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagloom import registry  # noqa: E402
from tagloom.queries import load_all  # noqa: E402

HEADLINE = [
    "label_facts", "mapping_summary", "unresolved_groups", "cluster_counters", "discover_labels",
    "cell_updates", "centroids_rebuild", "knn", "semantic_search", "field_health", "mapper_field_health",
    "decide_labels", "run_mapping", "map_stream", "weekly_run", "backfill_run", "communities", "density_cluster",
]
#: Whole runs and iterative operators take this long or longer: one warm-up and one measured run each.
HEAVY = {"map_stream", "weekly_run", "backfill_run", "communities", "density_cluster"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tagloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(2 if name in HEAVY else repeat + 1):
            start = time.perf_counter()
            registry.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {[round(x, 2) for x in times]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
