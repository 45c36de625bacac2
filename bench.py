"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from brackish.plans.registry import QUERIES, load_all
from brackish.session import local_session

HEADLINE = [
    "skill_metrics", "anomaly_stats", "group_mean_first_count", "valid_fraction_summary", "stratum_rollup",
    "weighted_layer_mean", "layer_weights", "dedupe_preference", "conflict_detect", "stratified_sample",
    "expected_gaps", "snap_time", "gaps_islands", "gap_fill_first_n", "resample_linear", "interpolate_guarded",
    "asof_join", "interval_overlap", "nearest_centroid", "nearest_on_axis", "knn_stations", "tile_coverage",
    "priority_overlay", "point_in_triangle", "bilinear", "triangle_quality", "components", "path_order",
    "gradation_grid", "harmonic_synthesis", "harmonic_fit", "stream_tumbling",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    load_all()
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    sink = lambda name: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    sink(names[0])  # start the workers
    for name in names:
        taken = []
        for _ in range(repeats + 1):  # one warm-up run, as for the documented numbers
            start = time.perf_counter()
            sink(name)
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "total_wall_time", "value": round(sum(times.values()), 4), "unit": "sec", "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "spark": spark.version, "master": spark.sparkContext.master,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
            }
        )
    )


if __name__ == "__main__":
    main()
