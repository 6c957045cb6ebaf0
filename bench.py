"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from foldmark.queries import all_queries
from foldmark.session import local_session

HEADLINE = (
    "a01_merge_counts",
    "p05_background_subtraction",
    "w02_spread_deletions",
    "w02_reactivity_spread",
    "a10_signal_to_noise",
    "a11_percentile90_nearest_rank",
    "entry_normalized_reactivity",
    "a15_mut_rate_matrix",
    "f02_check_dup",
    "j06_join_read_barcode",
    "j09_merge_pairs",
    "a21_pileup",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "foldmark-bench")
    queries, times = all_queries(), {}
    queries["a05_coverage_max"](spark, sf_dir).count()  # start the JVM's work before timing
    for name in names:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall clock", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
