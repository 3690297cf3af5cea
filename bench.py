"""Benchmark the headline queries; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run once to warm up, then ``BENCH_RUNS`` times (default 3);
the median is reported. A run starts from an empty cache, computes the whole
result and discards it through the ``noop`` sink, so nothing is collected to
the driver and the measured time is the distributed work itself.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry import registry  # noqa: E402
from quarry.session import local_session  # noqa: E402

HEADLINE = [
    "iqr_remove", "iqr_remove_grouped", "iqr_flag", "iqr_report", "quartiles_exact",
    "quartiles_grouped", "quartiles_approx", "validate_errors", "error_summary", "group_stats",
    "profile_numeric", "histogram", "box_stats", "correlation_pairs", "crosstab", "value_counts",
    "t_test_p", "chi_square_p", "row_generator", "batch_generator", "enrich_join", "report",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    # Operators persist small intermediates (sketches, counted join sides);
    # an identical plan would find them cached from the previous run, so every
    # run starts from an empty cache and does the whole work.
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus=cpus)
    times: dict[str, float] = {}
    for name in names:
        run_once(spark, name, sf_dir)
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 4),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
