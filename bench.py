"""Headline-query timings: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through the ``noop`` sink (full execution, no
driver collect); the first run of each query is a warm-up when BENCH_WARMUP=1.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["cost_cube", "flatten_scores", "preprocess_pipeline", "processing_report",
            "score_rollup", "parse_rubric", "cost_by_submission", "classify_files"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from scorewright.session import get_session
    from scorewright.plans.registry import QUERIES, load_all
    load_all()
    spark = get_session(f"local[{cpus}]", app="scorewright-bench", shuffle_partitions=cpus)
    if os.environ.get("BENCH_WARMUP", "1") == "1":
        QUERIES["classify_files"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
