"""Benchmark of the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS], forcing full evaluation with the ``noop`` sink, and
prints one JSON line: warm median seconds per query and their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedlake.plans import catalog  # noqa: E402
from feedlake.session import get_session  # noqa: E402

HEADLINE = [
    "clean_html",            # P4-P6 on pages
    "clip_text",             # X1 on documents
    "normalize_items",       # P1 + registry gate
    "items_per_run",         # J6 range join, events
    "new_per_run",           # C1 multi-run dedup
    "parse_responses",       # X18/X19 VARIANT parse
    "daily_top",             # W2 on events
    "daily_other",           # W3, skew-safe ordinal
    "verdict_upsert",        # K3 on events
    "pack_requests",         # M1
    "weekly_report",         # R1-R6 long form
    "order_week_totals",     # A5 on orders x lineitem
    "order_recap_top",       # W5 on orders x lineitem
    "order_category_ranked",  # W6 on orders x lineitem
    "rubric_score",          # M6
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    keys = sys.argv[1:] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    for k in keys:
        q = catalog.QUERIES[k]
        runs = []
        for i in range(reps + 1):          # first run warms up
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[k] = round(statistics.median(runs), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))


if __name__ == "__main__":
    main()
