"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and materialises the full
result with the ``noop`` sink (every row computed, nothing collected).
Prints one JSON line: total seconds plus seconds per query. The first query
also pays JVM warm-up; a warm-up run over sf0.001 is done first so the
numbers are warm.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stellate.queries import QUERIES  # noqa: E402
from stellate.session import build_session  # noqa: E402

HEADLINE = [
    "above_average_customers",
    "top_product",
    "sales_by_country",
    "frequent_buyers",
    "csv_scan",
    "fact_lookup",
    "star_row_counts",
    "full_load_fact",
    "merge_dim",
    "merge_fact",
    "merge_fact_partitioned",
    "games_incremental",
    "child_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="stellate-bench", conf={
        "spark.sql.shuffle.partitions": str(int(cpus) * 2),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        QUERIES["above_average_customers"](spark, warm).write.format("noop").mode("overwrite").save()
    times, errors = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # record and go on: one failure must not hide the rest
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "config": {"master": f"local[{cpus}]", "shuffle_partitions": int(cpus) * 2, "aqe": True,
                   "warm": True},
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
