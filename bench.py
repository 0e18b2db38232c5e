"""Time the headline queries and print one JSON line.

Every query runs to completion into a sink that drops its rows: all of them once, and then again up to ``BENCH_RUNS`` (3) times in
all, as long as ``BENCH_SECONDS`` (600) last. The medians are printed; the first round of several counts as the warm-up and is
left out, ``rounds`` says how many count. Queries on models read the typed tables, which the session's first such query writes;
``typed_layers`` is the time of writing them. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` (comma-separated, or ``all``) set what runs and on what.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from stratiform.session import local_session  # noqa: E402
from stratiform.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "supplier_trends", "customer_scorecard", "collapse_duplicates", "duplicate_profile", "keep_first", "latest_per_key",
    "fill_missing", "stage_core", "typed_layers", "typed_core", "typed_ratings", "minmax_ratings", "explode_list", "merge_articles",
    "repair_amounts", "company_bridge", "company_year_metrics", "group_year_metrics", "name_dimension", "group_year_fact",
    "trend_bands", "company_scorecard", "key_quality", "check_relationships", "build_log_tasks", "land_csv",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or list(HEADLINE)
    spark = local_session("stratiform-bench", cpus)
    spark.read.parquet(f"{sf}/orders.parquet").groupBy("o_orderstatus").count().collect()
    runs, end = int(os.environ.get("BENCH_RUNS", "3")), time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "600"))
    taken: dict[str, list[float]] = {name: [] for name in names}
    for k in range(runs + (runs > 1)):
        began = time.perf_counter()
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken[name].append(time.perf_counter() - start)
        if time.perf_counter() + 1.2 * (time.perf_counter() - began) > end:
            break
    rounds = max(1, min(map(len, taken.values())) - 1)
    times = {name: round(statistics.median(x[1:] or x), 3) for name, x in taken.items()}
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "rounds": rounds, "queries": times, "sf": Path(sf).name}))


if __name__ == "__main__":
    main()
