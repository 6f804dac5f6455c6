"""Headline queries, one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.

Every query is run once with all result rows computed. ``store_cleaned_events`` and ``store_daily_files`` write the tables
that other queries read, so their times are part of the total.
"""

from __future__ import annotations

import json
import os
import re
import time

from trailmark.plans import registry
from trailmark.session import local_session

HEADLINE = (
    "clean_events",
    "dq_report",
    "sessions",
    "sessions_event_grain",
    "session_event_sequence",
    "users",
    "purchase_attribution",
    "channel_revenue_last_click",
    "daily_revenue",
    "conversion_rate_by_channel",
    "conversion_rate_client_join",
    "revenue_by_device",
    "assisted_vs_direct",
    "top_products",
    "monitor_report",
    "union_drifted_files",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()

    times: dict[str, float] = {}
    for name, store in (("store_cleaned_events", registry.cleaned_path), ("store_daily_files", registry.daily_files)):
        start = time.perf_counter()
        store(spark, sf_dir)
        times[name] = round(time.perf_counter() - start, 3)
    queries = registry.all_queries()
    for name in os.environ.get("BENCH_ONLY", ",".join(HEADLINE)).split(","):
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
