"""Time the registered queries: one JSON line on stdout.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_QUERIES`` (comma list or ``all``; default the headline list) and
``BENCH_RUNS`` (default 3: median of that many runs after one warm-up).
Results are forced with a ``noop`` write.  After ``BENCH_BUDGET`` seconds (default
420) the remaining queries get one timed run each.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from clickstrata import catalog
from clickstrata.session import build_session

HEADLINE = [
    "daily_user_funnel", "bid_log_dedup", "plan_hourly", "creative_hourly", "channel_quality", "conversion_daily",
    "device_conversion", "floor_price_histogram", "dimension_cube", "win_rate_report", "media_request_hourly",
    "exchange_hourly", "request_funnel_report", "slot_hour_funnel", "daily_actives", "dimension_report", "split_plan_funnel",
    "content_hour", "content_province", "tag_map", "access_stats_named", "slot_suspicious_ips", "url_day_over_day",
    "lookup_chain", "ip_geo_join", "blacklist_counts", "heavy_hitters", "cheat_list", "device_id_export",
    "behaviour_by_slot_day", "behaviour_daily_table", "click_timing", "most_frequent_values", "crowd_profile",
    "top_items", "top_items_by_group", "cookie_items", "frequent_item_sets", "retention_overlap", "ids_per_range_with_sample",
    "exact_percentile", "plan_kpis", "settlement_report", "write_split_by_key", "upsert_add_and_replace",
    "sliding_top_items", "event_counters_stream", "click_order_enrich_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    queries = catalog.queries()
    names = list(queries) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for i in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds, median per query", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
