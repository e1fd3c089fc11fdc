"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_KEYS (comma separated, default the headline list, ``all`` for every key).
Each query runs once to warm up, then three times (once if that takes over 10 s); the median counts. Results go
to a no-op sink, so every row is produced and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "segment_content segment_include_exclude label_membership pur_buyers pur_first pur_category "
    "pur_amount_total pur_none rmk_converted_range rmk_quota web_cart_abandon web_category "
    "custom_line_value flatten_params flatten_web_events dwell_time precedence_group "
    "visit_event_etl_60s visit_event_etl_30s relation_backfill report_copurchase "
    "report_channel_rating dash_a_info dash_a_click_stay_rel dash_a_top10 dash_b_info "
    "dash_b_timeline dash_b_visitors rfm_features rfm_labels interactions_purchase "
    "quintile_rating blend_recs recs_wide cohort_recs recs_final rec_hit_rate number_batches "
    "agg_basic join_left_enrich topn_per_group als_recommend rfm_kmeans sink_append replace_partition"
).split()


def main() -> None:
    from visitry.catalog import QUERIES
    from visitry.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_KEYS")
    keys = HEADLINE if not wanted else list(QUERIES) if wanted == "all" else wanted.split(",")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(key: str) -> float:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for key in keys:
        first = once(key)
        seconds[key] = round(statistics.median(once(key) for _ in range(runs if first < 10 else 1)), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
