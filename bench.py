"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_RUNS    timed runs per query after one warm-up; the best counts (default 2)
BENCH_QUERIES names separated by commas instead of the headline queries
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from freshet.plans.queries import QUERIES  # noqa: E402
from freshet.session import build_session  # noqa: E402

HEADLINE = [
    "rolling_7d_spend_avg",
    "top_merchant_category",
    "anomaly_score",
    "rfm",
    "user_features_wide",
    "feature_table_roundtrip",
    "feature_row_count",
    "topk_monetary_desc",
    "drift_summary",
    "user_feature_vector",
    "tumbling_1min",
    "sliding_5min_1min",
    "window_multi",
    "rolling_7d_spend",
    "order_count_24h",
    "avg_basket_size",
    "preferred_category",
    "session_count_1h",
    "event_validation",
    "latest_value",
    "entity_freshness",
    "sla_sweep",
    "point_in_time_latest",
    "snapshot_diff",
    "registry_merge",
    "audit_compaction",
    "stream_tumbling_1hr",
    "stream_latest_value",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "freshet-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    chosen = os.environ.get("BENCH_QUERIES")
    for name in chosen.split(",") if chosen else HEADLINE:
        best = float("inf")
        for run in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
            if run:
                best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", root)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
