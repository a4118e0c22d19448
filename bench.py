"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs once to warm up and three times for the median, into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barlens.sample.queries import QUERIES  # noqa: E402
from barlens.session import build_session  # noqa: E402

HEADLINE = (
    "bars_daily", "moving_averages", "moving_averages_frame", "moving_averages_prefix", "returns",
    "drawdown",
    "volume_profile", "monthly_returns", "monthly_volatility", "volatility_join",
    "feature_table_all", "feature_table_hot_key", "latest_bar", "decode_messages", "standardised",
    "window_metrics_batch", "move_alerts_batch", "window_metrics_stream", "archive_merged",
    "archive_written", "upsert_documents",
)
# Queries that write tables: one timed run after the warm-up.
ONCE = {"window_metrics_stream", "archive_written", "upsert_documents"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "barlens-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2 if name in ONCE else 4):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(os.path.normpath(folder))
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of warm medians (queries that write tables: one warm run)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.removeprefix("sf")) if scale.startswith("sf") else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
