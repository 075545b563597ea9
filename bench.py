"""Time the headline queries; prints one JSON line.

Each query runs once untimed, so that the times are those of a running session
(compiled code, warm JVM) and not of its start; then once timed, in full.
"""

from __future__ import annotations

import json
import os
import time

from pitchlake.registry import QUERIES
from pitchlake.session import build_session

HEADLINE = [
    "artifact_fingerprint", "manifest_register", "bronze_events", "silver_events", "fact_gold_team",
    "fact_gold_intervals", "team_season_summary", "match_summary", "xg_timeline", "xt_momentum",
    "player_xt_leaders", "orientation_check", "dq_silver", "reconcile_bronze_silver", "silver_pinned_read",
    "gold_incremental", "discover_new_matches", "silver_volume_monitor", "current_health", "run_stage_matrix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        run(name)
    seconds = {name: run(name) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
