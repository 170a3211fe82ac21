"""Time the catalogue's queries; prints one JSON line.

`BENCH_SF_DIR` is the folder of tables, `BENCH_CPUS` the number of local cores, `BENCH_RUNS`
the number of timed runs after a warm-up; the fastest run counts. `BENCH_QUERIES` may name a
comma-separated choice.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillstream.plans.catalog import queries  # noqa: E402
from tillstream.session import build_session  # noqa: E402

HEADLINE = (
    "top_cities_hourly", "top_salesmen_hourly_br", "sales_by_city_window", "sales_window_15m",
    "normalize_postgres", "normalize_files", "normalize_legacy", "unify_all_sources",
    "scan_since_mark", "csv_roundtrip", "csv_by_name_roundtrip", "legacy_xml_roundtrip",
    "topic_roundtrip", "rankings_replace", "latest_versions", "latest_rankings_city",
    "rankings_for_window_salesman", "city_response",
    "counter_rate_5m", "counter_rate_6h", "histogram_quantile", "sustained_breaches",
    "latest_gauge", "range_rate_6h", "range_alert_p95", "stream_top_cities_hourly",
    "stream_end_to_end", "stream_alert_lag", "stream_running_ranking",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = queries()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken[1:] or taken), 3)
    print(json.dumps({
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "spark": spark.version,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
