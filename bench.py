"""Wall time of the headline queries at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from opslake import registry
from opslake.session import build_session

HEADLINES = [
    "severity_counts", "minute_agg", "hourly_stats", "daily_stats", "fct_device_health", "fct_alerts", "asof_features",
    "moving_average", "consecutive_breach", "event_sequence", "alert_suppress", "p99_5m", "expectation_report",
    "recent_telemetry", "daily_quota", "release_metrics", "exact_dedup", "chunk_words", "build_vocab", "corpus_profile",
    "extract_paragraphs", "keyword_search", "topk_cosine", "hybrid_search", "adjacent_pairs", "graph_context",
    "stream_minute_agg",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    known = registry.queries()
    names = sys.argv[1:] or (list(known) if os.environ.get("BENCH_ALL") else HEADLINES)
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        if os.environ.get("BENCH_ALL"):
            print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
