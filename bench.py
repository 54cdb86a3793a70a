"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 3) and BENCH_QUERIES (comma-separated names, or "all") select the run.
Each figure is the median after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from shelfmark.registry import load
from shelfmark.session import build_session

HEADLINE = (
    "category_stats",
    "quote_tags_excerpt",
    "price_window",
    "price_window_full",
    "author_profile",
    "opportunity_score",
    "dashboard",
    "dq_report",
    "top_authors_view",
    "top3_per_category",
    "city_centroids",
    "quotes_per_tag",
    "tags_per_author",
    "clean_books",
    "clean_quotes",
    "dedup_keep_first",
    "validation_stats",
    "contact_hash",
    "retention_purge",
    "erase_requests",
    "fact_insert_if_absent",
    "delete_cascade",
    "menu_links",
    "page_text",
    "geocode_join",
)


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    queries, _ = load()
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        if runs > 1:
            once(name)
        times[name] = round(statistics.median(once(name) for _ in range(max(1, runs - 1))), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line), flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
