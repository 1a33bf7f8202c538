"""Headline queries on one scale factor; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Per query: one warm-up, then the median of the runs. Results go to the noop sink, so every
row and column is computed and none is brought to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressgauge.plans.queries import REGISTRY  # noqa: E402
from pressgauge.session import local_session  # noqa: E402

HEADLINE = (
    "clean_content",
    "consolidate_news",
    "duplicate_flag",
    "dedup_against_store",
    "stem_vocab",
    "keyword_match_score",
    "topic_similarity",
    "funnel_by_source",
    "page_text",
    "chunks_words",
    "entities_rules",
    "province_stats",
    "person_network",
    "assign_ids",
    "extractive_summary",
    "doc_embedding",
    "tfidf_top_terms",
)
# After this many seconds a query gets its warm-up and one run only.
PATIENCE = 300.0


def seconds(query, spark, folder: str) -> float:
    begin = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    begin = time.perf_counter()
    times = {}
    for name in HEADLINE:
        seconds(REGISTRY[name], spark, folder)
        left = runs if time.perf_counter() - begin < PATIENCE else 1
        times[name] = round(
            statistics.median(seconds(REGISTRY[name], spark, folder) for _ in range(left)), 3
        )
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
