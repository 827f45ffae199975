"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names, default the list below, or "all").
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from murmuration.plans import catalog
from murmuration.runtime import local_session

HEADLINE = [
    "post_activity_30m", "activity_digest", "resolve_replies", "activity_bounds",
    "monotone_posts", "clean_likes", "clean_replies", "late_rows",
    "tokens", "bad_words", "word_counts", "feature_long", "feature_stats", "outliers_on_update",
    "aff_static_total", "aff_colike", "aff_window_scores", "aff_top5", "sliding_counts", "chained_windows",
]


def run(query, spark, sf_dir: str) -> float:
    """Seconds to plan and compute every row; the result is consumed, not stored."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not chosen else catalog.QUERY_NAMES if chosen == "all" else chosen.split(",")
    queries = catalog.queries()
    # One untimed query starts the JVM's code generation and opens the files.
    run(queries["chained_windows"], spark, sf_dir)
    seconds = {name: round(run(queries[name], spark, sf_dir), 3) for name in names}
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
