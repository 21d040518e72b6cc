"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from layerloom.plans.queries import QUERIES
from layerloom.session import build_session

HEADLINE = [
    "build_layer", "normalize_names", "audit_totals", "unresolved_notes", "typed_claims", "spo_observations",
    "extract_wikilinks", "resolve_links", "unlink_missing", "backlinks", "chapter_counts", "chapter_index",
    "arc_of_chapter", "entity_stats", "top_quotes", "batches", "latest_run", "ground_quotes", "lint_findings",
    "render_chapter", "inverted_index", "bm25_topk", "vector_topk", "hybrid_topk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "layerloom-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the JVM's code paths.
    QUERIES["observation_histogram"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
