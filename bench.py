"""Time the headline queries: one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads, BENCH_QUERIES may
name other queries (comma separated, or "all").
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bindings import QUERIES  # noqa: E402
from corpusflow.session import build_session, prepare  # noqa: E402

HEADLINE = [
    "language_share_by_host", "rule_extraction", "page_blocks", "feed_posts", "articles_from_listing",
    "page_links", "distinct_page_links", "link_frontier",
    "parsed_dates", "found_dates", "fallback_dates", "labelled_dates",
    "language_flags", "cleaned_articles", "cleaning_steps", "first_copies",
    "enriched_articles", "run_windows", "routed_articles", "corpus_build",
    "store_records", "upserted_store", "loaded_store", "training_sink",
    "cut_first_old", "cut_streak_listing", "cut_streak_page", "cut_stale_pages", "cut_seen_pages",
    "type_shares", "share_table", "weekly_summary", "retention", "repeated_blocks", "text_profile",
    "run_log_rows", "js_divergence",
    "incremental_clean", "streamed_upsert", "streamed_weekly_windows",
]


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    named = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not named else list(QUERIES) if named == "all" else named.split(",")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.log.level": "ERROR",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    prepare(spark)
    spark.range(10).selectExpr("sum(id)").collect()  # start the executor threads
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken) if runs < 3 else statistics.median(taken), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
