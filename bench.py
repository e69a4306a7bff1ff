"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local cores. Every
query is written to the no-op sink, so the whole result is computed and nothing
is collected. ``queries`` holds the first (cold) run of each query and ``warm``
the second.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.catalog import QUERIES  # noqa: E402
from feedforge.session import build_session  # noqa: E402

HEADLINE = (
    "clean_tweets", "clean_engagements", "posts_unified", "posts_enriched", "dim_posts",
    "fact_engagements", "daily_engagements", "fact_post_metrics", "fact_post_metrics_daily",
    "fact_with_fks", "asof_user", "dim_users_scd2", "dedup_latest", "daily_active_users",
    "hashtag_totals", "trending_tags_7d", "share_of_voice", "post_reach", "eod_cumulative",
    "top_posts", "monthly_rollup", "thread_depth", "fk_orphans_date", "dq_unique", "dq_in_set",
    "dq_suite_gold", "sink_silver_partitions", "stream_dedup", "stream_daily_counts",
    "stream_interval_join",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for timings in (cold, warm):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total of the first run", "value": round(sum(cold.values()), 3),
        "unit": "sec", "queries": cold, "warm": warm, "warm_value": round(sum(warm.values()), 3),
        "sf": os.path.basename(folder.rstrip("/")), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
