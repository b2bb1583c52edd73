"""Time the headline queries and print one JSON line.

Each query runs to completion into a sink that discards its rows, after one warm-up query, and
counts once. BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from agorascope.plans import catalog
from agorascope.session import build_session

HEADLINE = [
    "hourly_by_community",
    "ymdow_by_community",
    "unique_counts",
    "top_communities",
    "peak_hours",
    "daily_metrics",
    "community_statistics",
    "engagement_metrics",
    "user_overlap_pairs",
    "post_comment_counts",
    "early_comment_features",
    "feature_correlation",
    "user_behavior_features",
    "viral_label",
    "normalize_text",
    "feature_mentions",
    "feature_sentiment",
    "brand_feature_matrix",
    "feature_emotions",
    "sentiment_by_brand",
    "sentiment_by_period",
    "keyword_change",
    "pain_point_vectors",
    "engagement_regression_early",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("hourly_overall")
    times = {name: run(name) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
