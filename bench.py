"""Time the headline queries; prints one JSON line.

Each query runs once untimed on the smallest scale (class loading, code generation), then once
timed on the whole tables of ``$BENCH_SF_DIR``. Nothing is kept between queries: a leaderboard
query computes and stores its own metrics.
"""

from __future__ import annotations

import json
import os
import time

from skillgauge.plans.queries import QUERIES
from skillgauge.session import build_session

HEADLINE = [
    "metrics_all_scales", "truth_join_score", "validation_report", "leaderboard_ranked",
    "daily_mean_threshold", "weekly_mean", "monthly_mean", "seasonal_cycle", "anomaly", "interannual_variability",
    "metrics_hourly", "check_content", "check_index", "check_files", "skill_scores", "cdf_curve",
    "metadata_schema_check", "quota_admission",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        f"local[{cpus}]", "bench",
        spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    seconds = {}
    for name in names:
        if os.path.isdir(small):
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
