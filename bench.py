"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
BENCH_QUERIES (comma-separated names, or "all"). Each query runs once to warm up, then the median of the timed runs
counts. Results go to the noop sink. "star_build", the one-time derivation of the star tables, is run twice and the second
run counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from cartwheel.plans.catalog import QUERIES
from cartwheel.plans.star import load_star, write_star
from cartwheel.session import build_session, scratch

HEADLINE = (
    "clean_orders",
    "clean_order_products",
    "clean_products",
    "quality_report",
    "combine",
    "denormalize",
    "user_features",
    "product_features_union",
    "upi_features_union",
    "ratings",
    "product_affinity",
    "basket_pairs",
    "journey_orders",
    "lifetime_value",
    "churn_indicators",
    "churn_timeline",
    "data_summary",
    "popular_products",
    "interaction_report",
    "last_order",
    "backfill_orders",
    "impute_pmm",
    "interval_histogram",
    "ranking_metrics",
    "blend",
    "mmr",
    "rfm",
    "segment_popularity",
    "segment_lift",
    "fuzzy_product_id",
    "similar_vectors",
    "transform_order_stream",
)


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    build = [timed(lambda: write_star(spark, sf_dir, scratch(spark, "bench-star"))) for _ in range(2)]
    seconds = {"star_build": round(build[-1], 3)}
    load_star(spark, sf_dir)
    for name in names:
        def run(query=QUERIES[name]):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(runs)), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total seconds of headline queries", "value": total, "unit": "sec", "queries": seconds, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
