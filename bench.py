"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Every query is computed in full into Spark's noop sink. The first query is run once beforehand,
so that starting the session is not part of its figure.
"""

from __future__ import annotations

import json
import os
import time

from demandspark.registry.queries import QUERIES
from demandspark.session import build_session

HEADLINE = [
    "leaderboard_baselines",
    "clean_table",
    "clean_waterfall",
    "numeric_profile",
    "features_full",
    "serving_features",
    "dense_panel",
    "category_sales",
    "box_stats",
    "correlation_long",
    "r1_monthly_category",
    "r2_top3_per_store",
    "r3_stockout",
    "r4_promo_elasticity",
    "r5_forecast_accuracy",
    "sale_intake",
    "latest_risk",
    "inventory_decision",
    "risk_job",
    "reorder_receipts",
    "batch_scoring_baseline",
    "linear_forecast",
    "boosted_forecast",
    "stream_sales",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session("demandspark-bench", cores=os.environ.get("BENCH_CPUS", "8"))

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(names[0])
    seconds = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
