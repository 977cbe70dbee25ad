"""Headline queries, timed; prints one JSON line. Each query runs twice and the second run counts,
so that JVM start-up and code generation stay out of the figures.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 4)
BENCH_QUERIES  space-separated names (default: the headline list)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercata.catalog import QUERIES
from mercata.session import local_session

HEADLINE = (
    "executive_kpis city_performance top_restaurants_per_city restaurant_scorecard customer_value customer_rfm "
    "customer_mom_spend monthly_revenue_mom promotion_effectiveness traffic_effect_hourly weather_effect order_base "
    "measures_by_month rank_three_ways lag_lead recency_rank partner_top_decile parse_mixed_dates dedupe_keep_first "
    "fk_filter_multi financial_rebuild dq_report basket_features daily_conditions asof_nearest nearest_traffic prior_mean "
    "churn_features delivery_features tune_threshold eval_classification"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus)
    times: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)
    sf = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
