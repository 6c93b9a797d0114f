"""Times the headline queries and prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (8),
``BENCH_RUNS`` (3, the median is reported after one unmeasured run).
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.plans.registry import QUERIES  # noqa: E402
from tallyspark.session import build_session  # noqa: E402

HEADLINE = [
    "sql_1a_overall_success", "sql_1b_success_by_method", "sql_1c_success_by_month",
    "sql_2b_day_of_week", "sql_2d_monthly_seasons", "sql_3a_failure_reasons",
    "sql_3d_lost_revenue", "sql_4a_user_segments", "sql_4b_top_users", "sql_4c_age_method",
    "sql_4e_tier_performance", "sql_5b_discount_by_category", "sql_6b_fraud_reasons",
    "sql_7a_refund_summary", "sql_8a_platforms", "sql_v1_executive_summary",
    "sql_v2_kpi_snapshot", "sql_v3_clean_transactions", "uf_6_enriched_table",
    "dq_4_duplicate_ids", "dq_16_scorecard_cleaned", "dq_20_amount_profile",
    "ed_4_day_hour_heatmap", "ed_13b_box_by_flag", "ed_18_findings", "ap_1_overview",
    "ap_16_tiers", "wb_11_segments", "st_2_dim_users", "st_6_fact_transactions",
    "m_all_global", "vz_6_total_transactions_by_day_name_hour",
    "vz_17_total_transactions_by_customer_tier", "vz_21_unique_users_by_month_year",
    "flt_13_dimension_slicers", "jn_7_star_join", "ti_1_4_month_over_month",
    "ti_9_12_to_date_by_day", "ti_9_14_by_day_and_platform",
]


def timed(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", cpus=int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder)
                                                for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
