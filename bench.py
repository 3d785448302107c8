"""Time the headline queries and print one JSON line.

The feed is landed and the stored layers are built first; both are timed and
counted.  Each query then runs once to warm up and three times measured (median),
with all rows computed and thrown away by the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "stg_customers", "dq_customers", "dq_orders_clean", "dq_run_counts", "silver_key_quarantine",
    "silver_customers", "silver_orders", "scd2_merge_batch", "scd2_late_events", "scd2_staged_merge",
    "orders_upsert_batch", "cdc_snapshot_diff", "cdc_cascade_set_null", "dim_customers", "fact_orders",
    "fact_orders_commit_time", "late_dimension_resolution", "executive_summary", "sales_by_state",
    "agg_daily_sales", "agg_revenue_trends", "top_customers_ltv", "sales_by_quarter", "dashboard_document",
    "dq_test_summary", "multi_version_orders", "pipeline_run_status", "clustered_fact_write",
]
ONCE = ["bronze_json_ingest", "stream_bronze_ingest", "stream_scd2_apply", "full_pipeline"]


def main() -> None:
    from scenarios.feed import lake_of
    from scenarios.queries import QUERIES
    from tidelog.session import session

    spark = session(
        f"local[{CPUS}]", "bench", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def timed(work) -> float:
        begun = time.perf_counter()
        work()
        return time.perf_counter() - begun

    def run(name: str) -> None:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    lake = lake_of(spark, SF_DIR)
    seconds = {
        "land_feed": timed(lambda: (lake.raw_customers, lake.raw_orders)),
        "build_layers": timed(lambda: (lake.dim_customers, lake.fact_orders)),
    }
    for name in HEADLINE:
        run(name)
        seconds[name] = statistics.median(timed(lambda: run(name)) for _ in range(3))
    for name in ONCE:
        seconds[name] = timed(lambda: run(name))
    rounded = {k: round(v, 3) for k, v in seconds.items()}
    line = {
        "metric": "total_seconds_of_headline_queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": rounded, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS),
    }
    print(json.dumps(line))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
