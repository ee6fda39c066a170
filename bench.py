"""Time the headline queries; prints one JSON line.

Each query is run to a no-op sink (all rows and columns are computed, none are collected): once to warm up, then
``BENCH_RUNS`` times, of which the fastest counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.registry.queries import queries  # noqa: E402
from salesmart.session import local_session  # noqa: E402

HEADLINE = [
    "fact_sales", "silver_shipments", "dedup_shipments", "dim_customer", "unpivot_budget", "forward_fill",
    "profile_nulls", "key_candidates", "duplicate_rows", "conflicting_rows", "validate_key",
    "referential_integrity_all", "dq_orders", "dq_order_details", "dq_shipments", "dq_gate",
    "gold_validation_summary", "days_to_ship_by_file", "employee_default_pattern", "discount_tier_summary",
    "negative_margin_summary", "top_loss_products", "shipper_coverage", "order_value", "margin_by_employee",
    "ytd_vs_ly", "findings_table", "row_hash", "merge_upsert", "merge_changes", "pipeline_audit",
]


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    known = queries()
    timings = {}
    for name in names:
        seconds(spark, known[name], sf_dir)
        timings[name] = round(min(seconds(spark, known[name], sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
