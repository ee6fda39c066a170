"""The shape of the physical plans: no Python, no cross joins, no window over a whole fact, filters in the scan."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from salesmart.operators.dedup import keep_latest
from salesmart.operators.fill import forward_fill
from salesmart.operators.keys import duplicate_rows
from salesmart.operators.merge import merge_upsert, with_fingerprint
from salesmart.plans import gold, quality
from salesmart.plans.tables import BY_ORDER, MOST_LINES, ORDER_BUCKET, SILVER_KEYS
from salesmart.registry.fixtures import SalesSources
from salesmart.registry.queries import queries
from salesmart.sources.tables import key_summary, upsert_partitions

# The year-over-year lookup runs over one row per calendar year.
ONE_TASK_WINDOWS = {"ytd_vs_ly"}


def plan_of(df, mode="simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_shape(spark, conf, name):
    # without broadcasts, as at a scale where no table is small
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(queries()[name](spark, SMALL))
    for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set"):
        assert banned not in plan, banned
    if name not in ONE_TASK_WINDOWS:
        assert not re.search(r"Window(?!Group).*\n.*\n?.*Exchange SinglePartition", plan)


def test_scan_reads_only_what_is_used(spark):
    plan = plan_of(queries()["discount_tier_summary"](spark, SMALL), "formatted")
    line_scan = next(line for line in plan.splitlines() if "ReadSchema" in line and "l_discount" in line)
    assert "l_shipdate" not in line_scan and "l_suppkey" not in line_scan
    assert "o_orderdate" not in plan  # no order is read for a report on lines


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id AS order_id", "CAST(id AS DECIMAL(5,2)) AS discount", "CAST(id AS INT) AS quantity",
                               "CAST(id AS DECIMAL(12,2)) AS unit_price").write.parquet(str(tmp_path / "lines"))
    from salesmart.operators.rules import row_violations
    from salesmart.plans.quality import line_rules

    plan = plan_of(row_violations(spark.read.parquet(str(tmp_path / "lines")), line_rules()), "formatted")
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(quantity,0\)", plan)


def test_small_batch_merge_does_not_shuffle_the_target(spark):
    target = with_fingerprint(spark.range(1000).selectExpr("id AS k", "id AS v"), ["k"])
    batch = spark.range(5).selectExpr("id AS k", "-id AS v")
    merged = merge_upsert(target, batch, ["k"], source_is_unique=True).where("_change <> 'insert'")
    plan = plan_of(merged)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def _final_plan(df) -> str:
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.fixture
def tiny_skew_limits(conf):
    """Let a few kilobytes count as skew."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")


def _hot(spark, n=30000):
    """A third of all rows under one key, spread over several tasks."""
    return spark.range(0, n, 1, 6).selectExpr(
        "IF(id % 3 = 0, 7, id) AS order_id", "IF(id % 3 = 0, 1, id) AS line_no", "id AS payload", "'f1' AS source_file"
    )


def test_hot_key_is_split_in_duplicate_rows(spark, tiny_skew_limits):
    df = _hot(spark)
    found = duplicate_rows(df, ["order_id", "line_no"])
    assert "skew=true" in _final_plan(found).replace("isSkew", "skew")
    assert found.count() == 10000


def test_hot_key_is_split_in_the_sales_fact(spark, tiny_skew_limits):
    lines = _hot(spark).drop("source_file")
    shipments = keep_latest(
        _hot(spark).selectExpr(
            "order_id", "line_no", "payload AS shipper_id", "payload AS shipment_date", "source_file"),
        ["order_id", "line_no"], ["source_file"])
    joined = gold.with_shipment(lines, shipments)
    assert "skew=true" in _final_plan(joined)
    assert joined.count() == 30000
    assert joined.where(F.col("shipper_id").isNull()).count() == 0


def test_hot_key_is_split_in_a_merge(spark, tiny_skew_limits):
    target = with_fingerprint(_hot(spark).select("order_id", "payload"), ["order_id"])
    batch = spark.range(5000).selectExpr("id AS order_id", "-id AS payload")
    merged = merge_upsert(target, batch, ["order_id"])
    assert "skew=true" in _final_plan(merged)


def test_copies_of_a_key_are_reduced_before_the_shuffle(spark):
    plan = plan_of(keep_latest(_hot(spark), ["order_id", "line_no"], ["source_file"]))
    exchange = plan.index("Exchange hashpartitioning")
    assert "partial_max" in plan[exchange:] and "partial_max" not in plan[:exchange]
    kept = keep_latest(_hot(spark), ["order_id", "line_no"], ["source_file"]).where("order_id = 7 AND line_no = 1")
    assert rows(kept) == [(7, 1, 29997, "f1")]


def test_large_merge_shuffles_each_side_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    target = with_fingerprint(spark.range(1000).selectExpr("id AS k", "id AS v"), ["k"])
    batch = spark.range(500, 2000).selectExpr("id AS k", "-id AS v")
    plan = plan_of(merge_upsert(target, batch, ["k"], target_is_unique=True))
    assert plan.count("Exchange ") == 1 and plan.count("Range (") == 2 and "Join" not in plan


def test_an_audit_reads_each_side_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(queries()["pipeline_audit"](spark, SMALL))
    assert plan.count("Scan parquet") <= 12 and plan.count("SortMergeJoin") <= 2


@pytest.fixture
def few_sales(spark, tmp_path):
    """Tables of a few rows, with a line that stands there twice and rows without a key."""
    tables = {
        "nation": "SELECT 0L AS n_nationkey, 'A' AS n_name",
        "customer": "SELECT if(id = 9, NULL, id) AS c_custkey, 'c' AS c_name, 0 AS c_nationkey FROM range(10)",
        "orders": "SELECT if(id = 9, NULL, id) AS o_orderkey, id AS o_custkey, 1.5D AS o_totalprice FROM range(10)",
        "lineitem": "SELECT if(id = 9, NULL, id % 8) AS l_orderkey, 5L AS l_partkey, 3L AS l_suppkey, 1 AS l_linenumber,"
                    " 2D AS l_quantity, TIMESTAMP '2000-01-01 00:00:00' AS l_shipdate FROM range(10)",
    }
    for name, rows_of in tables.items():
        spark.sql(rows_of).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_an_audit_shuffles_rows_once_and_no_fingerprints(spark, few_sales):
    audit = queries()["pipeline_audit"](spark, few_sales)
    lines = plan_of(audit).splitlines()
    depth = [len(re.match(r"[ :+|*-]*", line).group()) for line in lines]
    shuffles = [k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 6  # the two sides of three sources
    for k in shuffles:
        below = next((j for j in range(k + 1, len(lines)) if depth[j] <= depth[k]), len(lines))
        assert not any("sha2(" in line or "hashpartitioning" in line for line in lines[k + 1:below])
    assert sum("sha2(" in line for line in lines) == 6
    # line 0 of order 0 comes twice, order 1 is exported twice; order 0 is stored under -1, and its amount and that of 6 differ
    assert rows(audit) == [("customers", 10, 0, 0, 10, 0, "SUCCESS"), ("orders", 10, 1, 1, 11, 0, "SUCCESS"), ("shipments", 11, 0, 0, 10, 1, "WARNING")]


@pytest.fixture
def stored_facts(spark, conf):
    """Lines, orders, shipments and products stored as the silver layer stores them."""
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    s = SalesSources(spark, SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS clustered")
    for name in ("fact_order_details", "fact_orders", "fact_shipments"):
        if not spark.catalog.tableExists(f"clustered.{name}"):
            upsert_partitions(spark, s.fact(name), f"clustered.{name}", SILVER_KEYS[name], F.expr(ORDER_BUCKET), clustering=BY_ORDER)
    return [spark.table(f"clustered.{name}") for name in ("fact_order_details", "fact_orders", "fact_shipments")], s.fact("dim_product")


def test_stored_facts_join_without_a_shuffle(spark, stored_facts):
    facts, products = stored_facts
    sales = gold.fact_sales(*facts, products, by_order=True)
    plan = plan_of(sales)
    assert "Exchange hashpartitioning" not in plan and plan.count("SortMergeJoin") == 2
    assert plan.count("Bucketed: true") == 3 or plan_of(sales, "formatted").count("Bucketed: true") == 3
    assert rows(sales) == rows(gold.fact_sales(*facts, products))
    assert key_summary(spark, "clustered.fact_order_details").most_together <= MOST_LINES


def test_forward_fill_spreads_a_sheet_with_gaps(spark, conf):
    """Rows a million positions apart: no window meets all of them, they are dealt out by block."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    sheet = spark.range(0, 20_000, 1, 4).selectExpr("'s' AS sheet", "id * 1000003 AS row_no", "IF(id % 50 = 0, id, NULL) AS v")
    filled = forward_fill(sheet, "v", ["sheet"], "row_no", block_rows=1 << 10)
    sizes = [r["n"] for r in filled.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000 and len(sizes) >= 12 and max(sizes) < 4_000
    plan = plan_of(filled)
    assert not re.search(r"hashpartitioning\(sheet#\d+, 16\)", plan.split("_at0")[0])
    assert filled.where("v IS NULL OR v <> row_no DIV 1000003 DIV 50 * 50").count() == 0


def test_rows_that_are_alone_are_not_sorted(spark, tiny_skew_limits):
    plan = plan_of(keep_latest(_hot(spark), ["order_id", "line_no"], ["source_file"]))
    alone = plan[: plan.index("SortAggregate")]
    assert "LeftAnti" in alone and "LeftSemi" in plan[plan.index("SortAggregate") :]


def test_each_table_is_read_once_for_all_links(spark):
    plan = plan_of(queries()["referential_integrity_counts"](spark, SMALL))
    # customers read two tables, so twelve sources are thirteen scans at most
    assert plan.count("Scan parquet") <= 13


def test_each_source_is_read_once_for_all_candidates(spark):
    for name in ("key_candidates", "column_profile"):
        assert plan_of(queries()[name](spark, SMALL)).count("Scan parquet") <= 13


def test_hot_customer_is_split_in_the_order_rules(spark, tiny_skew_limits):
    orders = _hot(spark).selectExpr("payload AS order_id", "IF(payload % 3 = 0, 7, payload) AS customer_id", "line_no AS employee_id", "line_no AS shipper_id", "date'2020-01-01' AS order_date")
    parent = lambda pk: spark.range(9000).withColumnRenamed("id", pk)
    found = quality.dq_orders(orders, parent("customer_id"), parent("emp_id"), parent("shipper_id"))
    assert "skew=true" in _final_plan(found)
    assert found.where("rule_failed = 'ORPHAN_CUSTOMER_ID'").count() == 30000 - 10000 - 6000
