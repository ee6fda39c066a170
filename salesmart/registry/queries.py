"""One registered query per operator or table: ``(spark, sf_dir) -> DataFrame``, all lazy and over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.audit import lineage_from_bronze, normalize_schema
from salesmart.functions.values import NO_STATE_LABEL, foreign_key_or_unknown, null_to, parse_date
from salesmart.operators import integrity, keys, merge, profile, reconcile
from salesmart.operators.fill import forward_fill
from salesmart.operators.rules import parse_failures
from salesmart.operators.unions import labeled_union, union_by_name
from salesmart.plans import analysis, gold, loads, quality, silver
from salesmart.plans.tables import BRONZE_KEYS, FOREIGN_KEYS, GOLD_KEYS
from salesmart.registry.fixtures import BUDGET_YEARS, RUN_TS, SOURCE_SYSTEM, SalesSources
from salesmart.sources.grid import repair_budget_grid
from salesmart.sources.members import add_members
from salesmart.sources.tables import stringify

Query = Callable[[SparkSession, str], DataFrame]

LINE_KEY = ["order_id", "line_no"]
LOSS_TIER = "0.10"
YTD_DAY = 180
ORDER_SHIPPER = next(k for k in FOREIGN_KEYS if (k.child, k.parent) == ("orders", "shippers"))
NUMERIC_OUTPUT_METADATA = ("bronze_created_at", "bronze_updated_at", "created_at", "updated_at")


def _output(df: DataFrame) -> DataFrame:
    """Result columns as the check compares them: money as double, load timestamps left out."""
    df = df.drop(*NUMERIC_OUTPUT_METADATA)
    money = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(money) if money else df


def _shipments(s: SalesSources) -> DataFrame:
    return s.raw("shipments")


def _normalized_orders(s: SalesSources) -> DataFrame:
    return normalize_schema(s.raw_orders(), RUN_TS, "Orders.csv", SOURCE_SYSTEM)


def _shipment_slices(s: SalesSources) -> dict[str, DataFrame]:
    """The shipment exports as the separate files they stand for, every second one with its columns in another order."""
    columns = ["order_id", "line_no", "shipper_id", "shipment_date"]
    files = sorted(r.source_file for r in _shipments(s).select("source_file").distinct().collect())
    return {name: _shipments(s).where(F.col("source_file") == name).select(columns[:: 1 - 2 * (k % 2)]) for k, name in enumerate(files)}


def _merged(s: SalesSources) -> DataFrame:
    """Order numbers are unique in the stored orders, so both sides go through one shuffle."""
    return merge.merge_upsert(
        merge.with_fingerprint(s.merge_target(), ["order_id"]), s.merge_source(), ["order_id"], target_is_unique=True
    )


def _second_merge(s: SalesSources) -> DataFrame:
    return merge.merge_upsert(_merged(s).drop(merge.CHANGE), s.merge_source(), ["order_id"], target_is_unique=True)


def _checked_dates(s: SalesSources) -> DataFrame:
    return analysis.days_to_ship(_shipments(s), s.orders())


def _mismatches(s: SalesSources) -> DataFrame:
    return quality.employee_mismatches(s.fact("fact_orders"), s.fact("fact_shipments"))


def _dq_orders(s: SalesSources) -> DataFrame:
    # Shippers without the placeholders, so that the orphan rule has something to find.
    return quality.dq_orders(s.fact("fact_orders"), s.customers(), s.fact("dim_employee"), s.shippers())


def _dq_order_details(s: SalesSources) -> DataFrame:
    return quality.dq_order_details(s.fact("fact_order_details"), s.products())


def _dq_shipments(s: SalesSources) -> DataFrame:
    return quality.dq_shipments(s.fact("fact_shipments"), s.fact("fact_orders"), s.shippers())


def _dq_views(s: SalesSources) -> dict[str, DataFrame]:
    return {
        "dq_orders": _dq_orders(s), "dq_order_details": _dq_order_details(s), "dq_shipments": _dq_shipments(s),
    }


def _sources(s: SalesSources) -> dict[str, DataFrame]:
    return {name: s.raw(name) for name in BRONZE_KEYS}


def _parse_dates(s: SalesSources) -> DataFrame:
    orders = s.orders().select(
        F.lit("orders").alias("source"), F.col("order_id").alias("id"), parse_date("order_date").alias("parsed_date")
    )
    customers = s.customers().select(
        F.lit("customers").alias("source"), F.col("customer_id").alias("id"),
        parse_date("birth_date").alias("parsed_date"),
    )
    return union_by_name([orders, customers])


def _audit_timestamps(s: SalesSources) -> DataFrame:
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    stamped = s.table("orders").select(
        day.alias("created_at"), F.date_add(day, (key % 30).cast("int")).alias("updated_at")
    )
    return keys.audit_range(stamped)


def _row_count_reconcile(s: SalesSources) -> DataFrame:
    """Sources against the tables they came from; shipments carry the second export on top."""
    twice = s.table("lineitem").agg(
        F.lit("shipments").alias("table_name"),
        (F.count("*") + F.count_if(F.col("l_orderkey") % 120 == 1)).alias("expected_rows"),
    )
    origin = {
        "customers": "customer", "products": "part", "suppliers": "supplier", "shippers": "supplier",
        "offices": "region", "employees": "nation", "orders": "orders", "order_details": "lineitem",
    }
    split = s.table("region").agg(
        F.lit("divisions").alias("table_name"), (F.count("*") + F.count_if(F.col("r_regionkey") == 1)).alias("expected_rows"))
    brands = s.table("part").agg(F.lit("categories").alias("table_name"), F.count_distinct("p_brand").alias("expected_rows"))
    expected = reconcile.table_counts({name: s.table(table) for name, table in origin.items()}, "expected_rows")
    actual = reconcile.table_counts({name: s.raw(name) for name in [*origin, "shipments", "divisions", "categories"]}, "actual_rows")
    return reconcile.reconcile_counts(union_by_name([expected, twice, split, brands]), actual)


def _findings(s: SalesSources) -> DataFrame:
    shares, find = analysis.share_of, analysis.finding
    orders = s.orders()
    links = [link for link in FOREIGN_KEYS if link.parent == "shippers"]
    tables = {name: s.raw(name) for name in ("orders", "shipments", "shippers")}
    orphan = integrity.key_presence(tables, links).agg(
        F.count_if(F.col("in_child") & ~F.col("in_parent")).alias("affected_rows"),
        F.count_if("in_child").alias("total_rows"),
    )
    repeated_division = keys.key_counts(s.divisions(), ["division_id"]).agg(
        F.count_if(F.col("row_count") > 1).alias("affected_rows"), F.count("*").alias("total_rows")
    )
    overlap = keys.duplicate_summary(_shipments(s), LINE_KEY).select(
        F.col("surplus_rows").alias("affected_rows"), "total_rows"
    )
    dates = analysis.date_anomaly_scope(_checked_dates(s)).select(
        F.col("negative_lines").alias("affected_rows"), F.col("total_lines").alias("total_rows")
    )
    return analysis.findings([
        find("shippers", "Orphan FK", orphan),
        find("divisions", "Duplicate key", repeated_division),
        find("orders", "Broken measure", shares(orders, F.col("total_order") == 0)),
        find("orders", "Null FK", shares(orders, F.col("employee_id").isNull())),
        find("shipments", "Cross-file duplicate", overlap),
        find("shipments", "Systemic date anomaly", dates),
        find("order_details", "Key correction", analysis.dependency_breaks(s.order_details(), ["order_id", "product_id"], "line_no")),
        find("products / order_details", "Price difference", analysis.price_differences(s.fact("fact_order_details"), s.products())),
    ])


def _pipeline_audit(s: SalesSources) -> DataFrame:
    """A run over a stored state: changed orders, customers loaded again, shipments whose second reading misses an export.

    Stored rows get their fingerprints after one row of each key is left, so that no fingerprint is shuffled.
    """
    again = lambda table: s.table(table).agg(F.count("*").alias("n"))
    audited = {
        "orders": (s.merge_target(), s.merge_source(), ["order_id"], again("orders")),
        "customers": (s.customers(), s.customers(), ["customer_id"], again("customer")),
        "shipments": (s.raw("shipments"), s.raw("shipments"), [*LINE_KEY, "source_file"], again("lineitem")),
    }
    return union_by_name(
        loads.merge_audit(table, merge.with_fingerprint(stored.dropDuplicates(keys), keys), batch, keys, count)
        for table, (stored, batch, keys, count) in audited.items())


_QUERIES: dict[str, Callable[[SalesSources], DataFrame]] = {
    # sources and schema
    "union_by_name": lambda s: union_by_name(_shipment_slices(s).values()),
    "shipments_labeled_union": lambda s: labeled_union(_shipment_slices(s)),
    "forward_fill": lambda s: forward_fill(s.report_grid(), "label", ["sheet"], "row_no"),
    **{name: lambda s: repair_budget_grid(s.budget_grid(), ["office", "employee_id", *BUDGET_YEARS]) for name in ("budget_grid_repair", "budget_sheet_repair")},
    "stringify_columns": lambda s: stringify(s.orders()),
    "normalize_schema": _normalized_orders,
    "lineage_rename": lambda s: lineage_from_bronze(_normalized_orders(s)),
    "row_hash": lambda s: merge.with_fingerprint(s.merge_source(), ["order_id"]).select("order_id", "row_hash"),
    # value repairs
    "cast_conform": lambda s: silver.conform_employee(s.employees()).select(*silver.EMPLOYEE_NUMBERS, "hire_date"),
    "parse_dates": _parse_dates,
    "shift_shipment_date": lambda s: silver.correct_shipment_date(_shipments(s)).select(
        *LINE_KEY, "source_file", "shipment_date_original", "shipment_date"),
    "reassign_duplicate_key": lambda s: silver.division(s.divisions()),
    "null_label": lambda s: s.customers().select(
        "customer_id", null_to("state_province", NO_STATE_LABEL).alias("state_province")),
    "null_fk_to_unknown": lambda s: s.orders().select(
        "order_id", foreign_key_or_unknown("employee_id").alias("employee_id")),
    "unknown_member": lambda s: add_members(
        s.shippers(), [{"shipper_id": k, "company_name": silver.UNKNOWN_SHIPPER_NAME} for k in (4, 5)]),
    "unpivot_budget": lambda s: s.fact("fact_budget"),
    "dedup_shipments": lambda s: silver.one_shipment_per_line(_shipments(s)).select(
        *LINE_KEY, "shipper_id", "source_file"),
    "dedup_metrics": lambda s: keys.duplicate_summary(_shipments(s), LINE_KEY).select(
        F.col("total_rows").alias("rows_before"), F.col("distinct_keys").alias("rows_after"),
        F.col("surplus_rows").alias("removed")),
    # silver tables
    "silver_dim_category": lambda s: s.silver("dim_category"),
    "silver_dim_product": lambda s: s.silver("dim_product"),
    "silver_dim_customer": lambda s: s.silver("dim_customer"),
    "silver_dim_supplier": lambda s: s.silver("dim_supplier"),
    "silver_dim_division": lambda s: s.silver("dim_division"),
    "silver_dim_employee": lambda s: s.silver("dim_employee"),
    "silver_dim_office": lambda s: s.silver("dim_office"),
    "silver_dim_shipper": lambda s: s.silver("dim_shipper"),
    "silver_orders": lambda s: s.silver("fact_orders"),
    "silver_order_details": lambda s: s.silver("fact_order_details"),
    "silver_shipments": lambda s: s.silver("fact_shipments"),
    # star schema
    "dim_date": lambda s: s.gold("dim_date"),
    "dim_customer": lambda s: s.gold("dim_customer"),
    "dim_product": lambda s: s.gold("dim_product"),
    "dim_employee": lambda s: s.gold("dim_employee"),
    "dim_supplier": lambda s: s.gold("dim_supplier"),
    "dim_shipper": lambda s: s.gold("dim_shipper"),
    "dim_division": lambda s: s.gold("dim_division"),
    "gold_passthrough": lambda s: gold.passthrough(s.silver("fact_order_details")),
    "fact_sales": lambda s: s.gold("fact_sales"),
    "fact_budget": lambda s: s.gold("fact_budget"),
    # profiling and key checks
    **{name: lambda s: union_by_name(profile.profile_shape(s.raw(n), n) for n in BRONZE_KEYS) for name in ("profile_shape", "profile_shape_all")},
    **{name: lambda s: union_by_name(profile.profile_nulls(s.raw(n), n) for n in BRONZE_KEYS) for name in ("profile_nulls", "profile_nulls_all")},
    **{name: lambda s: union_by_name(profile.key_candidates(s.raw(n), n, keys=keys) for n, keys in BRONZE_KEYS.items())
       for name in ("key_candidates", "key_candidates_all")},
    "column_profile": lambda s: union_by_name(profile.column_profile(s.raw(n), n, keys=keys) for n, keys in BRONZE_KEYS.items()),
    "cross_file_duplicates": lambda s: keys.duplicate_summary(_shipments(s), LINE_KEY),
    "duplicate_keys": lambda s: keys.duplicate_keys(_shipments(s), LINE_KEY),
    "duplicate_rows": lambda s: keys.duplicate_rows(_shipments(s), LINE_KEY).select(
        *LINE_KEY, "shipper_id", "source_file"),
    "conflicting_duplicates": lambda s: keys.conflicting_keys(_shipments(s), LINE_KEY, "shipper_id"),
    "conflicting_rows": lambda s: keys.conflicting_rows(_shipments(s), LINE_KEY, "shipper_id").select(
        *LINE_KEY, "shipper_id", "source_file"),
    "validate_key": lambda s: union_by_name([
        keys.validate_key(_shipments(s), LINE_KEY, "shipments"),
        keys.validate_key(s.divisions(), ["division_id"], "divisions"),
        keys.validate_key(s.orders(), ["employee_id"], "orders"),
    ]),
    "gold_validation_summary": lambda s: quality.validation_summary({name: s.gold(name) for name in GOLD_KEYS}),
    "audit_timestamps": _audit_timestamps,
    "referential_integrity": lambda s: integrity.orphans(_sources(s), [ORDER_SHIPPER]),
    "referential_integrity_all": lambda s: integrity.orphans(_sources(s), FOREIGN_KEYS),
    "referential_integrity_counts": lambda s: integrity.integrity_counts(_sources(s), FOREIGN_KEYS),
    "row_count_reconcile": _row_count_reconcile,
    # data-quality views
    "dq_orders": _dq_orders,
    "dq_order_details": _dq_order_details,
    "dq_shipments": _dq_shipments,
    "dq_parse_failures": lambda s: union_by_name(
        parse_failures(s.raw(name), name, record, parsed) for name, (record, parsed) in silver.parsed_columns().items()),
    "dq_summary": lambda s: quality.dq_summary(_dq_views(s)),
    "dq_gate": lambda s: quality.dq_gate(_dq_views(s)),
    "shipment_before_order": lambda s: quality.shipments_before_order(
        s.fact("fact_shipments"), s.fact("fact_orders")),
    "employee_mismatches": _mismatches,
    "mismatch_concentration": lambda s: quality.mismatch_concentration(_mismatches(s)).orderBy(
        F.desc("mismatch_count"), "shipment_employee_id"),
    "employee_default_pattern": lambda s: quality.employee_default_pattern(_mismatches(s)),
    # analyses
    "date_range": lambda s: analysis.date_range(s.fact("fact_orders")),
    "days_to_ship": _checked_dates,
    "days_to_ship_stats": lambda s: analysis.days_to_ship_stats(_checked_dates(s)),
    "days_to_ship_by_file": lambda s: analysis.days_to_ship_by_file(_checked_dates(s)),
    "date_anomaly_scope": lambda s: analysis.date_anomaly_scope(_checked_dates(s)),
    "negative_margin_summary": lambda s: analysis.negative_margin_summary(s.measured_lines()),
    "negative_margin_by_discount": lambda s: analysis.negative_margin_by_discount(s.measured_lines()).orderBy(
        "discount"),
    "top_loss_products": lambda s: analysis.top_loss_products(s.measured_lines(), s.products()),
    "losing_lines_at_tier": lambda s: analysis.worst_lines_at(s.measured_lines(), s.products(), LOSS_TIER),
    "discount_tier_summary": lambda s: analysis.discount_tiers(s.measured_lines()).orderBy("discount"),
    "shipper_coverage": lambda s: analysis.shipper_coverage(s.shipped_lines(), s.fact("dim_shipper")),
    "placeholder_shipper_orders": lambda s: analysis.placeholder_shipper_orders(
        s.shipped_lines(), s.fact("dim_shipper"), silver.SHIPPERS_WITHOUT_RECORD),
    "order_value": lambda s: analysis.order_value(s.fact("fact_order_details")),
    "margin_by_employee": lambda s: analysis.margin_by_employee(s.dated_lines()),
    "ytd_vs_ly": lambda s: analysis.year_to_date(s.dated_lines(), YTD_DAY),
    "findings_table": _findings,
    # upsert and loads
    "merge_upsert": lambda s: _merged(s).select("order_id", "customer_id", "amount", "row_hash"),
    "merge_changes": lambda s: merge.change_counts(_merged(s)),
    "merge_idempotent": lambda s: merge.change_counts(_second_merge(s)),
    "pipeline_audit": _pipeline_audit,
}


def _registered(build: Callable[[SalesSources], DataFrame]) -> Query:
    return lambda spark, sf_dir: _output(build(SalesSources(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {name: _registered(build) for name, build in _QUERIES.items()}
