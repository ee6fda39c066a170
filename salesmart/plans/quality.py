"""The data-quality views over the silver facts and the star schema's dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.values import extended_amount, line_cost, raw_margin
from salesmart.operators.joins import splittable_join
from salesmart.operators.keys import validate_key
from salesmart.operators.rules import (
    ERROR,
    WARNING,
    RowRule,
    orphan_violations,
    row_violations,
    text,
    violation_counts,
)
from salesmart.plans.tables import GOLD_KEYS
from salesmart.operators.unions import labeled_union, union_by_name

# The rule names, severities and message texts below are what readers of the views match on.

# A default value is suspected when one employee holds more than this share of all mismatches.
DEFAULT_SHARE = 0.5


def _share_pct(part, whole):
    return F.round(part.cast("double") * 100 / whole.cast("double"), 1).cast("decimal(5,1)")


def dq_orders(orders: DataFrame, customers: DataFrame, employees: DataFrame, shippers: DataFrame) -> DataFrame:
    """All order rules from one scan of the orders, each next to the distinct keys of its parents. A customer, employee or shipper with a
    large share of all orders (or NULL) is split over tasks."""
    rules = [RowRule("MISSING_ORDER_DATE", ERROR, F.col("order_date").isNull(), F.lit("order_date is NULL"))]
    joined = orders
    for fk, parent, pk, what in (("customer_id", customers, "customer_id", "customer"), ("employee_id", employees, "emp_id", "employee"), ("shipper_id", shippers, "shipper_id", "shipper")):
        known = f"known_{what}"
        keys = parent.select(F.col(pk).try_cast(orders.schema[fk].dataType).alias(fk)).distinct().withColumn(known, F.lit(True))
        joined = splittable_join(joined, keys, [fk], "left")
        rules.append(RowRule(
            f"ORPHAN_{fk.upper()}", ERROR, F.col(fk).isNotNull() & F.col(known).isNull(), text(f"{fk} ", F.col(fk), f" not found in gold.dim_{what}")))
    return row_violations(joined, rules)


def line_rules() -> list[RowRule]:
    quantity, price, discount = F.col("quantity"), F.col("unit_price"), F.col("discount")
    return [
        RowRule("DISCOUNT_OUT_OF_RANGE", ERROR, ~discount.between(0, 1),
                text("discount ", discount, " is outside the valid 0-1 range")),
        RowRule("NON_POSITIVE_QUANTITY", ERROR, quantity <= 0, text("quantity ", quantity, " is zero or negative")),
        RowRule("NON_POSITIVE_UNIT_PRICE", ERROR, price <= 0, text("unit_price ", price, " is zero or negative")),
    ]


def product_rules() -> list[RowRule]:
    """Rules on a line left-joined to its product. The margin is tested unrounded and worded with rounded amounts;
    without a known cost it is NULL and breaks nothing."""
    return [
        RowRule("ORPHAN_PRODUCT_ID", ERROR, F.col("product_id").isNotNull() & F.col("known_product").isNull(),
                text("product_id ", F.col("product_id"), " not found in gold.dim_product")),
        RowRule("NEGATIVE_MARGIN", WARNING, raw_margin() < 0, text(
            "line margin is negative: extended_amount ", extended_amount(), " vs. cost ", line_cost(),
            " -- discount of ", F.round(F.col("discount") * 100, 1), "% likely too aggressive",
        )),
    ]


def dq_order_details(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Row rules stay free of the join, so their predicates reach the scan; both product rules share one join."""
    cost = products.select(F.col("product_id").alias("known_product"), "unit_cost")
    priced = lines.join(cost, F.col("product_id") == F.col("known_product"), "left")
    return union_by_name([row_violations(lines, line_rules()), row_violations(priced, product_rules())])


def shipments_before_order(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        _paired(orders, shipments)
        .where(F.col("shipment_date") < F.col("order_date"))
        .select("order_id", "line_no", "shipment_date", "order_date")
    )


def _paired(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    ordered = orders.select("order_id", "order_date", F.col("employee_id").alias("order_employee_id"))
    shipped = shipments.select(
        "order_id", "line_no", "shipment_date", F.col("employee_id").alias("shipment_employee_id")
    )
    return ordered.join(shipped, "order_id")


def employee_mismatches(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Lines whose shipment names another employee than the order; NULL on either side is no mismatch."""
    return (
        _paired(orders, shipments)
        .where(F.col("order_employee_id") != F.col("shipment_employee_id"))
        .select("order_id", "line_no", "order_employee_id", "shipment_employee_id")
    )


def mismatch_concentration(mismatches: DataFrame) -> DataFrame:
    return mismatches.groupBy("shipment_employee_id").agg(F.count("*").alias("mismatch_count"))


def employee_default_pattern(mismatches: DataFrame, share: float = DEFAULT_SHARE) -> DataFrame:
    """Employees holding more than ``share`` of all mismatches, with the total.

    The total is a scalar subquery over the per-employee counts, so no join with a one-row table is needed.
    At most ``1 / share`` employees can qualify, whatever the size of the data.
    """
    if not 0 < share < 1:
        raise ValueError(f"share must lie between 0 and 1, not {share}")
    counts = mismatch_concentration(mismatches)
    total = counts.agg(F.sum("mismatch_count")).scalar()
    return (
        counts.withColumn("total_mismatches", total)
        .where(F.col("mismatch_count") > F.col("total_mismatches") * share)
        .withColumn(
            "concentration_pct",
            F.round(F.col("mismatch_count").cast("double") * 100 / F.col("total_mismatches").cast("double"), 4),
        )
    )


def order_rules() -> list[RowRule]:
    """Rules on a shipped line next to its order and, where its employee is suspected, that employee's counts."""
    shipped, ordered = F.col("shipment_date"), F.col("order_date")
    ships, sells = F.col("shipment_employee_id"), F.col("order_employee_id")
    return [
        RowRule("SHIPMENT_BEFORE_ORDER", ERROR, shipped < ordered,
                text("shipment_date ", shipped, " is earlier than order_date ", ordered)),
        RowRule("EMPLOYEE_ID_DEFAULT_PATTERN", WARNING, F.col("mismatch_count").isNotNull() & (ships != sells), text(
            "shipment_employee_id ", ships, " differs from order_employee_id ", sells,
            " -- this employee_id accounts for ", _share_pct(F.col("mismatch_count"), F.col("total_mismatches")),
            "% of all ", F.col("total_mismatches"),
            " Orders/Shipments employee_id mismatches -- likely a source-system default value",
        )),
    ]


def dq_shipments(
    shipments: DataFrame, orders: DataFrame, shippers: DataFrame, share: float = DEFAULT_SHARE
) -> DataFrame:
    """The suspects come from a first pass over the mismatches; both order rules are then read off one join."""
    suspects = employee_default_pattern(employee_mismatches(orders, shipments), share).select(
        "shipment_employee_id", "mismatch_count", "total_mismatches"
    )
    # At most 1 / share employees can be suspected, hence the broadcast.
    paired = _paired(orders, shipments).join(F.broadcast(suspects), "shipment_employee_id", "left")
    return union_by_name([
        orphan_violations(
            shipments, "shipper_id", shippers, "shipper_id", "ORPHAN_SHIPPER_ID", "gold.dim_shipper"),
        row_violations(paired, order_rules()),
    ])


def dq_summary(views: dict[str, DataFrame]) -> DataFrame:
    return labeled_union(views, "source_view")


def dq_gate(views: dict[str, DataFrame]) -> DataFrame:
    """What an alert reads after a load: violations per rule and severity, empty when all is well.

    Each view is counted before the union, so only counts travel.
    """
    return (
        union_by_name(violation_counts(view) for view in views.values())
        .groupBy("rule_failed", "severity")
        .agg(F.sum("violations").alias("violations"))
    )


def validation_summary(tables: dict[str, DataFrame], keys: dict[str, list[str]] = GOLD_KEYS) -> DataFrame:
    return union_by_name(validate_key(tables[name], key, name) for name, key in keys.items())


def publish_views(views: dict[str, DataFrame], prefix: str = "") -> None:
    """Make the views queryable by name in SQL. They stay lazy: each query reads the tables as they are then."""
    for name, view in views.items():
        view.createOrReplaceTempView(f"{prefix}{name}")
