"""The data-quality views as catalog objects: their bodies are SQL, so any session of the catalog can read them by name.

They give the same rows as the functions of :mod:`salesmart.plans.quality`, read the stored tables as they are when the
view is queried, and need no job to be created.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from salesmart.functions.values import DISCOUNT, MONEY, PRICE, QUANTITY
from salesmart.plans.quality import DEFAULT_SHARE


def _violations(record: str, rules: list[tuple[str, str, str, str]], source: str) -> str:
    """SELECT of all rules over one FROM clause: (name, severity, condition, parts of the message)."""
    cases = ",\n    ".join(
        f"CASE WHEN {broken} THEN named_struct('rule_failed', '{name}', 'severity', '{severity}', 'detail', concat_ws('', {detail})) END"
        for name, severity, broken, detail in rules)
    return f"SELECT {record}, v.rule_failed, v.severity, v.detail FROM (\n  SELECT {record}, explode(array_compact(array(\n    {cases}))) AS v\n  FROM {source}) broken"


def _orphan(fk: str, known: str, parent: str) -> tuple[str, str, str, str]:
    return f"ORPHAN_{fk.upper()}", "ERROR", f"{fk} IS NOT NULL AND {known} IS NULL", f"'{fk} ', string({fk}), ' not found in gold.{parent}'"


def dq_orders_sql(silver: str, gold: str) -> str:
    parents = [("customer_id", "dim_customer", "customer_id"), ("employee_id", "dim_employee", "emp_id"), ("shipper_id", "dim_shipper", "shipper_id")]
    source = f"{silver}.fact_orders o" + "".join(
        f" LEFT JOIN (SELECT DISTINCT {pk} AS known_{fk} FROM {gold}.{parent}) {parent} ON {fk} = known_{fk}" for fk, parent, pk in parents)
    rules = [("MISSING_ORDER_DATE", "ERROR", "order_date IS NULL", "'order_date is NULL'")]
    return _violations("order_id", [*rules, *[_orphan(fk, f"known_{fk}", parent) for fk, parent, _ in parents]], source)


def dq_order_details_sql(silver: str, gold: str) -> str:
    """The rules on the row alone keep a scan of their own, into which their conditions are pushed."""
    rules = [
        ("DISCOUNT_OUT_OF_RANGE", "ERROR", "NOT (discount BETWEEN 0 AND 1)", "'discount ', string(discount), ' is outside the valid 0-1 range'"),
        ("NON_POSITIVE_QUANTITY", "ERROR", "quantity <= 0", "'quantity ', string(quantity), ' is zero or negative'"),
        ("NON_POSITIVE_UNIT_PRICE", "ERROR", "unit_price <= 0", "'unit_price ', string(unit_price), ' is zero or negative'"),
    ]
    broken = " OR ".join(f"({rule[2]})" for rule in rules)
    net = f"try_cast(quantity AS {QUANTITY}) * try_cast(unit_price AS {PRICE}) * (1 - try_cast(discount AS {DISCOUNT}))"
    cost = f"try_cast(quantity AS {QUANTITY}) * try_cast(unit_cost AS {PRICE})"
    priced = [
        _orphan("product_id", "known_product", "dim_product"),
        ("NEGATIVE_MARGIN", "WARNING", f"{net} - {cost} < 0", (
            f"'line margin is negative: extended_amount ', string(try_cast(round({net}, 2) AS {MONEY})), ' vs. cost ', "
            f"string(try_cast(round({cost}, 2) AS {MONEY})), ' -- discount of ', string(round(discount * 100, 1)), '% likely too aggressive'")),
    ]
    joined = f"(SELECT d.*, p.product_id AS known_product, p.unit_cost FROM {silver}.fact_order_details d LEFT JOIN {gold}.dim_product p ON d.product_id = p.product_id) priced"
    return (_violations("order_id", rules, f"(SELECT * FROM {silver}.fact_order_details WHERE {broken}) own")
            + "\nUNION ALL\n" + _violations("order_id", priced, joined))


def dq_shipments_sql(silver: str, gold: str, share: float = DEFAULT_SHARE) -> str:
    pairs = (f"SELECT o.order_id, s.shipment_date, o.order_date, s.employee_id AS ships, o.employee_id AS sells FROM {silver}.fact_orders o "
             f"JOIN {silver}.fact_shipments s ON o.order_id = s.order_id")
    counts = f"SELECT ships AS suspect, count(*) AS mismatch_count FROM ({pairs}) p WHERE sells <> ships GROUP BY ships"
    suspects = (f"SELECT /*+ BROADCAST(counted) */ suspect, mismatch_count, total_mismatches FROM (SELECT c.*, (SELECT sum(mismatch_count) FROM ({counts})) AS total_mismatches "
                f"FROM ({counts}) c) counted WHERE mismatch_count > total_mismatches * {share}D")
    orphans = f"(SELECT s.order_id, s.shipper_id, d.known_shipper FROM {silver}.fact_shipments s LEFT JOIN (SELECT DISTINCT shipper_id AS known_shipper FROM {gold}.dim_shipper) d ON s.shipper_id = d.known_shipper) shipped"
    rules = [
        ("SHIPMENT_BEFORE_ORDER", "ERROR", "shipment_date < order_date", "'shipment_date ', string(shipment_date), ' is earlier than order_date ', string(order_date)"),
        ("EMPLOYEE_ID_DEFAULT_PATTERN", "WARNING", "mismatch_count IS NOT NULL AND ships <> sells", (
            "'shipment_employee_id ', string(ships), ' differs from order_employee_id ', string(sells), ' -- this employee_id accounts for ', "
            "string(CAST(round(CAST(mismatch_count AS DOUBLE) * 100 / CAST(total_mismatches AS DOUBLE), 1) AS DECIMAL(5,1))), '% of all ', "
            "string(total_mismatches), ' Orders/Shipments employee_id mismatches -- likely a source-system default value'")),
    ]
    joined = f"({pairs}) paired LEFT JOIN ({suspects}) suspected ON ships = suspect"
    return _violations("order_id", [_orphan("shipper_id", "known_shipper", "dim_shipper")], orphans) + "\nUNION ALL\n" + _violations("order_id", rules, joined)


def dq_summary_sql(governance: str) -> str:
    names = ("dq_orders", "dq_order_details", "dq_shipments")
    return "\nUNION ALL\n".join(f"SELECT order_id, rule_failed, severity, detail, '{name}' AS source_view FROM {governance}.{name}" for name in names)


def create_views(spark: SparkSession, silver: str, gold: str, governance: str) -> None:
    """Create or replace the four views in the database ``governance``, over the tables of the other two."""
    bodies = {
        "dq_orders": dq_orders_sql(silver, gold),
        "dq_order_details": dq_order_details_sql(silver, gold),
        "dq_shipments": dq_shipments_sql(silver, gold),
        "dq_summary": dq_summary_sql(governance),
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE VIEW {governance}.{name} AS {body}")
