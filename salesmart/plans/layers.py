"""Load specifications for whole layers: files to bronze, bronze to silver, silver to gold.

Each returns :class:`LoadSpec` lists for :func:`salesmart.plans.loads.run_loads`; nothing is read before a spec runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.audit import normalize_schema
from salesmart.plans import gold, silver
from salesmart.plans.loads import LoadSpec
from salesmart.plans.tables import BRONZE_KEYS, BRONZE_ROW_KEYS, BY_ORDER, GOLD_KEYS, MOST_LINES, ORDER_BUCKET, SILVER_KEYS
from salesmart.sources.files import (
    count_csv_records,
    count_xml_records,
    read_matching_csv,
    read_source,
)
from salesmart.sources.grid import header_names, promote_header, repair_budget_grid
from salesmart.sources.tables import key_summary, stringify


@dataclass(frozen=True)
class Source:
    """One raw source: its bronze table, the label kept as lineage, a reader, and optionally a second count."""

    table: str
    label: str
    read: Callable[[], DataFrame]
    expected_rows: Callable[[], int] | None = None


def _total(records: DataFrame) -> int:
    return records.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


def csv_file(spark: SparkSession, folder: str, table: str, file_name: str, **options) -> Source:
    path = f"{folder}/{file_name}"
    return Source(
        table, file_name, lambda: read_source(spark, path, "csv", **options),
        lambda: _total(count_csv_records(spark, path)),
    )


def csv_files(spark: SparkSession, folder: str, table: str, file_glob: str, **options) -> Source:
    """Every file of a glob, so a new export is picked up by itself."""
    return Source(
        table, file_glob, lambda: read_matching_csv(spark, folder, file_glob, **options),
        lambda: _total(count_csv_records(spark, folder, file_glob)),
    )


def xml_file(spark: SparkSession, folder: str, table: str, file_name: str, **options) -> Source:
    path = f"{folder}/{file_name}"
    return Source(
        table, file_name, lambda: read_source(spark, path, "xml", **options),
        lambda: _total(count_xml_records(spark, path)),
    )


def sheet(table: str, label: str, grid: Callable[[], DataFrame], header_row: int = 0) -> Source:
    """A plain sheet: one header row, all cells as text."""

    def read() -> DataFrame:
        cells = grid()
        names = header_names(cells, header_row)
        return stringify(promote_header(cells, names, header_row).select(names).dropna(how="all"))

    return Source(table, label, read)


def budget_sheet(label: str, grid: Callable[[], DataFrame], header_row: int = 1) -> Source:
    """The budget sheet with its title row and merged office cells. Its rows are not comparable to a file count."""

    def read() -> DataFrame:
        cells = grid()
        names = header_names(cells, header_row)
        return repair_budget_grid(cells, names, header_row, label=names[0]).select(names)

    return Source("budget", label, read)


def bronze_specs(sources: list[Source], database: str, run_ts: datetime, source_system: str) -> list[LoadSpec]:
    """Bronze keeps every row as exported, also where a business key repeats; that key is what gets validated."""

    def spec(source: Source) -> LoadSpec:
        keys = BRONZE_KEYS[source.table]
        return LoadSpec(
            f"{database}.bronze_{source.table}",
            lambda: normalize_schema(source.read(), run_ts, source.label, source_system),
            BRONZE_ROW_KEYS.get(source.table, keys),
            source.label,
            source.expected_rows,
            check_keys=keys,
            bucket=ORDER_BUCKET if keys[0] == "order_id" else None,
        )

    return [spec(source) for source in sources]


def _stamped(df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumns({"created_at": F.lit(run_ts), "updated_at": F.lit(run_ts)})


def silver_specs(spark: SparkSession, bronze: str, database: str, run_ts: datetime) -> list[LoadSpec]:
    def spec(table: str) -> LoadSpec:
        source, build = silver.BUILDERS[table]
        origin = f"{bronze}.bronze_{source}"
        by_order = SILVER_KEYS[table][0] == "order_id"
        return LoadSpec(
            f"{database}.{table}", lambda: _stamped(build(spark.table(origin)), run_ts), SILVER_KEYS[table], origin,
            bucket=ORDER_BUCKET if by_order else None, clustering=BY_ORDER if by_order else None, inputs=(origin,),
        )

    return [spec(table) for table in silver.BUILDERS]


def gold_specs(spark: SparkSession, silver_db: str, database: str, run_ts: datetime) -> list[LoadSpec]:
    """The star schema; each table names the tables it is built from. The sales fact takes product costs from the stored dimension."""

    def s(name: str) -> DataFrame:
        return spark.table(f"{silver_db}.{name}")

    def few_lines() -> bool:
        """Whether no order has so many lines that its rows should not meet in one place."""
        return all(key_summary(spark, f"{silver_db}.{name}").most_together <= MOST_LINES for name in ("fact_order_details", "fact_shipments"))

    builders: dict[str, tuple[list[str], Callable[[], DataFrame]]] = {
        "dim_date": (["fact_orders", "fact_shipments", "fact_budget"], lambda: gold.dim_date(s("fact_orders"), s("fact_shipments"), s("fact_budget"))),
        "dim_customer": (["dim_customer", "dim_division"], lambda: gold.dim_customer(s("dim_customer"), s("dim_division"))),
        "dim_product": (["dim_product", "dim_category"], lambda: gold.dim_product(s("dim_product"), s("dim_category"))),
        "dim_employee": (["dim_employee", "dim_office"], lambda: gold.dim_employee(s("dim_employee"), s("dim_office"))),
        "fact_sales": (["fact_order_details", "fact_orders", "fact_shipments", f"{database}.dim_product"], lambda: gold.fact_sales(
            s("fact_order_details"), s("fact_orders"), s("fact_shipments"), spark.table(f"{database}.dim_product"), by_order=few_lines())),
        **{name: ([name], lambda name=name: gold.passthrough(s(name))) for name in ("dim_supplier", "dim_shipper", "dim_division", "fact_budget")},
    }

    def spec(name: str, origins: list[str], build: Callable[[], DataFrame]) -> LoadSpec:
        by_order = GOLD_KEYS[name][0] == "order_id"
        return LoadSpec(
            f"{database}.{name}", lambda: _stamped(build(), run_ts), GOLD_KEYS[name], "+".join(origins),
            bucket=ORDER_BUCKET if by_order else None, clustering=BY_ORDER if by_order else None,
            inputs=tuple(o if "." in o else f"{silver_db}.{o}" for o in origins))

    return [spec(name, *builder) for name, builder in builders.items()]
