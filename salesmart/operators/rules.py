"""Data-quality rules: one output row per broken rule, not per record."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "ERROR"
WARNING = "WARNING"


def text(*parts: Column | str) -> Column:
    """Message out of literals and columns; a NULL column adds nothing instead of erasing the message."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@dataclass(frozen=True)
class RowRule:
    """A rule that needs only the row itself."""

    name: str
    severity: str
    broken: Column
    detail: Column


def row_violations(df: DataFrame, rules: list[RowRule], record: str = "order_id") -> DataFrame:
    """All row rules in one scan.

    Only the names of the broken rules are exploded; severity and message are looked up afterwards, so a count
    of violations never builds a message.
    """
    broken = F.array_compact(F.array(*[F.when(rule.broken, rule.name) for rule in rules]))
    found = df.where(reduce(or_, [rule.broken for rule in rules])).select("*", F.explode(broken).alias("rule_failed"))

    def per_rule(value) -> Column:
        return F.coalesce(*[F.when(F.col("rule_failed") == rule.name, value(rule)) for rule in rules])

    return found.select(
        record,
        "rule_failed",
        per_rule(lambda rule: F.lit(rule.severity)).alias("severity"),
        per_rule(lambda rule: rule.detail).alias("detail"),
    )


def as_violations(df: DataFrame, name: str, severity: str, detail: Column, record: str = "order_id") -> DataFrame:
    return df.select(
        record, F.lit(name).alias("rule_failed"), F.lit(severity).alias("severity"), detail.alias("detail")
    )


def orphan_violations(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str, parent_name: str, record: str = "order_id"
) -> DataFrame:
    """Rows whose foreign key is set but not in the parent.

    An anti join keeps both directions open: Spark broadcasts a parent under its size threshold and otherwise
    sort-merges, where AQE splits a hot key on the child side.
    """
    parent_keys = parent.select(F.col(pk).alias("_pk"))
    missing = child.where(F.col(fk).isNotNull()).join(parent_keys, F.col(fk) == F.col("_pk"), "left_anti")
    return as_violations(missing, name, ERROR, text(f"{fk} ", F.col(fk), f" not found in {parent_name}"), record)


def parse_failures(df: DataFrame, table: str, record: str, parsed: dict[str, Column]) -> DataFrame:
    """One row per value that is set but cannot be read as its column's type; one scan, nothing is shuffled."""
    failed = [
        F.when(F.col(c).isNotNull() & typed.isNull(), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
        for c, typed in parsed.items()
    ]
    found = df.select(F.col(record).cast("string").alias("record"), F.explode(F.array_compact(F.array(*failed))).alias("f"))
    return found.select(F.lit(table).alias("table_name"), "f.column_name", "record", "f.value")


def violation_counts(violations: DataFrame) -> DataFrame:
    """The gate table an alert reads: violations per rule."""
    return violations.groupBy("rule_failed", "severity").agg(F.count("*").alias("violations"))
