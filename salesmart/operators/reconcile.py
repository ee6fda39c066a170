"""Row-count reconciliation between two independent readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.unions import union_by_name


def table_counts(tables: dict[str, DataFrame], count_column: str) -> DataFrame:
    return union_by_name(
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias(count_column)) for name, df in tables.items()
    )


def reconcile_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Full outer join of two ``(table_name, count)`` lists, so a table missing on one side shows up too."""
    return expected.join(actual, "table_name", "full_outer").select(
        "table_name",
        "expected_rows",
        "actual_rows",
        F.coalesce(F.col("expected_rows") == F.col("actual_rows"), F.lit(False)).alias("counts_match"),
    )
