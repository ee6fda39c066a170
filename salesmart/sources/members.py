"""Placeholder members for keys that have no master record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def literal_rows(spark: SparkSession, rows: list[dict], schema: StructType) -> DataFrame:
    """A few literal rows of a given schema; columns a row does not name are NULL. Built from literals, so the
    optimizer folds them into the plan instead of shipping a local collection."""
    structs = [
        F.struct(*[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def add_members(df: DataFrame, members: list[dict]) -> DataFrame:
    """Append literal rows to a dimension."""
    unknown = {name for member in members for name in member} - set(df.columns)
    if unknown:
        raise ValueError(f"placeholder names unknown columns: {sorted(unknown)}")
    return df.unionByName(literal_rows(df.sparkSession, members, df.schema))
