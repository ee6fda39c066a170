"""Key checks. Each is one grouped count, so repeated keys collapse before they are shuffled."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.joins import splittable_join


def any_null(keys: list[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return key_counts(df, keys).where(F.col("row_count") > 1)


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    return splittable_join(df, duplicate_keys(df, keys).select(*keys), keys, "left_semi")


def conflicting_keys(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Repeated keys that carry different values."""
    distinct = f"distinct_{value}s"
    return df.groupBy(*keys).agg(F.count_distinct(value).alias(distinct)).where(F.col(distinct) > 1)


def conflicting_rows(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The rows behind :func:`conflicting_keys`, all versions.

    min <> max finds the keys with two fixed-size buffers per key and a single shuffle.
    """
    conflicts = (
        df.groupBy(*keys)
        .agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
        .where(F.col("_low") != F.col("_high"))
        .select(*keys)
    )
    return splittable_join(df, conflicts, keys, "left_semi")


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows (one row out)."""
    return (
        key_counts(df, keys)
        .agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_keys"))
        .withColumn("surplus_rows", F.col("total_rows") - F.col("distinct_keys"))
    )


def validate_key(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Rows, rows with a NULL in the key, repeated keys and a verdict, from one aggregation."""
    per_key = key_counts(df, keys)
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(any_null(keys), F.col("row_count"))), F.lit(0)).alias("key_nulls"),
        F.count_if(F.col("row_count") > 1).alias("duplicate_keys"),
    ).withColumn(
        "status",
        F.when((F.col("key_nulls") == 0) & (F.col("duplicate_keys") == 0), "CLEAN").otherwise("REVIEW NEEDED"),
    )


def audit_range(df: DataFrame, created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    return df.agg(F.min(created).alias("earliest_created_at"), F.max(updated).alias("latest_updated_at"))


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df`` itself, but running it fails when a key repeats.

    The check is a scalar subquery of the same plan: nothing runs until the result does, and no row of
    ``df`` is shuffled for it (only its keys are).
    """
    repeated = duplicate_keys(df, keys).agg(F.count("*").alias("n")).scalar()
    message = F.concat(F.lit(f"{what}: "), repeated.cast("string"), F.lit(f" repeated key(s) on {', '.join(keys)}"))
    return df.where(F.when(repeated > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
