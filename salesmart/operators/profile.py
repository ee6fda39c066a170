"""Column profiles of raw sources, one scan per source."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField

from salesmart.functions.values import percent

# Parts of a column name that make it look like a key.
KEY_KEYWORDS = ("id", "code", "number", "key")


def _empty(field: StructField) -> Column:
    """NULL, or empty where the column is text; other types have no empty value to compare with."""
    column = F.col(f"`{field.name}`")
    return column.isNull() | (column == "") if isinstance(field.dataType, StringType) else column.isNull()


def _looks_like_key(column: str, keywords: tuple[str, ...], keys: Collection[str]) -> bool:
    return column in keys or any(k in column.lower() for k in keywords)


def profile_shape(df: DataFrame, source: str) -> DataFrame:
    return df.agg(
        F.lit(source).alias("source"),
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
    )


def profile_nulls(df: DataFrame, source: str) -> DataFrame:
    """Empty values per column: one aggregate row over all columns, turned into one row per column."""
    columns = df.columns
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(_empty(f)).alias(f.name) for f in df.schema.fields])
    return (
        counts.unpivot(["_rows"], columns, "column_name", "null_count")
        .select(
            F.lit(source).alias("source"),
            "column_name",
            "null_count",
            percent(F.col("null_count"), F.col("_rows")).alias("null_pct"),
        )
        .withColumn("all_null", F.coalesce(F.col("null_pct") == 100, F.lit(False)))
    )


def _value(field: StructField | None) -> list[Column]:
    """A value as whole number or, of other types, as text; no value if there is no field."""
    whole = field is not None and isinstance(field.dataType, IntegralType)
    column = F.lit(None) if field is None else F.col(f"`{field.name}`")
    return [(column if whole else F.lit(None)).cast("bigint").alias("number"), (F.lit(None) if whole else column).cast("string").alias("value")]


def _value_counts(df: DataFrame, fields: list[tuple[StructField, bool]]) -> DataFrame:
    """How often each value of each field (named by its place) stands there, or only how many are empty where the value does not matter:
    each row becomes one (field, empty or not, value) per field, and those are
    counted where they are read, so a value shared by many rows travels once per task."""
    held = [F.struct(F.lit(k).alias("k"), _empty(f).alias("is_empty"), *_value(f if valued else None)) for k, (f, valued) in enumerate(fields)]
    pairs = df.select(F.explode(F.array(*held)).alias("held")).select("held.*")
    counts = pairs.groupBy("k", "is_empty", "number", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("k").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(F.col("is_empty"), F.col("n"))).alias("null_count"), F.count("*").alias("distinct_count"))


def _with_names(counts: DataFrame, fields: list[tuple[StructField, bool]]) -> DataFrame:
    """The counts next to all fields, also those of a source without rows."""
    named = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f.name).alias("column_name"), F.lit(valued).alias("candidate")) for k, (f, valued) in enumerate(fields)])
    return counts.sparkSession.range(1).select(F.inline(named)).join(counts, "k", "left")


def key_candidates(df: DataFrame, source: str, keywords: tuple[str, ...] = KEY_KEYWORDS, keys: Collection[str] = ()) -> DataFrame:
    """Uniqueness of every column whose name looks like a key or is one of ``keys``. NULL counts as one value.

    All candidates of a source come from one scan and one grouped count. A source without rows has candidates without values.
    """
    candidates = [(f, True) for f in df.schema.fields if _looks_like_key(f.name, keywords, keys)]
    if not candidates:
        raise ValueError(f"no column of {source} contains any of {keywords}")
    total, distinct = F.coalesce("row_count", F.lit(0)), F.coalesce("distinct_count", F.lit(0))
    return _with_names(_value_counts(df, candidates), candidates).select(
        F.lit(source).alias("source"),
        "column_name",
        total.alias("total_rows"),
        distinct.alias("distinct_count"),
        (total - distinct).alias("duplicates"),
        (total == distinct).alias("is_key"),
    )


def column_profile(df: DataFrame, source: str, keywords: tuple[str, ...] = KEY_KEYWORDS, keys: Collection[str] = ()) -> DataFrame:
    """Shape, empty values and key candidates of a source in one scan: a row per column.

    Only candidates carry their values, so any other column
    is two numbers per task. ``distinct_count`` and ``is_key`` are NULL for columns that are no candidates. A source without rows gives its columns with zeros.
    """
    fields = [(f, _looks_like_key(f.name, keywords, keys)) for f in df.schema.fields]
    rows, empty = F.coalesce("row_count", F.lit(0)), F.coalesce("null_count", F.lit(0))
    distinct = F.when(F.col("candidate"), F.coalesce("distinct_count", F.lit(0)))
    return _with_names(_value_counts(df, fields), fields).select(
        F.lit(source).alias("source"),
        "column_name",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        rows.alias("row_count"),
        empty.alias("null_count"),
        percent(empty, rows).alias("null_pct"),
        distinct.alias("distinct_count"),
        (distinct == rows).alias("is_key"),
    )
