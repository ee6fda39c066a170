"""Row fingerprint used for change detection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that say where or when a row was loaded, not what it says.
LINEAGE_COLUMNS = frozenset({
    "created_at", "updated_at", "row_hash", "source_file_name", "source_system",
    "bronze_created_at", "bronze_updated_at", "bronze_source_file_name", "bronze_source_system",
})


def _canonical_text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(column).cast("string")  # independent of the session time zone
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(column)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def _tagged(field: T.StructField) -> Column:
    """``name=length:value``, or ``name=~`` for NULL: no two different rows share a text."""
    text = _canonical_text(field)
    return F.coalesce(
        F.concat(F.lit(f"{field.name}="), F.length(text).cast("string"), F.lit(":"), text),
        F.lit(f"{field.name}=~"),
    )


def row_fingerprint(df: DataFrame, keys: Iterable[str], exclude: Iterable[str] = LINEAGE_COLUMNS) -> Column:
    """SHA-256 over every business column, so a re-load of equal values is not a change."""
    skip = set(keys) | set(exclude)
    parts = [_tagged(field) for field in df.schema.fields if field.name not in skip]
    return F.sha2(F.concat_ws("|", *parts) if parts else F.lit(""), 256)
