"""Audit and lineage columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.naming import snake_case_columns

_LINEAGE_RENAMES = {
    name: f"bronze_{name}" for name in ("created_at", "updated_at", "source_file_name", "source_system")
}


def stamp(df: DataFrame, run_ts: datetime, source_file: str, source_system: str) -> DataFrame:
    """Add the four audit columns. ``run_ts`` comes from the caller, so one run stamps one instant."""
    return df.withColumns({
        "created_at": F.lit(run_ts),
        "updated_at": F.lit(run_ts),
        "source_file_name": F.lit(source_file),
        "source_system": F.lit(source_system),
    })


def normalize_schema(df: DataFrame, run_ts: datetime, source_file: str, source_system: str) -> DataFrame:
    return stamp(snake_case_columns(df), run_ts, source_file, source_system)


def lineage_from_bronze(df: DataFrame) -> DataFrame:
    """Keep the audit columns of the layer below under ``bronze_*`` and drop its fingerprint."""
    return df.withColumnsRenamed(_LINEAGE_RENAMES).drop("row_hash")
