"""Unions by column name."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=allow_missing), frames)


def labeled_union(frames: dict[str, DataFrame], label_column: str = "source_file") -> DataFrame:
    """Union of same-shaped sources, each tagged with its name."""
    return union_by_name(df.withColumn(label_column, F.lit(name)) for name, df in frames.items())
