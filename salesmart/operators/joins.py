"""Join helper for inputs that are already grouped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EXTRA_KEY = "_join_hash"


def splittable_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi join of rows with a table grouped by the same keys, such that AQE can split a hot key.

    AQE splits a skewed partition only if both inputs of the join come straight from a shuffle made for it.
    The grouped side does not: its aggregation already sits on these keys. With a hash of the keys as one more
    join key both sides are shuffled for the join; that costs one pass of the grouped side over the network
    and keeps the many rows of one key from ending in one task. Sides under the broadcast threshold are
    broadcast as usual.
    """
    extra = F.xxhash64(*keys)
    joined = left.withColumn(_EXTRA_KEY, extra).join(right.withColumn(_EXTRA_KEY, extra), [*keys, _EXTRA_KEY], how)
    return joined.drop(_EXTRA_KEY)
