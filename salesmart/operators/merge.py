"""Upsert by key with fingerprint-based change detection."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.fingerprint import row_fingerprint
from salesmart.functions.types import aligned
from salesmart.operators.keys import require_unique

CHANGE = "_change"
_ORIGIN, _BATCH, _NEXT_ORIGIN, _NEXT_HASH, _NTH, _FIRST_HASH = "_origin", "_batch", "_next_origin", "_next_hash", "_nth", "_first_hash"


def with_fingerprint(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn("row_hash", row_fingerprint(df, keys))


def _same_key(left: str, right: str, keys: list[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _existing_change(stored: Column, incoming: Column) -> Column:
    return F.when(incoming.isNull(), "kept").when(stored.eqNullSafe(incoming), "unchanged").otherwise("update")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], source_is_unique: bool = False, target_is_unique: bool = False
) -> DataFrame:
    """The table after merging ``source`` into ``target``, plus ``_change`` per row.

    ``update``: the key exists and the fingerprint differs; all source columns but the keys and ``created_at``
    are taken. ``unchanged``: equal fingerprint, row untouched. ``insert``: new key. ``kept``: only in the
    target, which nothing deletes. Keys and fingerprints compare NULL-safe, so a row stored without a
    fingerprint is updated once and a NULL key does not pile up. Columns new in the source are added, and a column whose
    type differs gets the least type that holds both.
    Exact repeats in the source are one row. A key that repeats with different rows has no single row to take, so it
    fails the job; ``source_is_unique`` skips
    that check for a batch that was deduplicated before.

    Where the keys of the target are known to be unique (``target_is_unique``, see ``sources.tables.key_summary``) no key is
    hot, and both sides go through one shuffle, see :func:`merge_rows`. Otherwise the shape is a left join from the target
    plus an anti join from the source rather than one full outer
    join: a batch that fits in memory is then broadcast and the target never shuffles, and for a large one AQE
    may split a skewed target partition, which a full outer join forbids.
    """
    if target_is_unique:
        return merge_rows(target, source, keys).where(F.col(CHANGE).isNotNull()).drop(_ORIGIN, _NTH)
    batch = with_fingerprint(source, keys)
    if not source_is_unique:
        # exact repeats are one row; only a key with two fingerprints leaves open which row to take
        batch = require_unique(batch.dropDuplicates([*keys, "row_hash"]), keys, "merge source")
    own = set(batch.columns)
    stored, batch = aligned(target, batch)
    columns = stored.columns

    fixed = {*keys, "created_at"}
    replace = F.col(CHANGE) == "update"
    existing = (
        stored.alias("t")
        .join(batch.alias("s"), _same_key("t", "s", keys), "left")
        .withColumn(CHANGE, _existing_change(F.col("t.row_hash"), F.col("s.row_hash")))
        .select(
            *[
                F.when(replace, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
                if c in own and c not in fixed
                else F.col(f"t.{c}").alias(c)
                for c in columns
            ],
            CHANGE,
        )
    )
    known = (
        stored.select(*keys).alias("t")
        .join(batch.select(*keys).alias("s"), _same_key("t", "s", keys), "left_semi")
        .distinct()
    )
    inserts = (
        batch.alias("s")
        .join(known.alias("t"), _same_key("s", "t", keys), "left_anti")
        .select(*columns, F.lit("insert").alias(CHANGE))
    )
    return existing.unionByName(inserts)


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str], fail_on_conflict: bool = True) -> DataFrame:
    """Both sides united and read once, key by key: the rows of the merged table with ``_change``, and with NULL there the rows of
    the source that matched or repeated. ``_origin`` is 0 for rows of the source and 1 for those of the target; ``_nth``
    numbers the rows of the source within a key.

    Source rows come first within their key, in the order of their fingerprints. A target row sees the last of them; a source
    row is an insert if nothing follows it; two in a row with different fingerprints fail the job. All of that looks back
    at one row or ahead at one, so a key of any size streams through its task; but one key is one task.

    For reports that write nothing, ``fail_on_conflict=False`` passes over a source key with different rows instead: none of
    them is an insert, and rows of the target under that key are kept.
    """
    batch = with_fingerprint(source, keys)
    own = set(batch.columns)
    stored, batch = aligned(target, batch)
    columns = stored.columns
    taken = [c for c in columns if c in own and c not in {*keys, "created_at"}]
    rows = batch.withColumn(_ORIGIN, F.lit(0)).unionByName(stored.withColumn(_ORIGIN, F.lit(1)))

    in_key = Window.partitionBy(*keys).orderBy(_ORIGIN, "row_hash")
    so_far = in_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_batch = F.col(_ORIGIN) == 0
    seen = rows.select(
        *columns, _ORIGIN,
        F.last(F.when(from_batch, F.struct(*taken)), ignorenulls=True).over(so_far).alias(_BATCH),
        F.lead(_ORIGIN).over(in_key).alias(_NEXT_ORIGIN), F.lead("row_hash").over(in_key).alias(_NEXT_HASH),
        F.count_if(from_batch).over(so_far).alias(_NTH),
        F.first("row_hash").over(so_far).alias(_FIRST_HASH),
    )
    inserts = F.when(F.col(_NEXT_ORIGIN).isNull(), "insert")
    existing = _existing_change(F.col("row_hash"), F.col(f"{_BATCH}.row_hash"))
    if fail_on_conflict:
        conflict = from_batch & (F.col(_NEXT_ORIGIN) == 0) & (F.col("row_hash") != F.col(_NEXT_HASH))
        message = F.concat(F.lit("merge source: repeated key with different rows: "), F.to_json(F.struct(*keys)))
        change = F.when(conflict, F.raise_error(message).cast("string")).when(from_batch, inserts).otherwise(existing)
    else:
        # the first row of a key is one of the source if there are any; a key without them has no _BATCH
        conflict = F.col(_FIRST_HASH) != F.col(f"{_BATCH}.row_hash")
        change = F.when(from_batch, F.when(~conflict, inserts)).when(conflict, "kept").otherwise(existing)
    replace = F.col(CHANGE) == "update"
    return seen.withColumn(CHANGE, change).select(
        *[F.when(replace, F.col(f"{_BATCH}.{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c) for c in columns],
        CHANGE, _ORIGIN, _NTH)


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row of counts from one pass over :func:`merge_rows`: rows read from the source, what the merge does, rows afterwards, and
    keys that repeat in the source."""
    did = lambda change: F.count_if(F.col(CHANGE) == change)
    return merged.agg(
        F.count_if(F.col(_ORIGIN) == 0).alias("rows_read"),
        did("insert").alias("rows_inserted"),
        did("update").alias("rows_updated"),
        F.count(CHANGE).alias("rows_total"),
        F.count_if((F.col(_ORIGIN) == 0) & (F.col(_NTH) == 2)).alias("duplicate_keys"),
    )


def first_load(source: DataFrame, keys: list[str]) -> DataFrame:
    """What the first run stores: the batch as it is, with fingerprints."""
    return with_fingerprint(source, keys).withColumn(CHANGE, F.lit("insert"))


def change_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy(F.col(CHANGE).alias("change")).agg(F.count("*").alias("row_count"))
