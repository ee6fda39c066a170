"""Stored tables: scan, overwrite, append and upsert.

Tables live in whatever catalog the session has. There are three ways to upsert, by what the table can do:

* :func:`merge_into` - the table format supports MERGE (a lakehouse format): it rewrites the touched files only.
* :func:`upsert_partitions` - plain parquet, partitioned by a value derived from the key: the partitions the batch
  touches are read, merged and replaced; the others are not even listed for reading. Key counts are kept per partition
  beside the table, so that they are counted anew for the touched partitions only.
* :func:`upsert_table` - plain parquet without such a value: the merged snapshot becomes a new generation and a view
  is pointed at it. Readers see the old or the new snapshot, and a failed run leaves the old one in place.

Every write goes under a name of its own and is made visible when it is complete; what a failed run left behind is passed by.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.types import as_type, widened_fields
from salesmart.operators.keys import any_null
from salesmart.operators.merge import CHANGE, first_load, merge_upsert, with_fingerprint

# Columns of the audit log, one row per run and table.
AUDIT_SCHEMA = """
    run_id STRING NOT NULL, table_name STRING NOT NULL, source_file_name STRING, run_timestamp TIMESTAMP NOT NULL,
    rows_read_from_source BIGINT, rows_inserted BIGINT, rows_updated BIGINT, rows_total_after_write BIGINT,
    status STRING NOT NULL, error_message STRING
"""

BUCKET = "key_bucket"
#: The partition of rows whose bucket is NULL.
NO_BUCKET = "none"
SMALL_BATCH = 100_000
_FILE = "_file"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class WriteCounts:
    rows_inserted: int
    rows_updated: int
    rows_total: int


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text; NULL stays NULL rather than turning into a word."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count changes while the rows are written, so no count job follows the write."""
    seen = Observation()
    return df.observe(
        seen,
        F.count_if(F.col(CHANGE) == "insert").alias("rows_inserted"),
        F.count_if(F.col(CHANGE) == "update").alias("rows_updated"),
        F.count(F.lit(1)).alias("rows_total"),
    ).drop(CHANGE), seen


def _counts(seen: Observation) -> WriteCounts:
    """An empty result may be optimised away together with its observation."""
    values = seen.get
    return WriteCounts(*(values.get(name, 0) for name in ("rows_inserted", "rows_updated", "rows_total")))


@dataclass(frozen=True)
class Clustering:
    """Rows dealt to ``files`` files by the hash of ``columns``: two tables clustered alike join without a shuffle."""

    columns: tuple[str, ...]
    files: int

    def place(self) -> Column:
        return F.pmod(F.hash(*self.columns), F.lit(self.files))


def _dealt(rows: DataFrame, clustering: Clustering | None, partitions: tuple[str, ...]) -> DataFrame:
    """Rows of one file brought together; AQE splits a file that would hold far more rows than the others."""
    if clustering:
        return rows.withColumn(_FILE, clustering.place()).hint("rebalance", *[F.col(c) for c in (*partitions, _FILE)]).drop(_FILE)
    return rows.hint("rebalance", *[F.col(c) for c in partitions]) if partitions else rows


def _write(rows: DataFrame, name: str, clustering: Clustering | None, partitions: tuple[str, ...] = ()) -> None:
    writer = _dealt(rows, clustering, partitions).write.format("parquet")
    if partitions:
        writer = writer.partitionBy(*partitions)
    if clustering:
        writer = writer.bucketBy(clustering.files, *clustering.columns).sortBy(*clustering.columns)
    writer.saveAsTable(name)


def _fresh(base: str, number: int, write: Callable[[str], None]) -> int:
    """Write ``base<number>``, or the next number under which nothing lies, also no folder of a run that failed."""
    while True:
        try:
            write(f"{base}{number}")
            return number
        except PySparkException as error:
            if error.getCondition() not in ("LOCATION_ALREADY_EXISTS", "TABLE_OR_VIEW_ALREADY_EXISTS"):
                raise
            number += 1


def _generations(spark: SparkSession, name: str) -> list[int]:
    database, _, base = name.rpartition(".")
    found = spark.catalog.listTables(database or None, f"{base}__g*")
    numbers = [re.fullmatch(rf"{re.escape(base)}__g(\d+)", table.name) for table in found]
    return sorted(int(match.group(1)) for match in numbers if match)


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def _new_generation(spark: SparkSession, rows: DataFrame, name: str, clustering: Clustering | None) -> None:
    """Store the rows and point the view at them. The generation before is kept for readers still on it, older ones are dropped."""
    stored = _generations(spark, name)
    new = _fresh(f"{name}__g", (stored[-1] if stored else 0) + 1, lambda path: _write(rows, path, clustering))
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")  # stored before there were generations; the new one is complete
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}__g{new}")
    for old in stored[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {name}__g{old}")


def overwrite_table(df: DataFrame, name: str, clustering: Clustering | None = None) -> WriteCounts:
    """Full replacement, schema included. Readers see the old rows until the new ones are all there."""
    rows, seen = _observed(df.withColumn(CHANGE, F.lit("insert")))
    _new_generation(spark=df.sparkSession, rows=rows, name=name, clustering=clustering)
    return _counts(seen)


def append_audit(spark: SparkSession, table: str, rows: list[tuple]) -> None:
    """One row per loaded table, in one small file per run."""
    spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1).write.mode("append").format("parquet").saveAsTable(table)


def stable_batch(df: DataFrame) -> DataFrame:
    """The batch written once to the cluster's checkpoint folder.

    A merge reads its batch several times; without this each read would parse the sources again, after an executor
    loss once more. The folder is the one the session names in ``spark.checkpoint.dir``; where none is named the
    batch stays lazy, which is correct, only slower.
    """
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df


def upsert_table(
    spark: SparkSession, df: DataFrame, name: str, keys: list[str], source_is_unique: bool = False, clustering: Clustering | None = None
) -> WriteCounts:
    """Create the table on the first run, merge on later ones.

    The first run stores the batch as it is, repeated keys included; a merge refuses them. A column whose type changes takes
    the least type that holds both. The generation before the new one is kept for readers still on it, older ones are dropped.
    """
    if spark.catalog.tableExists(name):
        result = merge_upsert(spark.table(name), stable_batch(df), keys, source_is_unique)
    else:
        result = first_load(df, keys)
    rows, seen = _observed(result)
    _new_generation(spark, rows, name, clustering)
    return _counts(seen)


# -- tables in partitions -------------------------------------------------------------------------------

def _conform(spark: SparkSession, name: str, batch: DataFrame, clustering: Clustering | None) -> None:
    """Make room for the batch: columns new in it are added (NULL in the rows stored before); for a column whose type has to
    widen the table is rewritten once, under another name until it is complete."""
    stored = spark.table(name).schema
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields if f.name not in stored.names]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    wider = widened_fields(stored, batch.schema)
    if wider:
        rows = spark.table(name).select([as_type(f.name, f.dataType, wider.get(f.name, f.dataType)) for f in spark.table(name).schema.fields])
        at = _fresh(f"{name}__w", 1, lambda path: _write(rows, path, clustering, (BUCKET,)))
        spark.sql(f"DROP TABLE {name}")
        _rename(spark, f"{name}__w{at}", name)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename a table in partitions. Not every catalog lets the partitions follow, so they are looked up again."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")


def _finish_rewrite(spark: SparkSession, name: str) -> None:
    """A run that ended between dropping the narrow table and renaming the complete wide one: rename it now."""
    database, _, base = name.rpartition(".")
    left = sorted(t.name for t in spark.catalog.listTables(database or None, f"{base}__w*") if re.fullmatch(rf"{re.escape(base)}__w\d+", t.name))
    if left and not spark.catalog.tableExists(name):
        _rename(spark, f"{database}.{left[-1]}" if database else left[-1], name)


def _small(batch: DataFrame) -> bool:
    """Few enough rows that the join may be left to Spark, which then need not shuffle the stored rows for it."""
    return batch.limit(SMALL_BATCH + 1).count() <= SMALL_BATCH


def _touched(batch: DataFrame) -> DataFrame:
    """The bucket values of a batch. They are names of partitions, which the catalog lists one by one anyway, so they are broadcast; the
    condition on the count lets Spark prune partitions by them at run time."""
    return F.broadcast(batch.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(BUCKET))


_SUMMARY = {"row_count": F.sum, "key_nulls": F.sum, "duplicate_keys": F.sum, "most_together": F.max}


def _bucket_keys(rows: DataFrame, keys: list[str], together: tuple[str, ...]) -> DataFrame:
    """Of each bucket: rows, rows with a NULL in the key, repeated keys, and the most rows that agree in ``together``, columns of the
    key by which rows are clustered. A key lies in one bucket, so buckets add up."""
    per_key = rows.groupBy(BUCKET, *keys).agg(F.count(F.lit(1)).alias("n"))
    per_group = per_key.groupBy(BUCKET, *together).agg(
        F.sum("n").alias("n"), F.sum(F.when(any_null(keys), F.col("n"))).alias("nulls"), F.count_if(F.col("n") > 1).alias("repeated"))
    return per_group.groupBy(BUCKET).agg(
        F.sum("n").alias("row_count"), F.coalesce(F.sum("nulls"), F.lit(0)).alias("key_nulls"),
        F.sum("repeated").alias("duplicate_keys"), F.max("n").alias("most_together"),
    ).select(*_SUMMARY, BUCKET)


def key_summary(spark: SparkSession, name: str) -> Row:
    """Rows, NULL keys, repeated keys and the largest cluster of a table in partitions, from the counts kept beside it: one row
    per bucket is read."""
    return spark.table(f"{name}__keys").agg(*[F.coalesce(total(c), F.lit(0)).alias(c) for c, total in _SUMMARY.items()]).first()


def _summarise(spark: SparkSession, name: str, keys: list[str], together: tuple[str, ...], touched: DataFrame | None) -> None:
    """Count the keys of the touched buckets again (of all, where there are no counts yet)."""
    beside = f"{name}__keys"
    if touched is None or not spark.catalog.tableExists(beside):
        counts = _bucket_keys(spark.table(name), keys, together).hint("rebalance")
        counts.write.format("parquet").partitionBy(BUCKET).mode("overwrite").saveAsTable(beside)
    else:
        counts = _bucket_keys(spark.table(name).join(touched, BUCKET, "left_semi"), keys, together).hint("rebalance")
        counts.write.mode("overwrite").insertInto(beside)


def upsert_partitions(
    spark: SparkSession, df: DataFrame, name: str, keys: list[str], bucket: Column, source_is_unique: bool = False,
    check_keys: list[str] | None = None, clustering: Clustering | None = None,
) -> WriteCounts:
    """Upsert into a table partitioned by ``bucket``, an expression over the keys such as ``order_id DIV 1000000``.

    Because the bucket follows from the key, a row never moves and every match lies in a bucket of the batch. A join with
    the batch's bucket values prunes the target scan at run time, and only those partitions are
    replaced. ``check_keys`` (the keys, if not given) are counted per bucket, see :func:`key_summary`; the bucket has to follow
    from them too. While no key repeats, target and batch go through one shuffle. A repeated run after a failure gives the same table.
    """
    if spark.conf.get(_OVERWRITE_MODE).lower() != "dynamic":
        raise ValueError(f"{_OVERWRITE_MODE}=dynamic is needed: a static overwrite would drop the other partitions")
    checked = check_keys or keys
    together = tuple(c for c in clustering.columns if c in checked) if clustering else tuple(checked)
    batch = stable_batch(df.withColumn(BUCKET, F.coalesce(bucket.cast("string"), F.lit(NO_BUCKET))))
    _finish_rewrite(spark, name)
    if not spark.catalog.tableExists(name):
        rows, seen = _observed(first_load(batch, [*keys, BUCKET]))
        _write(rows, name, clustering, (BUCKET,))
        _summarise(spark, name, checked, together, None)
        return _counts(seen)
    _conform(spark, name, with_fingerprint(batch, keys), clustering)
    touched = _touched(batch)
    target = spark.table(name).join(touched, BUCKET, "left_semi")
    before = key_summary(spark, name) if spark.catalog.tableExists(f"{name}__keys") else None
    unique = before is not None and checked == keys and not before.duplicate_keys and not before.key_nulls
    rows, seen = _observed(merge_upsert(target, batch, [*keys, BUCKET], source_is_unique, target_is_unique=unique and not _small(batch)))
    rows = rows.select(spark.table(name).columns)
    _dealt(rows, clustering, (BUCKET,)).write.mode("overwrite").insertInto(name)
    _summarise(spark, name, checked, together, touched)
    counts = _counts(seen)
    return WriteCounts(counts.rows_inserted, counts.rows_updated, key_summary(spark, name).row_count)


def merge_into(df: DataFrame, table: str, keys: list[str]) -> None:
    """The same upsert for catalogs whose tables support MERGE; new columns are added by the format."""
    batch = with_fingerprint(df, keys).alias("source")
    same_key = F.expr(" AND ".join(f"{table}.`{k}` <=> source.`{k}`" for k in keys))
    changed = F.expr(f"NOT ({table}.row_hash <=> source.row_hash)")
    updates = {c: F.col(f"source.{c}") for c in batch.columns if c not in (*keys, "created_at")}
    (
        batch.mergeInto(table, same_key)
        .whenMatched(changed).update(updates)
        .whenNotMatched().insertAll()
        .withSchemaEvolution()
        .merge()
    )


def audit_row(
    run_id: str, table: str, source: str | None, run_ts: datetime, rows_read: int | None,
    counts: WriteCounts | None, status: str, error: str | None,
) -> tuple:
    written = (counts.rows_inserted, counts.rows_updated, counts.rows_total) if counts else (None, None, None)
    return (run_id, table, source, run_ts, rows_read, *written, status, error)
